"""Scans and sinks. Paths are Spark paths; nothing is opened on the driver."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SQUARE_METRES_PER_MILE = 2_589_988


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that all executors share; a local one only in local mode."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/tables-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df written to a scratch path and read again: cuts lineage, and what is read twice is computed once."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scan_delimited(spark: SparkSession, paths: str | list[str], schema: str | T.StructType, sep: str = ",", header: bool = True, comment: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema).option("sep", sep).option("header", header)
    return (reader.option("comment", comment) if comment else reader).csv(paths)


def scan_fixed_width(spark: SparkSession, path: str | list[str], layout: list[tuple[str, int, int, str]], keep: Column | None = None) -> DataFrame:
    """layout: (name, start from 0, width, type); keep is a test on the line, column ``value``."""
    lines = spark.read.text(path)
    return slice_columns(lines if keep is None else lines.filter(keep), layout)


def slice_columns(lines: DataFrame, layout: list[tuple[str, int, int, str]]) -> DataFrame:
    cut = lambda a, n: F.trim(F.substring("value", a + 1, n))
    return lines.select(*[(cut(a, n) if kind == "string" else cut(a, n).try_cast(kind)).alias(name) for name, a, n, kind in layout])


def scan_piped_protected(spark: SparkSession, path: str | list[str], schema: str | None = None) -> DataFrame:
    """A ``|`` file with # comment lines and a header; strings where no schema is given."""
    reader = spark.read.option("sep", "|").option("comment", "#").option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


GEO_PARTS = ["TABBLKST", "TABBLKCOU", "TABTRACTCE", "TABBLKGRPCE", "TABBLK"]


def scan_geo_reference(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return geo_reference(scan_delimited(spark, path, ", ".join(f"{c} string" for c in [*GEO_PARTS, "OIDTABBLK"]), "|"))


def geo_reference(ref: DataFrame, parts: list[str] = GEO_PARTS, block: str = "OIDTABBLK") -> DataFrame:
    """Distinct (block id, geocode); a null in either stops the job."""
    out = ref.select(F.col(block), F.concat(*parts).alias("geocode")).distinct()
    ok = F.col(block).isNotNull() & F.col("geocode").isNotNull()
    return out.withColumn("geocode", F.when(ok, F.col("geocode")).otherwise(F.raise_error(F.lit("null block or geography code")).cast("string")))


def scan_area_reference(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return area_reference(scan_delimited(spark, path, ", ".join(f"{c} string" for c in [*GEO_PARTS, "AREALAND", "AREAWATER"]), "|"))


def area_reference(ref: DataFrame, parts: list[str] = GEO_PARTS, land: str = "AREALAND", water: str = "AREAWATER") -> DataFrame:
    """(geocode, land, water, area) in square miles from square metres."""
    mile = lambda c: F.col(c).try_cast("long") / F.lit(SQUARE_METRES_PER_MILE)
    return ref.select(F.concat(*parts).alias("geocode"), mile(land).alias("land"), mile(water).alias("water"), (mile(land) + mile(water)).alias("area"))


def add_run_metadata(df: DataFrame, values: dict) -> DataFrame:
    """Literal columns for the values that are not null."""
    return df.withColumns({k: F.lit(v) for k, v in values.items() if v is not None})


def run_path_metadata(df: DataFrame, path: Column | None = None) -> DataFrame:
    """plb, run_id and budget_group out of path text such as ``.../td001-cPct/data-run3.0-epsilon1.0E-2-...``."""
    p = F.input_file_name() if path is None else path
    number = r"((?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)"
    got = lambda pattern: F.nullif(F.regexp_extract(p, pattern, 1), F.lit(""))
    return df.withColumns({"plb": got(rf"(?:epsilon|plb|rho)[_=-]?{number}").try_cast("double"), "run_id": F.concat(F.lit("run_"), got(r"run[_=-]?(\d+)")), "budget_group": got(r"(td[0-9A-Za-z]+)")})


def scan_runs(spark: SparkSession, runs: dict[str, dict], form: str = "parquet") -> DataFrame:
    """Outputs of several runs, {path: its metadata}, tagged and united by column name."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [add_run_metadata(spark.read.format(form).load(p), meta) for p, meta in runs.items()])


def load_saved_measurements(spark: SparkSession, root: str, run: str, level: str | None = None, stage: str = "noisy") -> DataFrame:
    """Written by sink_measurements; run, stage and level are folders, so only theirs are read."""
    out = spark.read.parquet(root).filter((F.col("run") == run) & (F.col("stage") == stage))
    return out if level is None else out.filter(F.col("geolevel") == level)


# sinks


def sink_piped_sorted(df: DataFrame, path: str, order: list[str], comment: str | None = None) -> None:
    """Range-partitioned by the order columns and sorted in each part: the parts in turn are in order."""
    df.orderBy(*order).write.mode("overwrite").option("sep", "|").option("header", True).csv(path)


def sink_with_metadata(df: DataFrame, path: str, meta: dict) -> DataFrame:
    """The data as ``path``/data with a header, and one row about it as ``path``/meta; returns that row."""
    df.write.mode("overwrite").option("sep", "|").option("header", True).csv(f"{path}/data")
    about = add_run_metadata(df.sparkSession.read.option("sep", "|").option("header", True).csv(f"{path}/data").agg(F.count(F.lit(1)).alias("records")), meta).withColumn("created", F.current_timestamp())
    about.write.mode("overwrite").json(f"{path}/meta")
    return about


def sink_multi(df: DataFrame, layouts: dict[str, list[Column | str]], form: str = "parquet") -> None:
    """One result in several layouts, {path: columns}; it is computed once."""
    held = df.persist()
    for path, columns in layouts.items():
        held.select(*columns).write.mode("overwrite").format(form).save(path)
    held.unpersist()


def sink_block_table(df: DataFrame, path: str, columns: list[str]) -> None:
    df.select(*columns).write.mode("overwrite").parquet(path)


def sink_measurements(df: DataFrame, root: str, run: str, stage: str = "noisy", by_parent: int | None = None) -> None:
    """Measurements by level; by_parent = number of parts, each with whole families."""
    out = df.withColumns({"run": F.lit(run), "stage": F.lit(stage)})
    out = out.repartition(by_parent, "parent_geocode") if by_parent else out
    out.write.mode("overwrite").partitionBy("run", "stage", "geolevel").parquet(root)


def drop_true_counts(df: DataFrame, columns: tuple[str, ...] = ("orig", "raw", "truth", "raw_housing")) -> DataFrame:
    out = df.drop(*columns)
    if left := set(columns) & set(out.columns):
        raise ValueError(f"true counts remain: {sorted(left)}")
    return out
