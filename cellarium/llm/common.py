"""What the corpus operators share: written tables, word rules and name-safe columns."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space and the ASCII controls from tab to carriage return.
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share; a local one only in local mode where none is configured (tests)."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def stored(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cellarium-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bind(value: Column, body) -> Column:
    """body(x) with x bound to value, so that value is computed once however often body uses it."""
    return F.transform(F.array(value), body)[0]


def text_of(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
