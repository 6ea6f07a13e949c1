"""Quantiles, order, record numbers and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..sources.files import scratch, written


def exact_quantiles(df: DataFrame, keys: list[str], value: Column, probs: list[float], name: str = "q") -> DataFrame:
    """(keys, name): array of linear-interpolated quantiles of the values that are not null.

    Equal values are counted first. The counts are cut into ranges over (keys, value) and written, so one group may span any
    number of ranges. Sums by range and group, a few rows, tell in which range each wanted rank lies; only
    in those are running sums taken, inside the range, and only the rows that the ranks hit are kept.
    """
    n = df.select(F.struct(*keys, F.lit(0)).alias("_k"), value.cast("double").alias("_v")).filter("_v is not null").groupBy("_k", "_v").agg(F.count(F.lit(1)).alias("_c"))
    rows = written(written(n).repartitionByRange("_k", "_v").withColumn("_part", F.spark_partition_id()))  # bounds come from a sample of what is written
    group = Window.partitionBy("_k")  # a row per range
    sums = rows.groupBy("_k", "_part").agg(F.sum("_c").alias("_m"))
    sums = sums.withColumns({"_n": F.sum("_m").over(group), "_before": F.sum("_m").over(group.orderBy("_part")) - F.col("_m")})
    at = [(F.col("_n") - 1) * F.lit(float(p)) for p in probs]
    ranks = [F.struct(F.lit(2 * i + side).alias("place"), end(x).cast("long").alias("rank")) for i, x in enumerate(at) for side, end in enumerate((F.floor, F.ceil))]
    wanted = F.filter(F.array(*ranks), lambda r: (r["rank"] >= F.col("_before")) & (r["rank"] < F.col("_before") + F.col("_m")))
    hit = sums.withColumn("_want", wanted).filter(F.size("_want") > 0).select("_k", "_part", "_n", "_before", "_want")
    near = rows.join(hit, ["_k", "_part"])  # structs with nulls in them compare as equal
    near = near.withColumn("_to", F.col("_before") + F.sum("_c").over(Window.partitionBy("_k", "_part").orderBy("_v")))
    here = F.filter("_want", lambda r: (r["rank"] >= F.col("_to") - F.col("_c")) & (r["rank"] < F.col("_to")))
    picked = near.withColumn("_here", here).filter(F.size("_here") > 0).select("_k", "_n", "_v", F.inline("_here"))
    ends = picked.groupBy("_k", "_n").agg(F.map_from_entries(F.collect_list(F.struct("place", "_v"))).alias("_e"))  # two rows a quantile
    low, high = (lambda i: F.col("_e")[2 * i]), (lambda i: F.col("_e")[2 * i + 1])
    return ends.select(*[F.col("_k")[k].alias(k) for k in keys], F.array(*[low(i) + (high(i) - low(i)) * (x - F.floor(x)) for i, x in enumerate(at)]).alias(name))


def beside_quantiles(stats: DataFrame, quantiles: DataFrame, keys: list[str]) -> DataFrame:
    """stats with the quantiles' array; keys may be null."""
    right = quantiles.toDF(*[f"_{k}" for k in keys], quantiles.columns[-1])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return stats.join(right, on, "left").drop(*[f"_{k}" for k in keys])


def quantile_group(df: DataFrame, cols: list[str], keys: list[str], probs: list[float]) -> DataFrame:
    """(keys, quantile, cols): linear-interpolated quantiles, long by quantile."""
    long = df.select(*keys, F.explode(F.array(*[F.struct(F.lit(c).alias("_col"), F.col(c).cast("double").alias("_value")) for c in cols])).alias("_x")).select(*keys, "_x.*")
    q = exact_quantiles(long, [*keys, "_col"], F.col("_value"), probs, "_q")
    wide = q.groupBy(*keys).agg(*[F.first(F.when(F.col("_col") == c, F.col("_q")), ignorenulls=True).alias(c) for c in cols])
    rows = F.arrays_zip(F.lit(probs).alias("quantile"), *[F.col(c) for c in cols])
    return wide.select(*keys, F.explode(rows).alias("x")).select(*keys, F.col("x.quantile").alias("quantile"), *[F.col(f"x.{c}").alias(c) for c in cols])


def quantile_approx(df: DataFrame, col: str, probs: list[float], err: float = 1e-6) -> DataFrame:
    """Quantiles of a whole column from mergeable sketches with the relative rank error given."""
    q = df.agg(F.percentile_approx(col, probs, max(1, round(1 / err))).alias("v"))
    return q.select(F.explode(F.arrays_zip(F.lit(probs).alias("quantile"), F.col("v").alias("v"))).alias("x")).select("x.quantile", F.col("x.v").alias(col))


def quantile_weighted_age(df: DataFrame, keys: list[str], age: str, probs: list[float], cols: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """Quantiles of age with the counts as frequencies: no record is expanded."""
    q = df.groupBy(*keys).agg(*[F.expr(f"percentile({age}, array({', '.join(map(str, probs))}), {c})").alias(c) for c in cols])
    rows = F.transform(F.lit(list(range(len(probs)))), lambda i: F.struct(F.get(F.lit(probs), i).alias("quantile"), *[F.get(F.col(c), i).alias(c) for c in cols]))
    return q.select(*keys, F.explode(rows).alias("x")).select(*keys, "x.*")


def category_age_quantiles(df: DataFrame, category: str, probs: list[float], age: str = "age") -> DataFrame:
    """By (category, geolevel, plb, quantile): mean error of age quantiles over valid trials, and the share of valid trials.

    All categories in one job. A trial (geocode, run) is valid where both totals are positive.
    """
    keys = [category, "geolevel", "plb", "geocode", "run_id"]
    totals = df.groupBy(*keys).agg(F.sum("orig").alias("o"), F.sum("priv").alias("p")).withColumn("valid", (F.col("o") > 0) & (F.col("p") > 0))
    obs = totals.groupBy(category, "geolevel", "plb").agg(F.avg(F.col("valid").cast("double")).alias("survival"))
    good = df.join(totals.filter("valid").select(*keys), keys, "left_semi")
    q = quantile_weighted_age(good, keys, age, probs)
    mean = q.groupBy(category, "geolevel", "plb", "quantile").agg(F.avg(F.abs(F.col("priv") - F.col("orig"))).alias("mean_l1"))
    return mean.join(obs, [category, "geolevel", "plb"])


def check_sorted(spark: SparkSession, path: str, order: list[str], form: str = "parquet", **options) -> DataFrame:
    """Number of places at which a stored table breaks the order, its files taken by name.

    Inside a block of a file neighbours are compared; across blocks one row each (first and last key) is.
    """
    df = spark.read.format(form).options(**options).load(path)
    place = ["_metadata.file_path", "_metadata.file_block_start"]
    rows = df.select(*place, F.monotonically_increasing_id().alias("at"), F.struct(*order).alias("k"))
    block = ["file_path", "file_block_start"]
    inner = rows.withColumn("before", F.lag("k").over(Window.partitionBy(*block).orderBy("at")))
    broken = inner.agg(F.coalesce(F.sum((F.col("before") > F.col("k")).cast("long")), F.lit(0)).alias("n"))
    edges = rows.groupBy(*block).agg(F.min_by("k", "at").alias("first"), F.max_by("k", "at").alias("last"))  # a row per block
    across = edges.withColumn("before", F.lag("last").over(Window.orderBy(*block))).agg(F.coalesce(F.sum((F.col("before") > F.col("first")).cast("long")), F.lit(0)).alias("n"))
    return broken.unionByName(across).agg(F.sum("n").alias("violations"))


def record_number(df: DataFrame, order: list[str], out: str = "record_number") -> DataFrame:
    """Consecutive numbers from 1 in order, without a single task that sees all rows.

    Spark cuts the rows into ranges by sampled bounds of all order columns and a tie-break, so neither a common
    prefix nor a value that many rows share makes a range large. The ranges are written once, counted, and
    numbered each from the count of those before it.
    """
    ranged = df.withColumn("_at", F.monotonically_increasing_id()).repartitionByRange(*order, "_at").withColumn("_part", F.spark_partition_id())
    path = scratch(df.sparkSession)
    ranged.write.parquet(path)
    rows = df.sparkSession.read.schema(ranged.schema).parquet(path)
    count = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))  # a row per range
    count = count.withColumn("_before", F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return rows.join(F.broadcast(count), "_part").withColumn(out, F.row_number().over(Window.partitionBy("_part").orderBy(*order, "_at")) + F.col("_before")).drop("_part", "_before", "_at")


def top_failed(df: DataFrame, predicate: Column | str, k: int, order: list[str]) -> DataFrame:
    """The first k failing rows, and how many fail in all."""
    bad = df.filter(predicate)
    n = bad.agg(F.count(F.lit(1)).alias("failures")).first()["failures"]
    return bad.orderBy(*order).limit(k).withColumn("failures", F.lit(n).cast("long"))


def set_union_by_name(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def set_subtract(a: DataFrame, b: DataFrame, all_rows: bool = False) -> DataFrame:
    """Rows of a that are not in b; repeats go unless all_rows."""
    return a.exceptAll(b) if all_rows else a.subtract(b)


def set_distinct(df: DataFrame) -> DataFrame:
    return df.distinct()


def set_dedup(df: DataFrame, cols: list[str], order: list[str]) -> DataFrame:
    """One row for each combination of cols: the first by order."""
    others = [c for c in df.columns if c not in cols]
    return df.groupBy(*cols).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("x")).select(*cols, "x.*")
