"""Counts back to records."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def repeat(df: DataFrame, count: str) -> DataFrame:
    """Each row as often as its count; 0 and less: not at all."""
    return df.filter(F.col(count) > 0).withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col(count).cast("long")))).drop("_k", count)


def expand_to_records(hist: DataFrame, count: str, layout: list[tuple[str, str]] | None = None) -> DataFrame:
    """One row per counted record, recoded by layout (column, expression) before it is repeated."""
    if layout is None:
        return repeat(hist, count)
    return repeat(hist.select(*[F.expr(e).alias(n) for n, e in layout], F.col(count).alias("_n")), "_n")


def counts_wide_by_block(hist: DataFrame, dim: str, levels: list, count: str = "cnt") -> DataFrame:
    out = hist.groupBy("geocode").pivot(dim, levels).agg(F.sum(count))
    return out.select("geocode", *[F.coalesce(F.col(str(v)), F.lit(0)).alias(f"n_{v}") for v in levels])


def expand_vacant_and_gq(households: DataFrame, units: DataFrame, vacant: str = "vacant") -> DataFrame:
    """Household records, vacant units (housing units less households) and facilities by type: (geocode, kind).

    households: (geocode, n); units: (geocode, kind, units) with kind "housing" among them.
    """
    j = units.join(households.select("geocode", F.col("n").alias("_h")), "geocode", "left").withColumn("_h", F.coalesce("_h", F.lit(0)))
    free = j.filter("kind = 'housing'").select("geocode", F.lit(vacant).alias("kind"), (F.col("units") - F.col("_h")).alias("n"))
    gq = units.filter("kind <> 'housing'").select("geocode", "kind", F.col("units").alias("n"))
    return repeat(households.select("geocode", F.lit("household").alias("kind"), F.col("n").cast("long").alias("n")).unionByName(free).unionByName(gq), "n")


def expand_gq_residual(hist: DataFrame, totals: DataFrame, count: str = "cnt") -> DataFrame:
    """A facility row for every unit that the histogram does not count. totals: (geocode, units)."""
    s = hist.groupBy("geocode").agg(F.sum(count).alias("_s"))
    return repeat(totals.join(s, "geocode", "left").select("geocode", F.lit("gq").alias("kind"), (F.col("units") - F.coalesce("_s", F.lit(0))).alias("n")), "n")


def assign_detail_in_order(records: DataFrame, detail: DataFrame, keys: list[str], order: list[str], labels: tuple[str, str], out: str = "detail") -> DataFrame:
    """The first k records of each key get the first label, the others the second; detail: (keys, k)."""
    k = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return records.join(detail, keys, "left").withColumn(out, F.when(k <= F.coalesce("k", F.lit(0)), labels[0]).otherwise(labels[1])).drop("k")
