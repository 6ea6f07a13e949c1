"""Joins of records, histograms and measurements. No hint is given where a side can grow: AQE decides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_unit_geography(unit: DataFrame, ref: DataFrame, block: str = "block") -> DataFrame:
    """Units with their geocode; a unit without a known block stops the job."""
    out = unit.join(ref, block, "left")
    return out.withColumn("geocode", F.when(F.col("geocode").isNotNull(), F.col("geocode")).otherwise(F.raise_error(F.lit("unit without a known block")).cast("string")))


def join_person_unit(person: DataFrame, unit: DataFrame, key: str = "MAFID") -> DataFrame:
    return person.join(unit, key)


def join_two_universes(person_hist: DataFrame, unit_hist: DataFrame, keys: list[str], count: str = "persons") -> DataFrame:
    """Every unit row; persons 0 where there are none."""
    return person_hist.join(unit_hist, keys, "right").withColumn(count, F.coalesce(count, F.lit(0)))


def join_orig_priv(orig: DataFrame, priv: DataFrame, dims: list[str], run_values: dict | None = None) -> DataFrame:
    """Full outer join on geocode and dims; absent counts are 0, absent run labels the run's own."""
    out = orig.join(priv, ["geocode", *dims], "full_outer")
    fill = {c: F.coalesce(c, F.lit(0)) for c in ("orig", "priv") if c in out.columns}
    return out.withColumns(fill | {k: F.coalesce(k, F.lit(v)) if k in out.columns else F.lit(v) for k, v in (run_values or {}).items()})


def join_crosswalk(df: DataFrame, xwalk: DataFrame, levels: list[str]) -> DataFrame:
    """Only the area columns that df lacks."""
    lack = [x for x in levels if x not in df.columns]
    return df.join(xwalk.select("geocode", *lack), "geocode") if lack else df


def join_parent_children(parent: DataFrame, child: DataFrame, cell: list[str], count: str = "cnt") -> DataFrame:
    up = parent.select(F.col("geocode").alias("parent_geocode"), *cell, F.col(count).alias(f"parent_{count}"))
    return child.join(up, ["parent_geocode", *cell])


def join_lower_measurements(upper: DataFrame, lower: DataFrame) -> DataFrame:
    """A level's measurements beside the sums of its children's."""
    sums = lower.groupBy(F.col("parent_geocode").alias("geocode"), "query", "level").agg(F.sum("noisy").alias("child_noisy"), F.sum("variance").alias("child_variance"))
    return upper.join(sums, ["geocode", "query", "level"])


def join_ratio_denominator(df: DataFrame, denom_query: str = "total", denom_level: str = "total", keys: tuple[str, ...] = ("geolevel", "geocode")) -> DataFrame:
    """Query rows with their geounit's totals; a row without one stops the job."""
    total = df.filter((F.col("query") == denom_query) & (F.col("level") == denom_level)).select(*keys, F.col("orig").alias("orig_sum"), F.col("priv").alias("priv_sum"))
    out = df.filter(F.col("query") != denom_query).join(total, list(keys), "left")
    return out.withColumn("orig_sum", F.when(F.col("orig_sum").isNotNull(), F.col("orig_sum")).otherwise(F.raise_error(F.lit("no denominator")).cast("long")))


def join_population_area(pop: DataFrame, area: DataFrame) -> DataFrame:
    return pop.join(area, ["geocode", "geolevel"])


def join_race_to_total(groups: DataFrame, totals: DataFrame, keys: tuple[str, ...] = ("geocode", "geolevel", "run_id", "plb")) -> DataFrame:
    return groups.join(totals.select(*keys, F.col("orig").alias("orig_total"), F.col("priv").alias("priv_total")), list(keys))


def join_counts_by_type(a: DataFrame, b: DataFrame, keys: list[str], how: str = "full") -> DataFrame:
    """Counts of two tables by keys: (keys, n_a, n_b)."""
    count = lambda df, n: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(n))
    out = count(a, "n_a").join(count(b, "n_b"), keys, how)
    return out.withColumns({n: F.coalesce(n, F.lit(0)) for n in ("n_a", "n_b")})


def join_membership(df: DataFrame, ref: DataFrame, key: str) -> DataFrame:
    return df.join(ref, key, "left_semi")


def join_range_codes(df: DataFrame, ranges: DataFrame, col: str) -> DataFrame:
    """Codes to the closed ranges they lie in; ranges are a fixed table of a few dozen rows."""
    return df.join(F.broadcast(ranges), F.col(col).between(F.col("lo"), F.col("hi")))
