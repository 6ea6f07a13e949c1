"""Histograms as long tables (geocode, dims, count); an absent row is a zero cell."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dims import Schema
from .geo import Hier, prefixes
from .recode import flat_index


def hist_sparse(df: DataFrame, geo: str, dims: list[str], count: str = "cnt") -> DataFrame:
    return df.groupBy(geo, *dims).agg(F.count(F.lit(1)).alias(count))


def hist_nested(hist: DataFrame, geo: str, dims: list[str], shape: list[int], count: str = "cnt") -> DataFrame:
    """One row per geounit with its (flat index, count) pairs in order: at most the schema's size each."""
    return flat_index(hist, dims, shape).groupBy(geo).agg(F.sort_array(F.collect_list(F.struct("cell", count))).alias("cells"))


def hist_dense(hist: DataFrame, schema: Schema, geo: str = "geocode", count: str = "cnt") -> DataFrame:
    """A row for every cell of every geounit. Cells come from sequences, so no table is multiplied by another."""
    out = hist.select(geo).distinct()
    for d in schema.dims:
        out = out.withColumn(d.name, F.explode(F.sequence(F.lit(0), F.lit(d.size - 1))))
    return out.join(hist, [geo, *schema.names], "left").withColumn(count, F.coalesce(count, F.lit(0)))


def hist_nonzero(hist: DataFrame, geocodes: DataFrame, dims: list[str]) -> DataFrame:
    """Rows with a true or a protected count; one placeholder row (null dims) for a geounit without any."""
    some = hist.filter("orig <> 0 or priv <> 0")
    empty = geocodes.select("geocode").distinct().join(some.select("geocode").distinct(), "geocode", "left_anti")
    return some.select("geocode", *dims, "orig", "priv").unionByName(empty.select("geocode", *[F.lit(None).cast("int").alias(d) for d in dims], F.lit(0).cast("long").alias("orig"), F.lit(0).cast("long").alias("priv")))


def hist_units_from_persons(df: DataFrame, geo: str, kind: str, uid: str) -> DataFrame:
    return df.select(geo, kind, uid).distinct().groupBy(geo, kind).agg(F.count(F.lit(1)).alias("units"))


def hist_from_output(df: DataFrame, geo_parts: list[str], dims: dict[str, str], run_values: dict | None = None) -> DataFrame:
    """Counts of output records by geocode and recoded dims (name -> expression)."""
    cols = [F.concat(*geo_parts).alias("geocode"), *[F.expr(e).alias(n) for n, e in dims.items()], *[F.lit(v).alias(k) for k, v in (run_values or {}).items()]]
    return df.select(*cols).groupBy("geocode", *dims, *(run_values or {})).agg(F.count(F.lit(1)).alias("priv"))


def hist_arith(a: DataFrame, b: DataFrame | None, op: str, keys: list[str], count: str = "cnt") -> DataFrame:
    """add, subtract (two histograms); abs, square, sqrt (one); zero cells go. sum, max: over all cells by the first key."""
    if b is not None:
        sign = {"add": 1, "subtract": -1}[op]
        both = a.select(*keys, F.col(count)).unionByName(b.select(*keys, (F.col(count) * sign).alias(count)))
        return both.groupBy(*keys).agg(F.sum(count).alias(count)).filter(F.col(count) != 0)
    if op in ("sum", "max"):
        return a.groupBy(keys[0]).agg(getattr(F, op)(count).alias(count))
    f = {"abs": F.abs, "square": lambda c: F.col(c) * F.col(c), "sqrt": lambda c: F.sqrt(F.col(c).cast("double"))}[op]
    return a.withColumn(count, f(count))


def hist_equal(a: DataFrame, b: DataFrame, keys: list[str], tol: float = 0, count: str = "cnt") -> DataFrame:
    """Cells that differ, with both counts; empty if the histograms are equal."""
    both = a.select(*keys, F.col(count).alias("count_a")).join(b.select(*keys, F.col(count).alias("count_b")), keys, "full_outer")
    x, y = F.coalesce("count_a", F.lit(0)), F.coalesce("count_b", F.lit(0))
    return both.select(*keys, x.alias("count_a"), y.alias("count_b")).filter(F.abs(F.col("count_a") - F.col("count_b")) > tol)


def geo_rollup(hist: DataFrame, hier: Hier, dims: list[str], counts: tuple[str, ...] = ("cnt",)) -> DataFrame:
    """(geolevel, geocode, dims, counts) for every level, each from the one below: data shrinks on the way up."""
    (low, n), rest = hier[-1], list(reversed(hier[:-1]))
    now = hist.groupBy(F.substring("geocode", 1, n).alias("geocode"), *dims).agg(*[F.sum(c).alias(c) for c in counts])
    out = [now.withColumn("geolevel", F.lit(low))]
    for level, n in rest:
        now = now.groupBy((F.substring("geocode", 1, n) if n else F.lit("0")).alias("geocode"), *dims).agg(*[F.sum(c).alias(c) for c in counts])
        out.append(now.withColumn("geolevel", F.lit(level)))
    return reduce(DataFrame.unionByName, out).select("geolevel", "geocode", *dims, *counts)


def geo_rollup_any(df: DataFrame, hier: Hier, areas: list[str], keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """All chosen trunk levels and area columns in one aggregation: a row is spread over its geounits first."""
    at = prefixes(F.col("geocode"), hier) if hier else None
    off = F.array(*[F.struct(F.lit(a).alias("geolevel"), F.col(a).cast("string").alias("geocode")) for a in areas]) if areas else None
    spread = df.withColumn("_at", F.explode(F.concat(*[x for x in (at, off) if x is not None])))
    return spread.groupBy(F.col("_at.geolevel").alias("geolevel"), F.col("_at.geocode").alias("geocode"), *keys).agg(*[F.sum(c).alias(c) for c in counts])


def geo_rollup_area(area: DataFrame, levels: list[str], measures: list[str]) -> DataFrame:
    return geo_rollup_any(area, [], levels, [], tuple(measures))
