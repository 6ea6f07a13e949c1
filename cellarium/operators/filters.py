"""Filters and record checks."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dims import UNMAPPED


def filter_test_area(df: DataFrame, geo_cols: list[str], prefix: str) -> DataFrame:
    return df.filter(F.concat(*geo_cols).startswith(prefix))


def filter_drop_unmapped(df: DataFrame, dims: list[str]) -> DataFrame:
    return df.filter(reduce(and_, [F.col(d).cast("string") != UNMAPPED for d in dims], F.lit(True)))


def geo_drop_not_in_area(df: DataFrame, sentinels: dict[str, str]) -> DataFrame:
    """sentinels: level -> the ending that means "not in any such area"; level names compare without case."""
    return df.filter(reduce(and_, [~((F.upper("geolevel") == level.upper()) & F.col("geocode").endswith(s)) for level, s in sentinels.items()], F.lit(True)))


def filter_level_regex(df: DataFrame, pattern: str, keep: bool = False, col: str = "level") -> DataFrame:
    hit = F.col(col).rlike(pattern)
    return df.filter(hit if keep else ~hit)


def filter_valid_geounit_trials(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the trials in which the true and the protected total are positive."""
    good = df.groupBy(*keys).agg(F.sum("orig").alias("o"), F.sum("priv").alias("p")).filter("o > 0 and p > 0")
    return df.join(good.select(*keys), keys, "left_semi")


def filter_population_cutoff(df: DataFrame, cutoff: int) -> DataFrame:
    return df.filter(F.col("orig") >= cutoff)


def filter_undefined_ratio(df: DataFrame, col: str = "L1Relative") -> DataFrame:
    return df.filter(F.col(col) != 2.0)


def filter_parent_nonzero(child: DataFrame, parent: DataFrame, cell: list[str], count: str = "cnt") -> DataFrame:
    """Child cells whose cell is not zero at the parent."""
    there = parent.filter(F.col(count) != 0).select(F.col("geocode").alias("parent_geocode"), *cell)
    return child.join(there, ["parent_geocode", *cell], "left_semi")


def check_legal_values(df: DataFrame, rules: dict[str, list[tuple]], key: str) -> DataFrame:
    """(key, column, value) of the values that lie in none of their column's closed ranges; null is illegal."""
    bad = [
        F.when(~F.coalesce(reduce(lambda a, b: a | b, [F.col(c).between(lo, hi) for lo, hi in ranges]), F.lit(False)), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")))
        for c, ranges in rules.items()
    ]
    return df.select(key, F.explode(F.array_compact(F.array(*bad))).alias("x")).select(key, "x.column", "x.value")


def check_record_layout(df: DataFrame, rules: list[tuple[str, str, object, object]]) -> DataFrame:
    """df with ``reasons`` and ``valid``. rules: (column, kind, a, b) with kind in

    range (a..b), enum (values a), width (length a), required, null_if (null exactly where the test b holds).
    """

    def test(c: str, kind: str, a, b) -> Column:
        x = F.col(c)
        return {
            "range": lambda: x.between(a, b), "enum": lambda: x.isin(a), "width": lambda: F.length(x.cast("string")) == a,
            "required": lambda: x.isNotNull(), "null_if": lambda: x.isNull() == F.coalesce(F.expr(str(b)), F.lit(False)),
        }[kind]()

    reasons = F.array_compact(F.array(*[F.when(~F.coalesce(test(c, k, a, b), F.lit(False)), F.lit(f"{c}: {k}")) for c, k, a, b in rules]))
    return df.withColumn("reasons", reasons).withColumn("valid", F.size("reasons") == 0)
