"""Checks of output tables against input tables. Each returns the rows that break its rule."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_PER_UNIT = 99_999


def val_unit_reference(unit: DataFrame, ref: DataFrame, key: str = "geocode") -> DataFrame:
    return unit.join(ref.select(key), key, "left_anti")


def _total(a: DataFrame, b: DataFrame) -> DataFrame:
    n = lambda df, c: df.agg(F.count(F.lit(1)).alias("n")).select("n", F.lit(c).alias("side"))
    both = n(a, "a").unionByName(n(b, "b"))
    return both.agg(F.max(F.when(F.col("side") == "a", F.col("n"))).alias("n_a"), F.max(F.when(F.col("side") == "b", F.col("n"))).alias("n_b")).withColumn("equal", F.col("n_a") == F.col("n_b"))


def val_unit_total(a: DataFrame, b: DataFrame) -> DataFrame:
    return _total(a, b)


def val_person_total(a: DataFrame, b: DataFrame) -> DataFrame:
    return _total(a, b)


def val_type_counts(a: DataFrame, b: DataFrame, keys: list[str], how: str = "full") -> DataFrame:
    """Keys with different counts; without the type among the keys this is the type-free check."""
    n = lambda df, c: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(c))
    j = n(a, "n_a").join(n(b, "n_b"), keys, how).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_a", "n_b")})
    return j.filter("n_a <> n_b")


def val_occupied(unit: DataFrame, occupied: str, allowed: str) -> DataFrame:
    """Occupied rows whose codes are not allowed (both tests are predicates)."""
    return unit.filter(F.expr(occupied) & ~F.coalesce(F.expr(allowed), F.lit(False)))


def val_household_types(unit: DataFrame, impossible: list[str]) -> DataFrame:
    """(rule, n) of rows with an impossible size and type."""
    hit = F.array_compact(F.array(*[F.when(F.expr(r), F.lit(r)) for r in impossible]))
    return unit.select(F.explode(hit).alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


def val_vacancy_moves(a: DataFrame, b: DataFrame, vacant: str) -> DataFrame:
    """Blocks by how vacancies moved: none in a but some in b, all in a but not all in b, and the reverse of each."""
    s = lambda df, p: df.groupBy("geocode").agg(F.bool_or(F.expr(vacant)).alias(f"{p}_some"), F.bool_and(F.expr(vacant)).alias(f"{p}_all"))
    j = s(a, "a").join(s(b, "b"), "geocode")
    kinds = [("new_vacancy", ~F.col("a_some") & F.col("b_some")), ("lost_vacancy", F.col("a_some") & ~F.col("b_some")), ("new_occupied", F.col("a_all") & ~F.col("b_all")), ("lost_occupied", ~F.col("a_all") & F.col("b_all"))]
    return j.select("geocode", F.explode(F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in kinds]))).alias("move"))


def _per_facility(persons: DataFrame, units: DataFrame, keys: list[str], how: str) -> DataFrame:
    n = lambda df, c: df.groupBy(*keys).agg(F.count(F.lit(1)).alias(c))
    return n(units, "units").join(n(persons, "persons"), keys, how).withColumns({c: F.coalesce(c, F.lit(0)) for c in ("units", "persons")})


def val_person_per_gq(persons: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    return _per_facility(persons, units, keys, "left").filter("persons < units")


def val_gq_absent(persons: DataFrame, units: DataFrame, keys: list[str]) -> DataFrame:
    """Persons where there is no facility."""
    return persons.join(units.select(*keys).distinct(), keys, "left_anti").groupBy(*keys).agg(F.count(F.lit(1)).alias("persons"))


def val_max_per_unit(persons: DataFrame, units: DataFrame, keys: list[str], most: int = MAX_PER_UNIT) -> DataFrame:
    return _per_facility(persons, units, keys, "left").filter(F.col("persons") > most * F.col("units"))


def val_lower_bounds(persons: DataFrame, units: DataFrame, geo: str, kind: str, levels: list) -> DataFrame:
    """Blocks and types with fewer persons than facilities, by one-hot sums."""
    return _bounds(persons, units, geo, kind, levels, lambda p, u: p < u)


def val_upper_bounds(persons: DataFrame, units: DataFrame, geo: str, kind: str, levels: list, most: int = MAX_PER_UNIT) -> DataFrame:
    return _bounds(persons, units, geo, kind, levels, lambda p, u: p > most * u)


def _bounds(persons, units, geo, kind, levels, broken) -> DataFrame:
    hot = lambda df, c: df.groupBy(geo).agg(*[F.count_if(F.col(kind) == v).alias(f"{c}{i}") for i, v in enumerate(levels)])
    j = hot(persons, "p").join(hot(units, "u"), geo, "full_outer")
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    rows = [F.when(broken(z(f"p{i}"), z(f"u{i}")), F.struct(F.lit(v).alias(kind), z(f"p{i}").alias("persons"), z(f"u{i}").alias("units"))) for i, v in enumerate(levels)]
    return j.select(geo, F.explode(F.array_compact(F.array(*rows))).alias("x")).select(geo, "x.*")


def val_state_totals(a: DataFrame, b: DataFrame, length: int) -> DataFrame:
    n = lambda df, c: df.groupBy(F.substring("geocode", 1, length).alias("state")).agg(F.count(F.lit(1)).alias(c))
    return n(a, "n_a").join(n(b, "n_b"), "state", "full_outer").withColumns({c: F.coalesce(c, F.lit(0)) for c in ("n_a", "n_b")}).withColumn("equal", F.col("n_a") == F.col("n_b"))


def val_sql_pairs(spark: SparkSession, pairs: dict[str, tuple[str, str]], inputs: dict[str, DataFrame]) -> DataFrame:
    """(check, violations): rows that the two statements of a pair do not share. inputs: the tables' names in them."""
    for name, df in inputs.items():
        df.createOrReplaceTempView(name)
    resolved = {name: (spark.sql(x), spark.sql(y)) for name, (x, y) in pairs.items()}
    for name in inputs:
        spark.catalog.dropTempView(name)
    out = []
    for name, (a, b) in resolved.items():
        out.append(a.exceptAll(b).unionByName(b.exceptAll(a)).agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("check"), "violations"))
    return reduce(DataFrame.unionByName, out)


def val_report(checks: dict[str, DataFrame]) -> DataFrame:
    """(check, violations, passed) of checks that return violating rows."""
    rows = [df.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(n).alias("check"), "violations") for n, df in checks.items()]
    return reduce(DataFrame.unionByName, rows).withColumn("passed", F.col("violations") == 0)
