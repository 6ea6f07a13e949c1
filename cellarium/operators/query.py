"""Linear counting queries on histograms, by name or by definition."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import UNMAPPED, Schema, recode_column
from ..functions.dims import query_levels as _levels
from .recode import flat_index


def query_subset_marginal(hist: DataFrame, subset: dict[str, list[int]], keep: list[str], count: str = "cnt") -> DataFrame:
    for d, ix in subset.items():
        hist = hist.filter(F.col(d).isin(ix))
    return hist.groupBy("geocode", *keep).agg(F.sum(count).alias(count))


def query_grouped_marginal(hist: DataFrame, groups: dict[str, dict[str, tuple[int, ...]]], count: str = "cnt") -> DataFrame:
    """groups: dimension -> {label: levels}; unmapped levels drop, dimensions not named are added over."""
    cols = {d: recode_column(F.col(d), {i: g for g, ix in gs.items() for i in ix}) for d, gs in groups.items()}
    out = hist.withColumns(cols)
    for d in groups:
        out = out.filter(F.col(d) != UNMAPPED)
    return out.groupBy("geocode", *groups).agg(F.sum(count).alias(count))


def query_total(hist: DataFrame, count: str = "cnt") -> DataFrame:
    return hist.groupBy("geocode").agg(F.sum(count).alias(count))


def query_detailed(hist: DataFrame, dims: list[str], count: str = "cnt") -> DataFrame:
    return hist.groupBy("geocode", *dims).agg(F.sum(count).alias(count))


def query_by_name(hist: DataFrame, name: str, schema: Schema, count: str = "cnt") -> DataFrame:
    """Columns of the query's dimensions with group labels."""
    return query_grouped_marginal(hist, {d.name: groups for d, groups in schema.parse(name)}, count)


def query_answer(df: DataFrame, name: str, schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """(keys, query, level, counts) of one named query; keys are never summed."""
    return df.withColumn("level", schema.level(name)).filter("level is not null").groupBy(*keys, "level").agg(*[F.sum(c).alias(c) for c in counts]).withColumn("query", F.lit(name))


def query_answer_many(df: DataFrame, names: list[str], schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """All queries in one pass and one shuffle: a row is spread over its (query, level) pairs, then summed.

    The histogram is summed over its dims first, so what is spread is a cell, not a record.
    """
    cells = df.groupBy(*keys, *schema.names).agg(*[F.sum(c).alias(c) for c in counts])
    pairs = F.array(*[F.struct(F.lit(n).alias("query"), schema.level(n).alias("level")) for n in names])
    spread = cells.withColumn("_q", F.explode(F.filter(pairs, lambda x: x["level"].isNotNull())))
    return spread.groupBy(*keys, F.col("_q.query").alias("query"), F.col("_q.level").alias("level")).agg(*[F.sum(c).alias(c) for c in counts])


def query_combo(hist: DataFrame, schema: Schema, coef: dict[str, float], keys: list[str], count: str = "cnt") -> DataFrame:
    """Linear combination of queries with like levels: sum of coefficient times answer by level."""
    answers = query_answer_many(hist, list(coef), schema, keys, (count,))
    weight = recode_column(F.col("query"), {}, None).cast("double")
    for n, c in coef.items():
        weight = F.when(F.col("query") == n, F.lit(float(c))).otherwise(weight)
    return answers.groupBy(*keys, "level").agg(F.sum(weight * F.col(count)).alias("answer"))


def query_multi_hist(hists: list[tuple[DataFrame, str, float]], schema: Schema, keys: list[str], count: str = "cnt") -> DataFrame:
    """Sum over universes of coefficient times answer: (histogram, query, coefficient)."""
    parts = [query_answer(h, q, schema, keys, (count,)).select(*keys, "level", (F.col(count) * c).alias("x")) for h, q, c in hists]
    return reduce(DataFrame.unionByName, parts).groupBy(*keys, "level").agg(F.sum("x").alias("answer"))


def query_predicate_pair(hist: DataFrame, predicate: str, count: str = "cnt") -> DataFrame:
    hit = F.expr(predicate)
    return hist.groupBy("geocode").agg(F.sum(F.when(hit, F.col(count)).otherwise(0)).alias("inside"), F.sum(F.when(hit, 0).otherwise(F.col(count))).alias("outside"))


def query_sparse_matrix(hist: DataFrame, matrix: DataFrame, dims: list[str], shape: list[int], count: str = "cnt") -> DataFrame:
    """Any linear query as (row, cell, coef) on flat indices."""
    return flat_index(hist, dims, shape).join(matrix, "cell").groupBy("geocode", "row").agg(F.sum(F.col("coef") * F.col(count)).alias("answer"))


def marginal_names(schema: Schema, n: int, ignore: tuple[str, ...] = (), include: tuple[str, ...] = ()) -> list[str]:
    """Names of the crossings of up to n dimensions or recodes of different dimensions."""
    terms = [(d.name, t) for d in schema.dims for t in (d.name, *d.recodes) if t not in ignore]
    out = ["total"]
    for k in range(1, n + 1):
        out += [" * ".join(t for _, t in c) for c in combinations(terms, k) if len({d for d, _ in c}) == k]
    return [x for x in out if not include or x in include]


def query_all_marginals(hist: DataFrame, dims: list[str], count: str = "cnt", most: int | None = None) -> DataFrame:
    """Every crossing of up to ``most`` dimensions by one CUBE; dims added over are null, ``n_dims`` tells how many are kept."""
    kept = reduce(lambda a, b: a + b, [1 - F.grouping(d).cast("int") for d in dims])
    out = hist.cube("geocode", *dims).agg(F.sum(count).alias(count), kept.alias("n_dims"), F.grouping("geocode").alias("_all"))
    out = out.filter("_all = 0").drop("_all")
    return out if most is None else out.filter(F.col("n_dims") <= most)


def query_levels(spark: SparkSession, name: str, schema: Schema) -> DataFrame:
    return _levels(spark, name, schema)


def table_product(df: DataFrame, tables: dict[str, list[str]], names: list[str], schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """Published tables: (table_name, keys, query, level, counts); a query that two tables share is answered once."""
    need = list(dict.fromkeys(q for t in names for q in tables[t]))
    of = F.create_map(*[x for q in need for x in (F.lit(q), F.lit([t for t in names if q in tables[t]]))])
    return query_answer_many(df, need, schema, keys, counts).withColumn("table_name", F.explode(of[F.col("query")]))


def table_full_workload(df: DataFrame, names: list[str], schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """df with a zero row for every (query, level) that a key lacks, marked ``was_missing``."""
    levels = {n: [" BY ".join(x) if x else "total" for x in _cross([list(g) for _, g in schema.parse(n)])] for n in names}
    pairs = lambda n, ls: F.transform(F.lit(ls), lambda level: F.struct(F.lit(n).alias("query"), level.alias("level")))
    want = F.flatten(F.array(*[pairs(n, ls) for n, ls in levels.items()]))
    every = df.select(*keys).distinct().withColumn("_w", F.explode(want)).select(*keys, F.col("_w.query").alias("query"), F.col("_w.level").alias("level"))
    out = every.join(df, [*keys, "query", "level"], "left")
    return out.withColumn("was_missing", F.col(counts[0]).isNull()).withColumns({c: F.coalesce(c, F.lit(0)) for c in counts})


def _cross(parts: list[list[str]]) -> list[list[str]]:
    return reduce(lambda a, b: [[*x, y] for x in a for y in b], parts, [[]])


def table_missing_counts(df: DataFrame, names: list[str], schema: Schema, keys: list[str]) -> DataFrame:
    full = table_full_workload(df, names, schema, keys)
    return full.groupBy("geolevel").agg(F.sum(F.col("was_missing").cast("long")).alias("missing"))


def sql_table_pipeline(spark: SparkSession, inputs: dict[str, DataFrame], pre: dict[str, str], noise: dict[str, tuple[str, str]], post: dict[str, str]) -> dict[str, DataFrame]:
    """Named SQL tables: pre-noise statements in order; noise {table: (measure, noise expression)} adds a noisy twin

    ``<table>_noisy``; every post statement (with {t} for the table's suffix) runs on the true and the noisy tables.
    """
    made = [*inputs, *pre, *[f"{name}_noisy" for name in noise]]
    try:
        for name, df in inputs.items():
            df.createOrReplaceTempView(name)
        for name, statement in pre.items():
            spark.sql(statement).createOrReplaceTempView(name)
        for name, (measure, extra) in noise.items():
            t = spark.table(name)
            t.withColumn(measure, F.expr(f"{measure} + ({extra})")).createOrReplaceTempView(f"{name}_noisy")
        return {f"{name}{kind}": spark.sql(statement.replace("{t}", kind)) for name, statement in post.items() for kind in ("", "_noisy")}
    finally:  # the results are resolved; the session keeps no names
        for name in made:
            spark.catalog.dropTempView(name)


def sql_add_drop_measures(df: DataFrame, add: dict[str, str], drop: list[str]) -> DataFrame:
    return df.withColumns({k: F.expr(e) for k, e in add.items()}).drop(*drop)


def geolevel_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("geolevel").agg(F.count_distinct("geocode").alias("geounits"))


def num_obs(df: DataFrame) -> DataFrame:
    return df.select("geolevel", "plb", "geocode", "run_id").distinct().groupBy("geolevel", "plb").agg(F.count(F.lit(1)).alias("num_obs"))


def sum_by(df: DataFrame, keys: list[str], m: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in m])


def avg_by(df: DataFrame, keys: list[str], col: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg(col).alias(f"avg_{col}"))


def sql_population_by_block(df: DataFrame, count: str = "cnt") -> DataFrame:
    return df.groupBy("geocode").agg(F.sum(count).alias("population")).orderBy("geocode")


def sql_voting_age_by_block(df: DataFrame, age: str = "age", count: str = "cnt") -> DataFrame:
    return df.filter(F.col(age) >= 18).groupBy("geocode").agg(F.sum(count).alias("population")).orderBy("geocode")


def sql_age_pyramid(df: DataFrame, areas: list[str], age: str = "age", sex: str = "sex", count: str = "cnt") -> DataFrame:
    return df.groupBy(*areas, age, sex).agg(F.sum(count).alias("population")).orderBy(*areas, age, sex)
