"""Accuracy of protected counts (priv) against true ones (orig).

Divisions by a zero count give null (``try_divide``), which sums and averages pass over; the row still
counts in n. Every panel is one aggregation, whatever the number of groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .joins import join_ratio_denominator
from .quantiles import beside_quantiles, exact_quantiles
from .recode import bin_counts, bin_digitize, bin_power10


def l1(a: str = "priv", b: str = "orig") -> Column:
    return F.abs(F.col(a) - F.col(b))


def ratio(a, b) -> Column:
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.try_divide(a.cast("double"), b.cast("double"))


def err_l1(df: DataFrame, name: str = "L1", col1: str = "priv", col2: str = "orig") -> DataFrame:
    return df.withColumn(name, l1(col1, col2))


def err_l2(df: DataFrame, name: str = "L2", col1: str = "priv", col2: str = "orig") -> DataFrame:
    return df.withColumn(name, ((F.col(col1) - F.col(col2)) * (F.col(col1) - F.col(col2))).cast("double"))


def err_signed(df: DataFrame, name: str = "signed_error", col1: str = "priv", col2: str = "orig") -> DataFrame:
    return df.withColumn(name, F.col(col1) - F.col(col2))


def err_l1_relative(df: DataFrame, denom_query: str = "total", denom_level: str = "total", keys: tuple[str, ...] = ("geolevel", "geocode")) -> DataFrame:
    """Difference of the two shares of the level with the largest protected count (the first by name on ties).

    0 where both totals are 0, 2 where just one is.
    """
    rows = join_ratio_denominator(df, denom_query, denom_level, keys)
    top = rows.groupBy(*keys, "query", F.col("priv_sum").alias("priv"), F.col("orig_sum").alias("orig")).agg(F.min(F.struct(-F.col("priv"), "level", F.col("orig").alias("o"), F.col("priv").alias("p"))).alias("m"))
    both, none = (F.col("orig") > 0) & (F.col("priv") > 0), (F.col("orig") == 0) & (F.col("priv") == 0)
    value = F.when(none, 0.0).when(both, F.abs(ratio(F.col("m.p"), F.col("priv")) - ratio(F.col("m.o"), F.col("orig")))).otherwise(2.0)
    return top.select(*keys, "query", "priv", "orig", value.alias("L1Relative"))


# the six metrics


def _panel() -> dict[str, Column]:
    n, d = F.count(F.lit(1)), F.col("priv") - F.col("orig")
    rms = F.sqrt(ratio(F.sum((d * d).cast("double")), n))
    return {
        "MAE": ratio(F.sum(F.abs(d)), n), "RMS": rms, "CoV": ratio(100 * rms, F.avg("orig")), "MAPE": 100 * ratio(F.coalesce(F.sum(ratio(F.abs(d), "orig")), F.lit(0.0)), n),
        "MALPE": 100 * ratio(F.coalesce(F.sum(ratio(d, "orig")), F.lit(0.0)), n), "CountMAPE10": F.count_if(ratio(F.abs(d), "orig") > 0.1).cast("double"), "Counts": n.cast("double"),
    }


def _one(df: DataFrame, name: str, by: list[str]) -> DataFrame:
    """One metric of the panel; 0 where there are no rows."""
    sums = df.groupBy(*by).agg(*[c.alias(k) for k, c in _panel().items() if k == name])
    return sums.select(*by, F.coalesce(name, F.lit(0.0)).cast("double").alias(name))


def metric_mae(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "MAE", by)


def metric_rmse(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "RMS", by)


def metric_cov(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "CoV", by)


def metric_mape(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "MAPE", by)


def metric_malpe(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "MALPE", by)


def metric_pct_over10(df: DataFrame, by: list[str] = []) -> DataFrame:  # noqa: B006
    return _one(df, "CountMAPE10", by)


def metric_panel_by(df: DataFrame, by: list[str]) -> DataFrame:
    """(by, metric, value): all six metrics and the number of rows for every group."""
    wide = df.groupBy(*by).agg(*[c.alias(k) for k, c in _panel().items()])
    names = list(_panel())
    pairs = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names])
    return wide.select(*by, F.explode(pairs).alias("x")).select(*by, "x.metric", "x.value")


def metric_panel(df: DataFrame) -> DataFrame:
    return metric_panel_by(df, [])


def metric_share_bins(total: DataFrame, sub: DataFrame, edges: list[float], keys: list[str]) -> DataFrame:
    """Panel of the subgroup's counts by bin of its true share of the total."""
    j = sub.join(total.select(*keys, F.col("orig").alias("all_orig")), keys).withColumn("share", ratio("orig", "all_orig"))
    c = F.when(F.col("share").isNull(), "undefined").when(F.col("share") < edges[0], f"< {edges[0]}")
    for a, b in zip(edges, edges[1:], strict=False):
        c = c.when(F.col("share") < b, f"[{a}, {b})")
    return metric_panel_by(j.withColumn("share_bin", c.otherwise(f">= {edges[-1]}")), ["share_bin"])


# total variation


def tvd_geounit(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(1 - ratio(l1(), 2 * F.col("orig"))).alias("one_minus_tvd"))


def tvd_geolevel(df: DataFrame, keys: list[str]) -> DataFrame:
    s = df.groupBy(*keys).agg(F.sum(l1()).alias("L1"), F.sum("orig").alias("orig"))
    return s.withColumn("one_minus_tvd", 1 - ratio("L1", 2 * F.col("orig")))


def tvd_query_level(df: DataFrame) -> DataFrame:
    """1 - L1 / (2 total) by query and level, with the level's total from its rows of query "total"."""
    total = df.filter("query = 'total'").groupBy("geolevel").agg(F.sum("orig").alias("pop"))
    s = df.filter("query <> 'total'").groupBy("query", "geolevel").agg(F.sum(l1()).alias("L1"))
    return s.join(total, "geolevel").select("query", "geolevel", (1 - ratio("L1", 2 * F.col("pop"))).alias("one_minus_tvd"))


# sparsity


def nonzero_cells(df: DataFrame, keys: list[str], cols: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.count_if(F.col(c) > 0).alias(f"{c}_nonzero") for c in cols])


def cell_density(df: DataFrame, keys: list[str], size: int, cols: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    return nonzero_cells(df, keys, cols).withColumns({f"{c}_celldensity": F.col(f"{c}_nonzero") / F.lit(size) for c in cols})


def cell_sparsity(df: DataFrame, keys: list[str], size: int, cols: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    return nonzero_cells(df, keys, cols).withColumns({f"{c}_cellsparsity": 1 - F.col(f"{c}_nonzero") / F.lit(size) for c in cols})


def geolevel_sparsity(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    """Sparsity over all cells of all geounits of a level, and how far the two differ."""
    s = df.groupBy(*keys).agg(F.count_if(F.col("orig") > 0).alias("o"), F.count_if(F.col("priv") > 0).alias("p"), (F.count_distinct("geocode") * size).alias("cells"))
    s = s.select(*keys, (1 - F.col("o") / F.col("cells")).alias("orig_sparsity"), (1 - F.col("p") / F.col("cells")).alias("priv_sparsity"))
    return s.withColumn("L1", F.abs(F.col("priv_sparsity") - F.col("orig_sparsity")))


def sparsity_change(df: DataFrame, keys: list[str], size: int) -> DataFrame:
    return df.groupBy(*keys).agg(((F.count_if(F.col("orig") > 0) - F.count_if(F.col("priv") > 0)) / F.lit(size)).alias("change"))


# by level


def _units(df: DataFrame) -> DataFrame:
    return df.groupBy("geolevel", "geocode").agg(F.sum(l1()).alias("s"), F.max(l1()).alias("m"), F.sum("orig").alias("o"), F.sum("priv").alias("p"), F.max("orig").alias("mo"), F.max("priv").alias("mp"))


def l1_sum_level(df: DataFrame) -> DataFrame:
    return _units(df).groupBy("geolevel").agg(F.sum("s").alias("l1_sum"))


def l1_max_level(df: DataFrame) -> DataFrame:
    return _units(df).groupBy("geolevel").agg(F.sum("m").alias("l1_max_sum"))


def l1_maxmax_level(df: DataFrame) -> DataFrame:
    return df.groupBy("geolevel").agg(F.max(l1()).alias("l1_max"))


def zero_geounits(df: DataFrame) -> DataFrame:
    u = _units(df)
    return u.groupBy("geolevel").agg(F.count_if(F.col("mo") == 0).alias("zero_orig"), F.count_if(F.col("mp") == 0).alias("zero_priv"), F.count_if((F.col("mo") == 0) & (F.col("mp") == 0)).alias("zero_both"))


def total_change(df: DataFrame) -> DataFrame:
    d = F.col("p") - F.col("o")
    return _units(df).groupBy("geolevel").agg(F.sum(d).alias("signed_sum"), F.sum(F.abs(d)).alias("abs_sum"), F.sum(F.signum(d).cast("long")).alias("sign_sum"))


def query_l1_level(df: DataFrame) -> DataFrame:
    u = df.groupBy("geolevel", "query", "geocode").agg(F.sum(l1()).alias("s"), F.max(l1()).alias("m"))
    return u.groupBy("geolevel", "query").agg(F.sum("s").alias("l1_sum"), F.sum("m").alias("l1_max_sum"))


# distributions of errors


def error_histogram(df: DataFrame, keys: list[str], n_bins: int = 20) -> DataFrame:
    """Errors binned by width max(1, max // n_bins); upper edges, the last one is the largest error."""
    e = df.withColumn("e", l1())
    e = e.groupBy(*keys, "e").agg(F.count(F.lit(1)).alias("n"))  # distinct errors are few; the rest is small
    top = e.withColumn("most", F.max("e").over(Window.partitionBy(*keys)))
    width = F.greatest(F.lit(1), F.floor(F.col("most") / n_bins))
    edge = ((F.floor(F.col("e") / width) + 1) * width).cast("long")
    b = top.groupBy(*keys, edge.alias("edge")).agg(F.sum("n").alias("n"), F.max("most").alias("most"))
    last = F.max("edge").over(Window.partitionBy(*keys))
    return b.select(*keys, F.when(F.col("edge") == last, F.col("most")).otherwise(F.col("edge")).alias("upper_edge"), "n")


def error_histogram_by_pop(df: DataFrame, keys: list[str], pop: str = "orig", n_bins: int = 20) -> DataFrame:
    return error_histogram(bin_power10(df, pop, "pop_bin"), [*keys, "pop_bin"], n_bins)


def error_quantiles_nonzero(df: DataFrame, keys: list[str], probs: list[float]) -> DataFrame:
    """Quantiles of the non-zero errors, and how many are zero and not."""
    e = df.withColumn("e", l1())
    some = F.when(F.col("e") != 0, F.col("e"))
    return e.groupBy(*keys).agg(F.count_if(F.col("e") == 0).alias("zeros"), F.count_if(F.col("e") != 0).alias("nonzeros"), *[F.percentile_approx(some, p, 1_000_000).alias(f"q{round(p * 100)}") for p in probs])


def error_cdf(df: DataFrame, keys: list[str]) -> DataFrame:
    """Cumulative share of rows by error value."""
    n = df.groupBy(*keys, l1().alias("error")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    return n.select(*keys, "error", (F.sum("n").over(w.orderBy("error")) / F.sum("n").over(w)).alias("cdf"))


QUANTILES = (0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99, 1.0)


def total_pop_bins(df: DataFrame, cutoffs: list[tuple[int, int | None]], keys: list[str], relative: bool = False) -> DataFrame:
    """By population bin (lo, hi]: rows, mean error, mean per cent error, quantiles. A bin with hi None is open."""
    at = F.array_compact(F.array(*[F.when((F.col("orig") > lo) & (F.lit(True) if hi is None else F.col("orig") <= hi), F.lit(f"({lo}, {'inf' if hi is None else hi}]")) for lo, hi in cutoffs]))
    e = df.withColumn("bin", F.explode(at)).withColumn("e", 100 * ratio(l1(), "orig") if relative else l1().cast("double"))
    s = e.groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"), F.avg(l1()).alias("mean_l1"), F.avg(100 * ratio(l1(), "orig")).alias("mean_pct"))
    s = beside_quantiles(s, exact_quantiles(e, [*keys, "bin"], F.col("e"), list(QUANTILES)), [*keys, "bin"])
    return s.select(*keys, "bin", "n", "mean_l1", "mean_pct", *[F.col("q")[i].alias(f"q{round(100 * p)}") for i, p in enumerate(QUANTILES)])


def l1_by_pop_bin(df: DataFrame, starts: list[int]) -> DataFrame:
    """Mean error and rows per digitised population bin; bin null is all of them."""
    return bin_digitize(df, "orig", starts).rollup("bin").agg(F.avg(l1()).alias("mean_l1"), F.count(F.lit(1)).alias("n"))


def relative_total_error(df: DataFrame, starts: list[int], threshold: float = 0.05) -> DataFrame:
    """L1 / max(1, orig) by level and bin, and over a level's bins (bin null): mean, share within the threshold, median."""
    e = bin_digitize(df, "orig", starts).withColumn("e", l1() / F.greatest(F.lit(1), F.col("orig")))
    keys = ["geolevel", "bin"]
    both = e.select("geolevel", F.explode(F.array(F.col("bin"), F.lit(None).cast(e.schema["bin"].dataType))).alias("bin"), "e")
    s = both.groupBy(*keys).agg(F.avg("e").alias("mean"), F.avg(F.when(F.col("e") <= threshold, 1.0).otherwise(0.0)).alias("share_within"))
    return beside_quantiles(s, exact_quantiles(both, keys, F.col("e"), [0.5]), keys).withColumn("median", F.col("q")[0]).drop("q")


def relative_query_error(df: DataFrame, keys: list[str], threshold: float = 0.05, cutoff: int = 0) -> DataFrame:
    """On err_l1_relative: share within the threshold, mean and median of the defined ratios, and how many there are."""
    ok = F.when(F.col("L1Relative") != 2.0, F.col("L1Relative"))
    rows = df.filter(F.col("orig") >= cutoff)
    s = rows.groupBy(*keys).agg(F.avg(F.when(ok.isNotNull(), F.when(ok <= threshold, 1.0).otherwise(0.0))).alias("share_within"), F.avg(ok).alias("mean"), F.count(F.lit(1)).alias("n_all"), F.count(ok).alias("n_defined"))
    return beside_quantiles(s, exact_quantiles(rows, keys, ok, [0.5]), keys).withColumn("median", F.col("q")[0]).drop("q")


def county_goal(df: DataFrame, threshold: int) -> DataFrame:
    """Mean error over geounits and the share within the threshold."""
    return df.agg(F.avg(l1()).alias("mae"), F.avg(F.when(l1() <= threshold, 1.0).otherwise(0.0)).alias("share_within"))


def area_state_total_l1(df: DataFrame, level: str) -> DataFrame:
    return df.filter(F.col("geolevel") == level).select("geocode", l1().alias("L1"))


# diversity


def blau_index(df: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    g = df.groupBy(*keys, *group).agg(F.sum("orig").alias("n"))
    return g.groupBy(*keys).agg((1 - ratio(F.sum((F.col("n") * F.col("n")).cast("double")), F.sum("n") * F.sum("n"))).alias("blau"))


def blau_quintile_errors(df: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Mean signed and absolute error of totals by quintile of the index; quintile edges are exact percentiles."""
    totals = df.groupBy(*keys).agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    rows = blau_index(df, keys, group).join(totals, keys).filter("blau is not null")
    edge = exact_quantiles(rows, [], F.col("blau"), [0.2, 0.4, 0.6, 0.8]).first()  # four numbers
    edge = edge["q"] if edge else [0.0] * 4
    q = reduce(lambda a, b: a + b, [(F.col("blau") > x).cast("int") for x in edge]) + 1
    d = F.col("priv") - F.col("orig")
    return rows.groupBy(q.alias("quintile")).agg(F.count(F.lit(1)).alias("n"), F.avg(d).alias("mean_signed"), F.avg(F.abs(d)).alias("mean_abs"))


def race8_errors(df: DataFrame, category: Column, keys: list[str], starts: tuple[int, ...] = (0, 10, 100)) -> DataFrame:
    """Mean error of categories by size bin, and of all sizes (size null). category names each row's category."""
    g = df.groupBy(*keys, category.alias("category")).agg(F.sum("orig").alias("orig"), F.sum("priv").alias("priv"))
    c = F.when(F.col("orig") < starts[1], f"{starts[0]}-{starts[1] - 1}").when(F.col("orig") < starts[2], f"{starts[1]}-{starts[2] - 1}").otherwise(f"{starts[2]}+")
    return g.withColumn("size", c).groupingSets([["category", "size"], ["category"]], "category", "size").agg(F.avg(l1()).alias("mae"), F.count(F.lit(1)).alias("n"))


# runs


def avg_signed_error_bins(df: DataFrame, bins: list[int], keys: list[str]) -> DataFrame:
    d = F.col("priv") - F.col("orig")
    return bin_counts(df, "orig", bins, "orig_count_bin").groupBy(*keys, "orig_count_bin").agg(F.avg(d).alias("signed_error"), F.avg(d / F.greatest(F.lit(1), F.col("orig"))).alias("re"))


def avg_abs_error_bins(df: DataFrame, bins: list[int], keys: list[str]) -> DataFrame:
    return bin_counts(df, "orig", bins, "orig_count_bin").groupBy(*keys, "orig_count_bin").agg(F.avg(l1()).alias("abs_error"), F.avg(l1() / F.greatest(F.lit(1), F.col("orig"))).alias("re"))


def sample_variance_n(df: DataFrame, col: str, n: int, keys: list[str]) -> DataFrame:
    """(n sum x^2 - (sum x)^2) / (n (n - 1)) with n given: runs without a row count as 0."""
    x = F.col(col).cast("double")
    return df.groupBy(*keys).agg(((n * F.sum(x * x) - F.sum(x) * F.sum(x)) / F.lit(float(n * (n - 1)))).alias(f"sample_variance_{col}"))


def table_cv(df: DataFrame, keys: list[str], run_id: str, col: str = "priv") -> DataFrame:
    """Standard deviation over runs by max(1, the value of the run named)."""
    first = F.max(F.when(F.col("run_id") == run_id, F.col(col)))
    return df.groupBy(*keys).agg(F.stddev_samp(col).alias("sd"), F.greatest(F.lit(1), first).alias("base")).withColumn("cv", F.col("sd") / F.col("base"))


def voting_race_share(joined: DataFrame, keys: list[str]) -> DataFrame:
    """On join_race_to_total: average share over runs."""
    return joined.groupBy(*keys).agg(F.avg(ratio("orig", "orig_total")).alias("orig_share"), F.avg(ratio("priv", "priv_total")).alias("priv_share"))


def avg_pop_runs(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.avg("orig").alias("avg_orig"), F.avg("priv").alias("avg_priv"))


def variation_vs_average(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    """sqrt(sample variance over n runs) / average, then its mean over a geounit's groups, to 4 digits."""
    x = F.col("priv").cast("double")
    g = df.groupBy(*keys).agg(((n * F.sum(x * x) - F.sum(x) * F.sum(x)) / F.lit(float(n * (n - 1)))).alias("v"), F.avg("priv").alias("a"))
    rel = ratio(F.sqrt(F.greatest(F.col("v"), F.lit(0.0))), F.col("a"))
    return g.withColumn("rel", rel).groupBy("geocode", "geolevel").agg(F.round(F.avg("rel"), 4).alias("relative_variation"))


def variation_vs_true(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    d = (F.col("priv") - F.col("orig")).cast("double")
    g = df.groupBy(*keys, "orig").agg(F.round(F.sum(d * d / F.lit(float(n))), 4).alias("v"))
    return g.withColumn("rel", ratio(F.sqrt("v"), F.col("orig"))).groupBy("geocode", "geolevel").agg(F.round(F.avg("rel"), 4).alias("relative_variation"))


def population_density(pop: DataFrame, area: DataFrame, col: str = "area") -> DataFrame:
    j = pop.join(area, ["geocode", "geolevel"])
    j = j.withColumns({f"density_{c}": ratio(c, col) for c in ("orig", "priv")})
    return j.withColumn("diff_density", F.col("density_priv") - F.col("density_orig")).withColumn("l1_density", F.abs("diff_density"))


def metric_groups(df: DataFrame, groups: dict[str, tuple[list[str], list[str], str]]) -> DataFrame:
    """Named groups {name: (geolevels, metrics, aggregation in sum, avg, quantiles)} of node metrics, long.

    Metrics of a geounit: L1, L2, LInf and their forms relative to the true total (_rel) and per cell (_avg), tvd,
    signed, abs_total, total_rel.
    """
    d = F.col("priv") - F.col("orig")
    u = df.groupBy("geolevel", "geocode").agg(F.sum(F.abs(d)).cast("double").alias("L1"), F.sqrt(F.sum((d * d).cast("double"))).alias("L2"), F.max(F.abs(d)).cast("double").alias("LInf"), F.sum("orig").alias("o"), F.sum(d).cast("double").alias("signed"), F.count(F.lit(1)).alias("n"))
    forms = {m: F.col(m) for m in ("L1", "L2", "LInf", "signed")} | {f"{m}_rel": ratio(m, "o") for m in ("L1", "L2", "LInf")} | {f"{m}_avg": ratio(m, "n") for m in ("L1", "L2", "LInf")}
    forms |= {"tvd": ratio(F.col("L1"), 2 * F.col("o")), "one_minus_tvd": 1 - ratio(F.col("L1"), 2 * F.col("o")), "abs_total": F.abs("signed"), "total_rel": ratio(F.abs("signed"), F.col("o"))}
    want = F.array_compact(F.array(*[F.when(F.col("geolevel").isin(levels), F.struct(F.lit(g).alias("metric_group"), F.lit(m).alias("metric"), F.lit(how).alias("how"), forms[m].alias("value"))) for g, (levels, ms, how) in groups.items() for m in ms]))
    rows = u.select("geolevel", F.explode(want).alias("x")).select("geolevel", "x.*")
    keys = ["metric_group", "geolevel", "metric", "how"]
    s = rows.groupBy(*keys).agg(F.sum("value").alias("sum"), F.avg("value").alias("avg"))
    s = beside_quantiles(s, exact_quantiles(rows.filter("how = 'quantiles'"), keys, F.col("value"), [0.0, 0.25, 0.5, 0.75, 1.0]), keys)
    out = F.when(F.col("how") == "sum", F.array(F.struct(F.lit("sum").alias("statistic"), F.col("sum").alias("value")))).when(F.col("how") == "avg", F.array(F.struct(F.lit("avg").alias("statistic"), F.col("avg").alias("value"))))
    out = out.otherwise(F.array(*[F.struct(F.lit(f"q{p}").alias("statistic"), F.col("q")[i].alias("value")) for i, p in enumerate((0, 25, 50, 75, 100))]))
    return s.select("metric_group", "geolevel", "metric", F.explode(out).alias("x")).select("metric_group", "geolevel", "metric", "x.*")
