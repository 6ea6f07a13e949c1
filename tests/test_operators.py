"""Golden examples and properties of the operators."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.functions import attributes as A
from cellarium.functions.dims import Dim, Schema, dim_levels, query_levels, recode_map
from cellarium.operators import expand, filters, fit, geo, hist, metrics, noise, quantiles, recode, validate
from cellarium.operators import query as Q
from cellarium.sources import files

HIER = [("A", 1), ("B", 2), ("C", 3)]


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_nested_histogram(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (1, 1, 1), (2, 1, 1)], "g int, a int, b int")
    got = {r.g: [tuple(c) for c in r.cells] for r in hist.hist_nested(hist.hist_sparse(df, "g", ["a", "b"]), "g", ["a", "b"], [2, 2]).collect()}
    assert got == {1: [(2, 2), (3, 1)], 2: [(3, 1)]}


def test_weighted_age_quantiles(spark):
    df = spark.createDataFrame([(0, 1, 2, 3), (0, 25, 3, 1), (0, 115, 1, 3)], "k int, age int, orig long, priv long")
    got = {r.quantile: (r.orig, r.priv) for r in quantiles.quantile_weighted_age(df, ["k"], "age", [0.0, 0.5, 1.0]).collect()}
    assert got == {0.0: (1.0, 1.0), 0.5: (25.0, 25.0), 1.0: (115.0, 115.0)}


def test_levels_cross_and_merge(spark):
    s = Schema((A.sex(), A.voting_age()))
    levels = {r.level for r in query_levels(spark, "sex * votingage", s).collect()}
    assert len(levels) == 4 and "Male BY 17 years and under" in levels
    assert query_levels(spark, "total", s).first().level == "total"
    df = spark.createDataFrame([("Male", "x")], "sex string, v string")
    assert recode.merge_dims_to_level(df, ["sex", "v"]).first().level == "Male BY x"
    with pytest.raises(ValueError):
        s.parse("sex * male")


def test_bins(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (4,), (5,), (None,)], "x int")
    assert [r.bin for r in recode.bin_sql(df, "x", [0, 1, 5]).collect()] == ["(-Inf, 0)", "[0, 1)", "[1, 5)", "[1, 5)", "[5, +Inf)", "NaN"]
    assert [r.bin for r in recode.bin_counts(df.na.drop(), "x", [0, 1, 5]).collect()] == ["[0-1)", "[0-1)", "[1-5)", "[1-5)", "5 +"]
    big = spark.createDataFrame([(0,), (1,), (9,), (10,), (999,), (1000,)], "x long")
    assert [r.bin for r in recode.bin_power10(big, "x").collect()] == [0, 1, 1, 10, 100, 1000]


def test_flat_index_round_trip(spark):
    df = spark.range(2 * 3 * 5).selectExpr("id cell")
    there = recode.unflat_index(df, ["a", "b", "c"], [2, 3, 5])
    assert recode.flat_index(there.drop("cell"), ["a", "b", "c"], [2, 3, 5]).agg(F.count_distinct("cell")).first()[0] == 30


def test_attributes():
    assert len(A.race_combinations()) == 63 and A.pl94().size == 2016
    for d in (A.sex(), A.age(), A.cenrace(), A.facility(), A.tenure(), A.vacancy(), A.tenure_vacancy_gq(), A.household_size(), A.household_age(), A.household_elderly(), A.householder_race(), A.h1(), A.citizen(), A.multigenerational(), A.hispanic(), A.voting_age(), A.relationship_gq(), A.household_type(), A.citizen_race(), A.facility_1940(), A.age_category(), A.age_1940(), A.sex_1940(), A.hispanic_1940(), A.citizen_1940(), A.race_1940(), A.unit_facility_demo(), A.relationship()):
        for name, groups in d.recodes.items():
            used = [i for ix in groups.values() for i in ix]
            assert len(used) == len(set(used)) and set(used) <= set(range(d.size)), (d.name, name)
    for name, queries in A.TABLES.items():
        for q in queries:
            (A.pl94_citizens() if name.endswith("CVAP") else A.pl94()).parse(q)
    assert set(recode.facility_codes().values()) == set(range(18, 42)) and len(A.age_rules()) == len(A.LEGAL_AGES)


def test_dim_tables(spark):
    s = Schema((A.voting_age(), A.hispanic()))
    assert dim_levels(spark, s).count() == 4
    assert recode_map(spark, s, ["voting * hispanic"]).count() == 3


def test_rollup_of_rollup_is_the_direct_one(spark):
    df = spark.createDataFrame([("111", 1, 2), ("112", 1, 3), ("121", 0, 1), ("211", 1, 4)], "geocode string, a int, cnt long")
    whole = hist.geo_rollup(df, HIER, ["a"])
    again = hist.geo_rollup(whole.filter("geolevel = 'B'").select("geocode", "a", "cnt"), HIER[:2], ["a"])
    assert rows(again.filter("geolevel = 'A'")) == rows(whole.filter("geolevel = 'A'"))
    any_ = hist.geo_rollup_any(df, HIER, [], ["a"], ("cnt",))
    assert rows(any_.select("geolevel", "geocode", "a", "cnt")) == rows(whole)


def test_fit_keeps_sums_and_signs(spark):
    parent = spark.createDataFrame([("1", 0, 7), ("1", 1, 0), ("2", 0, 5)], "geocode string, c int, total long")
    child = spark.createDataFrame([("11", "1", 0, -2.0, 1.0), ("12", "1", 0, 9.5, 2.0), ("13", "1", 0, 1.2, 1.0), ("11", "1", 1, 3.0, 1.0), ("21", "2", 0, 99.0, 1.0)], "geocode string, parent_geocode string, c int, x double, variance double")
    even = fit.topdown_consistent(parent, child, ["c"], "variance")
    assert all(abs(r.s - r.t) < 1e-9 for r in even.groupBy("parent_geocode", "c").agg(F.sum("x").alias("s")).join(parent.select(F.col("geocode").alias("parent_geocode"), "c", F.col("total").alias("t")), ["parent_geocode", "c"]).collect())
    got = fit.fit_level(parent, child, ["c"])
    assert {(r.parent_geocode, r.c): r.s for r in got.groupBy("parent_geocode", "c").agg(F.sum("x").alias("s")).collect()} == {("1", 0): 7, ("1", 1): 0, ("2", 0): 5}
    assert got.filter("x < 0").isEmpty()
    whole = got.withColumn("x", F.col("x").cast("double"))
    assert rows(fit.topdown_round(parent, whole, ["c"]).select("geocode", "c", "x")) == rows(got.select("geocode", "c", "x"))


def test_bounds_clip(spark):
    child = spark.createDataFrame([("1", "p", 0, 9, 0, 4), ("2", "p", 0, 1, 0, 3), ("3", "p", 0, 0, 0, 9)], "geocode string, parent_geocode string, c int, x long, lo long, hi long")
    got = fit.topdown_bounds_clip(child, ["c"]).collect()
    assert sum(r.x for r in got) == 10 and all(r.lo <= r.x <= r.hi for r in got)


def test_levels_end_to_end(spark):
    m = spark.createDataFrame([("A", "1", 0, 10.4, 1.0), ("B", "11", 0, 3.0, 1.0), ("B", "12", 0, -2.0, 1.0), ("C", "111", 0, 1.0, 1.0), ("C", "121", 0, 5.0, 2.0), ("C", "122", 0, 5.0, 1.0)], "geolevel string, geocode string, c int, noisy double, variance double")
    got = {r.geocode: r.x for r in fit.topdown_levels(m, HIER, ["c"]).collect()}
    assert got["1"] == 10 and got["11"] + got["12"] == 10 and got["111"] == got["11"] and got["121"] + got["122"] == got["12"] and min(got.values()) >= 0


def test_round_trip_of_records(spark):
    h = spark.createDataFrame([("1", 0, 2), ("1", 1, 0), ("2", 1, 3)], "geocode string, a int, cnt long")
    back = hist.hist_sparse(expand.expand_to_records(h, "cnt"), "geocode", ["a"])
    assert rows(back) == [("1", 0, 2), ("2", 1, 3)]
    assert hist.hist_equal(h, back, ["geocode", "a"]).isEmpty()


def test_noise_has_the_right_spread(spark):
    df = spark.range(200_000).withColumn("x", F.lit(10))
    g = noise.noise_geometric(df, "x", F.lit(1.0), seed=5).agg(F.avg("noisy"), F.var_samp("noisy"), F.max("variance")).first()
    assert abs(g[0] - 10) < 0.05 and abs(g[1] - g[2]) < 0.2
    for s in (2.25, 150.0, 4000.0):
        g = noise.noise_discrete_gaussian(df, "x", s, seed=7).agg(F.avg("noisy"), F.var_samp("noisy"), F.max("variance")).first()
        assert abs(g[0] - 10) < 0.02 * s**0.5 and abs(g[1] / g[2] - 1) < 0.02
    i = noise.noise_interval(noise.noise_geometric(df, "x", F.lit(1.0), seed=5), 0.9, F.lit(1.0))
    assert 0.9 <= i.agg(F.avg(F.col("x").between(F.col("lower"), F.col("upper")).cast("double"))).first()[0] < 0.96


def test_metrics_of_nothing_and_zero(spark):
    none = spark.createDataFrame([], "orig long, priv long")
    assert metrics.metric_mae(none).first()[0] == 0 and metrics.metric_cov(none).first()[0] == 0
    some = spark.createDataFrame([(0, 3), (10, 12)], "orig long, priv long")
    p = {r.metric: r.value for r in metrics.metric_panel(some).collect()}
    assert p["MAE"] == 2.5 and p["MAPE"] == 10.0 and p["MALPE"] == 10.0 and p["CountMAPE10"] == 1 and p["Counts"] == 2


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_text("# c\nTABBLKST|TABBLKCOU|TABTRACTCE|TABBLKGRPCE|TABBLK|OIDTABBLK|AREALAND|AREAWATER\n01|002|000003|4|0005|x|2589988|2589988\n")
    (tmp_path / "f.txt").write_text("H12 a\nD 7 b\n")
    raw = files.scan_piped_protected(spark, str(tmp_path / "a.txt"))
    assert raw.first().TABTRACTCE == "000003"
    assert files.geo_reference(raw).first().geocode == "01002000003" + "40005"
    assert files.area_reference(raw).first().area == 2.0
    got = files.scan_fixed_width(spark, str(tmp_path / "f.txt"), [("n", 1, 2, "int"), ("s", 4, 1, "string")], F.col("value").startswith("D"))
    assert rows(got) == [(7, "b")]
    df = spark.createDataFrame([("b", 2), ("a", 1), ("c", 3)], "k string, v int")
    files.sink_piped_sorted(df, str(tmp_path / "out"), ["k"])
    assert rows(files.scan_delimited(spark, str(tmp_path / "out"), "k string, v int", "|")) == [("a", 1), ("b", 2), ("c", 3)]
    runs = files.scan_runs(spark, {str(tmp_path / "out"): {"run_id": "r1"}}, "text")
    assert runs.columns == ["value", "run_id"]
    true = df.withColumns({c: F.lit(1) for c in ("orig", "RAW", "truth", "raw_housing")})
    assert files.drop_true_counts(true).columns == ["k", "v"] == files.drop_true_counts(df).columns
    assert files.drop_true_counts(true, ("truth",)).columns == ["k", "v", "orig", "RAW", "raw_housing"]


def test_record_number_and_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"), F.concat(F.lit("k"), F.col("id")).alias("s"))
    for first in ("v", "s"):
        got = quantiles.record_number(df, [first]).orderBy("record_number").collect()
        assert [r.record_number for r in got] == list(range(1, 5001)) and [r[first] for r in got] == sorted(r[first] for r in got)


def test_order_of_stored_files_and_numbers_of_decimals(spark, tmp_path):
    for k, (a, b) in enumerate(((0, 5000), (5000, 5010), (5010, 9000))):
        spark.range(a, b, numPartitions=1).write.parquet(str(tmp_path / f"x/part={k}"))
    assert quantiles.check_sorted(spark, str(tmp_path / "x"), ["id"]).first().violations == 0
    spark.range(3, 4).write.mode("append").parquet(str(tmp_path / "x/part=1"))
    assert quantiles.check_sorted(spark, str(tmp_path / "x"), ["id"]).first().violations > 0
    df = spark.createDataFrame([("10.5",), ("-3",), ("100.25",), ("9.5",), (None,)], "v string").select(F.col("v").cast("decimal(10,2)").alias("v"))
    assert [float(r.v or -99) for r in quantiles.record_number(df, ["v"]).orderBy("record_number").collect()] == [-99, -3, 9.5, 10.5, 100.25]


def test_fit_to_further_queries_is_least_squares(spark):
    """Against the normal equations: two children of one parent, three cells, the answers of one query in two levels."""
    rng = np.random.default_rng(2)
    kids, cells, level = ["a1", "a2"], [0, 1, 2], [0, 0, 1]
    x0, v, y, vy, total = rng.uniform(0, 9, (2, 3)), rng.uniform(1, 3, (2, 3)), rng.uniform(0, 15, (2, 2)), rng.uniform(1, 3, (2, 2)), np.array([9.0, 7.0, 5.0])
    child = spark.createDataFrame([(g, "a", c, float(x0[i, c]), float(v[i, c])) for i, g in enumerate(kids) for c in cells], "geocode string, parent_geocode string, c int, x double, variance double")
    parent = spark.createDataFrame([("a", c, float(total[c])) for c in cells], "geocode string, c int, total double")
    answers = spark.createDataFrame([(g, "q", str(k), float(y[i, k]), float(vy[i, k])) for i, g in enumerate(kids) for k in (0, 1)], "geocode string, query string, level string, noisy double, variance double")
    got = {(r.geocode, r.c): r.x for r in fit.topdown_queries(parent, child, ["c"], answers, {"q": "case when c < 2 then '0' else '1' end"}, 40).collect()}
    start, weight = np.concatenate([x0.ravel(), y.ravel()]), np.concatenate([v.ravel(), vy.ravel()])
    planes, goal = [], []
    for i in range(2):
        for k in (0, 1):
            planes.append([float(j == i and level[c] == k) for j in range(2) for c in cells] + [-float(j == i and m == k) for j in range(2) for m in (0, 1)])
            goal.append(0.0)
    for c in cells:
        planes.append([float(e == c) for _ in range(2) for e in cells] + [0.0] * 4)
        goal.append(total[c])
    a = np.array(planes)
    want = start - weight * (a.T @ np.linalg.lstsq(a @ (weight[:, None] * a.T), a @ start - np.array(goal), rcond=None)[0])
    assert all(abs(got[g, c] - want[3 * i + c]) < 1e-6 for i, g in enumerate(kids) for c in cells)


def test_checks(spark):
    u = spark.createDataFrame([("1", 0), ("1", 0), ("2", 1)], "geocode string, t int")
    p = spark.createDataFrame([("1", 0), ("3", 1)], "geocode string, t int")
    assert rows(validate.val_person_per_gq(p, u, ["geocode", "t"]).select("geocode", "units", "persons")) == [("1", 2, 1), ("2", 1, 0)]
    assert rows(validate.val_gq_absent(p, u, ["geocode", "t"]).select("geocode", "persons")) == [("3", 1)]
    assert validate.val_report({"x": u.filter("t = 5")}).first().passed
    got = filters.check_legal_values(spark.createDataFrame([(1, 5), (2, None), (3, 2)], "k int, a int"), {"a": [(0, 3)]}, "k")
    assert rows(got) == [(1, "a", "5"), (2, "a", None)]
    assert Q.marginal_names(Schema((Dim("a", ("x",)), Dim("b", ("y",)))), 2) == ["total", "a", "b", "a * b"]


def test_entity_distance_counts_additions(spark):
    b = spark.createDataFrame([("111", "x"), ("112", "x"), ("113", "y"), ("121", "y")], "geocode string, e string")
    got = {(r.geocode, r.entity): r.distance for r in geo.geo_entity_distance(b, HIER, "e").collect()}
    assert got[("11", "x")] == 2 and got[("11", "y")] == 1 and got[("12", "x")] == 0 and got[("1", "y")] == 2


def test_quantiles_of_one_group_of_many_values(spark):
    """A million distinct values in one group, beside small groups and a null key; no window takes a whole group's values."""
    import numpy as np

    from cellarium.operators import quantiles as Z

    big = spark.range(1_000_000).select(F.lit("big").alias("g"), F.pmod(F.col("id") * 7919, F.lit(1_000_003)).cast("double").alias("x"))
    small = spark.createDataFrame([("a", 1.0), ("a", 4.0), ("a", 4.0), ("b", 2.0), (None, 5.0), (None, 7.0), ("b", None), ("none", None)], "g string, x double")
    probs = [0.0, 0.1, 0.5, 0.999, 1.0]
    got = {r.g: r.q for r in Z.exact_quantiles(big.unionByName(small), ["g"], F.col("x"), probs).collect()}
    values = (np.arange(1_000_000, dtype=np.int64) * 7919) % 1_000_003
    want = {"big": np.quantile(values, probs), "a": np.quantile([1, 4, 4], probs), "b": [2.0] * 5, None: np.quantile([5, 7], probs)}
    assert set(got) == set(want)
    for k, v in want.items():
        np.testing.assert_allclose(got[k], v, rtol=1e-12)
    assert Z.exact_quantiles(small, [], F.col("x"), [0.5]).first()["q"] == [4.0]
    assert Z.exact_quantiles(small.filter("false"), ["g"], F.col("x"), [0.5]).count() == 0
    plan = Z.exact_quantiles(small, ["g"], F.col("x"), [0.5])._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_k" in plan and "SinglePartition" not in plan
