"""The family fit against a quadratic programme by active sets, its rounding against all roundings."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.operators import family
from cellarium.operators import fit as T


def best_by_active_sets(x, var, equal, low, high, soft):
    """Least squares by trying every set of active bounds. Rows of equal, low and high: (coefficients, right side)."""
    n = len(x)
    rows = [(np.eye(n)[k], x[k], var[k]) for k in range(n)] + [(c, y, v) for c, y, v in soft]
    a = np.array([c / np.sqrt(v) for c, _, v in rows])
    b = np.array([y / np.sqrt(v) for _, y, v in rows])
    bounds = [(np.eye(n)[k], 0.0, 1) for k in range(n)] + [(c, r, 1) for c, r in low] + [(c, r, -1) for c, r in high]
    best = (np.inf, None)
    for active in itertools.product((False, True), repeat=len(bounds)):
        tight = [(c, r) for c, r in equal] + [(c, r) for (c, r, _), on in zip(bounds, active, strict=True) if on]
        if len(tight) > n + 1:
            continue
        e = np.array([c for c, _ in tight]).reshape(-1, n)
        r = np.array([r for _, r in tight])
        start = np.linalg.lstsq(e, r, rcond=None)[0] if len(e) else np.zeros(n)
        if len(e) and np.abs(e @ start - r).max() > 1e-9:
            continue
        u, s, vt = np.linalg.svd(e) if len(e) else (None, np.zeros(0), np.eye(n))
        z = vt[(s > 1e-10).sum() :].T
        at = start + (z @ np.linalg.lstsq(a @ z, b - a @ start, rcond=None)[0] if z.shape[1] else 0)
        if all(side * (c @ at - r) >= -1e-9 for c, r, side in bounds):
            best = min(best, (float(((a @ at - b) ** 2).sum()), tuple(at)))
    return np.array(best[1]), best[0]


@pytest.mark.parametrize("seed", range(25))
def test_fit_equals_quadratic_programme(seed):
    """Two children of three cells; the parent's sums, a query with answers, bounds on another, x >= 0."""
    rng = np.random.default_rng(seed)
    x, var = rng.normal(3, 4, 6), rng.uniform(0.5, 3, 6)
    column = np.array([0, 1, 2, 0, 1, 2])
    total = rng.integers(0, 9, 3).astype(float)
    pair = np.array([0, 0, 1, 2, 2, 3])
    answer, noise = rng.normal(4, 3, 4), rng.uniform(0.5, 3, 4)
    child = np.array([0, 0, 0, 1, 1, 1])
    truth = rng.integers(0, int(total.sum()) + 1)
    low, high = np.array([max(0, truth - 1), -np.inf]), np.array([truth + 1.0, np.inf])
    got, residual = family.fit(x, var, family.Hard(column, total, total), [family.Soft(pair, answer, noise)], [family.Hard(child, low, high)])
    one = lambda g, k: (g == k).astype(float)
    want, _ = best_by_active_sets(x, var, [(one(column, k), total[k]) for k in range(3)], [(one(child, 0), low[0])], [(one(child, 0), high[0])], [(one(pair, k), answer[k], noise[k]) for k in range(4)])
    assert residual <= 1e-8
    np.testing.assert_allclose(got, want, atol=1e-5)


def test_contradicting_bounds_keep_the_sums():
    x, residual = family.fit(np.array([1.0, 2, 3, 4]), np.ones(4), family.Hard(np.array([0, 1, 0, 1]), np.array([5.0, 7]), np.array([5.0, 7])), [], [family.Hard(np.array([0, 0, 1, 1]), np.array([20.0, 0]), np.array([np.inf, np.inf]))], rounds=200)
    assert residual > 1e-3 and (x >= 0).all()
    np.testing.assert_allclose([x[0] + x[2], x[1] + x[3]], [5, 7], atol=1e-6)


def all_roundings(x, column, total, levels):
    """Least sum of |x - integer| over every choice of floor and ceiling that keeps all sums; None without one."""
    best = None
    sides = [sorted({int(np.floor(v + 1e-9)), int(np.ceil(v - 1e-9))}) for v in x]
    for pick in itertools.product(*sides):
        z = np.array(pick)
        if any(z[column == c].sum() != total[c] for c in range(len(total))):
            continue
        if any(abs(z[g == k].sum() - x[g == k].sum()) >= 1 - 1e-6 for g in levels for k in range(g.max() + 1)):
            continue
        cost = np.abs(z - x).sum()
        best = cost if best is None else min(best, cost)
    return best


@pytest.mark.parametrize("seed", range(60))
def test_rounding_against_all_roundings(seed):
    rng = np.random.default_rng(seed)
    children, cells = (3, 4) if seed % 2 else (4, 3)
    x = rng.uniform(0, 3, children * cells) * (rng.random(children * cells) < 0.9)
    child, column = np.repeat(np.arange(children), cells), np.tile(np.arange(cells), children)
    for c in range(cells):  # whole column sums
        at = np.flatnonzero(column == c)
        x[at] *= max(1.0, np.rint(x[at].sum())) / max(x[at].sum(), 1e-9) if x[at].sum() > 0 else 1
    total = np.array([np.rint(x[column == c].sum()) for c in range(cells)]).astype(int)
    pair = np.where(column < 2, 2 * child, 2 * child + 1)
    levels = [child.copy(), pair] if seed % 3 else [pair]
    if seed % 5 == 0:
        levels[0] = np.where(child == 0, -1, levels[0])
    got = family.controlled_round(x, column, total, levels)
    assert all(got[column == c].sum() == total[c] for c in range(cells)) and (np.abs(got - x) < 1 - 1e-9).all()
    assert all(abs(got[g == k].sum() - x[g == k].sum()) < 1 + 1e-5 for g in levels for k in range(g.max() + 1))
    assert abs(np.abs(got - x).sum() - all_roundings(x, column, total, levels)) < 1e-4


def test_rounding_of_a_large_family():
    rng = np.random.default_rng(1)
    children, cells = 400, 30
    x = rng.uniform(0, 2, (children, cells)) * (rng.random((children, cells)) < 0.5)
    x *= np.rint(x.sum(0)) / x.sum(0)
    child, column = np.repeat(np.arange(children), cells), np.tile(np.arange(cells), children)
    levels = [child, child * 5 + column // 6]
    got = family.controlled_round(x.ravel(), column, np.rint(x.sum(0)).astype(int), levels)
    assert (np.bincount(column, got) == np.rint(x.sum(0))).all() and (np.abs(got - x.ravel()) < 1).all()
    for g in levels:
        assert (np.abs(np.bincount(g, got) - np.bincount(g, x.ravel())) < 1 + 1e-4).all()


def test_rounding_asks_for_nested_levels():
    with pytest.raises(ValueError, match="nested"):
        family.controlled_round(np.full(4, 0.5), np.array([0, 0, 1, 1]), np.array([1, 1]), [np.array([0, 0, 1, 1]), np.array([0, 1, 0, 1])])


def test_levels_under_queries_and_bounds(spark):
    """Three levels with an invariant total and an upper bound; the fit keeps both at every level."""
    rng = np.random.default_rng(2)
    cells = [(a, b) for a in range(2) for b in range(2)]
    true = {f"{p}{c}": rng.integers(0, 6, 4) for p in range(2) for c in range(3)}
    truth = [("L2", g, *cell, int(v)) for g, vs in true.items() for cell, v in zip(cells, vs, strict=True)]
    truth += [("L1", p, *cell, int(sum(true[f"{p}{c}"][k] for c in range(3)))) for p in "01" for k, cell in enumerate(cells)]
    truth += [("L0", "", *cell, int(sum(v[k] for v in true.values()))) for k, cell in enumerate(cells)]
    meas = spark.createDataFrame([(lv, g, a, b, float(v + rng.integers(-3, 4)), 2.0) for lv, g, a, b, v in truth], "geolevel string, geocode string, a int, b int, noisy double, variance double")
    t = spark.createDataFrame(truth, "geolevel string, geocode string, a int, b int, v int")
    level_of = {"total": "'total'", "a": "cast(a as string)"}
    by = t.groupBy("geolevel", "geocode", F.col("a").cast("string").alias("level")).agg(F.sum("v").alias("v"))
    answers = by.select("geolevel", "geocode", F.lit("a").alias("query"), "level", (F.col("v") + 1).alias("noisy"), F.lit(1.0).alias("variance"))
    total = t.groupBy("geolevel", "geocode").agg(F.sum("v").alias("rhs")).select("geolevel", "geocode", F.lit("total").alias("query"), F.lit("total").alias("level"), F.lit("=").alias("sign"), "rhs")
    upper = by.filter("level = '0'").select("geolevel", "geocode", F.lit("a").alias("query"), "level", F.lit("le").alias("sign"), F.col("v").alias("rhs"))
    got = T.topdown_levels(meas, [("L0", 0), ("L1", 1), ("L2", 2)], ["a", "b"], level_of=level_of, answers=answers, bounds=total.unionByName(upper)).toPandas()
    assert (got["x"] >= 0).all() and len(got) == len(truth)
    want = t.toPandas()
    assert got.groupby(["geolevel", "geocode"])["x"].sum().to_dict() == want.groupby(["geolevel", "geocode"])["v"].sum().to_dict()
    a0, w0 = (d[d["a"] == 0].groupby(["geolevel", "geocode"])[c].sum() for d, c in ((got, "x"), (want, "v")))
    assert (a0 <= w0[a0.index]).all()
    for lv, n in (("L1", 0), ("L2", 1)):
        low, up = got[got["geolevel"] == lv], got[got["geolevel"] == f"L{n}"]
        assert low.assign(p=low["geocode"].str[:n]).groupby(["p", "a", "b"])["x"].sum().to_dict() == up.set_index(["geocode", "a", "b"])["x"].to_dict()
