"""Budgets as exact fractions, ready strategies, the integer Gaussian's integers, sparse entity distances."""

from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from cellarium.functions import attributes as A
from cellarium.functions import strategies as S
from cellarium.operators import geo, noise

PRIMES = [10007, 10009, 10037, 10039, 10061, 10067, 10069, 10079, 10091, 10093, 10099, 10103]
ALLOC = "geolevel string, query string, geo_num long, geo_den long, q_num long, q_den long"


def test_many_denominators(spark):
    """24 right shares over twelve five-digit denominators, and the same with one share off by the least there is."""
    right = [(p, n) for p in PRIMES for n in (5, p - 5)]
    rows = [("good", f"q{k}", 1, 2, n, 12 * p) for k, (p, n) in enumerate(right)]
    rows += [("bad", f"q{k}", 1, 2, n + (k == 3), 12 * p) for k, (p, n) in enumerate(right)] + [("low", "q0", 1, 1, 2, 1), ("low", "q1", 1, 1, -1, 1)]
    meas = spark.createDataFrame([(r[0], r[1]) for r in rows], "geolevel string, query string")
    got = noise.budget_attach(meas, spark.createDataFrame(rows, ALLOC), (3, 2)).collect()
    assert {(r.geolevel, r.budget_error) for r in got} == {("good", False), ("bad", True), ("low", True)}
    assert all(Fraction(r.inv_scale_num, r.inv_scale_den) == Fraction(4, 9) * Fraction(1, 2) * Fraction(*next((x[4], x[5]) for x in rows if x[:2] == (r.geolevel, r.query))) for r in got if r.geolevel != "low")


def test_terms_beyond_64_bits_are_reduced_or_stop_the_job(spark):
    meas = spark.createDataFrame([("l", "q")], "geolevel string, query string")
    big = 1 << 61
    r = noise.budget_attach(meas, spark.createDataFrame([("l", "q", big, big, 1, 1)], ALLOC), (3, 2)).first()
    assert (r.inv_scale_num, r.inv_scale_den) == (4, 9)
    with pytest.raises(OverflowError):
        noise.budget_attach(meas, spark.createDataFrame([("l", "q", big - 1, big, big - 3, big - 5)], ALLOC), (3, 2))


@pytest.mark.parametrize("make", [S.production, S.equal, S.detailed_first, S.fewer_races])
def test_ready_strategies_fit_their_schema(make):
    make().check(A.pl94(), list(S.LEVELS))


def test_wrong_strategies_are_named():
    s = S.equal()
    with pytest.raises(ValueError, match="sum to 1"):
        S.Strategy(s.levels | {"US": Fraction(1, 2)}, s.queries).check(A.pl94(), list(S.LEVELS))
    with pytest.raises(ValueError, match="no query 'age'"):
        S.Strategy(s.levels, s.queries | {"US": {"age": Fraction(1)}}).check(A.pl94(), list(S.LEVELS))
    with pytest.raises(ValueError, match="levels"):
        s.check(A.pl94(), ["US", "State"])


def test_gaussian_integers_by_fractions():
    """The table against sums of a series for exp in exact fractions."""

    def exp(x: Fraction) -> Fraction:
        """exp of a number that is not positive: squared back from a small one."""
        halvings = 12
        y, term, total = -x / 2**halvings, Fraction(1), Fraction(1)
        for k in range(1, 30):
            term = term * y / k
            total += term
        scaled = Fraction(round(total * (1 << 400)), 1 << 400)
        for _ in range(halvings):
            scaled = Fraction(round(scaled * scaled * (1 << 400)), 1 << 400)
        return 1 / scaled

    for s2 in (Fraction(9, 4), Fraction(1, 3)):
        weights = {x: exp(Fraction(-x * x) / (2 * s2)) for x in range(-40, 41)}
        total = sum(weights.values())
        run, want = Fraction(0), {}
        for x in sorted(weights):
            run += weights[x]
            want[x] = int(run / total * (1 << noise.BITS))
        got = dict(noise.gaussian_integers(s2))
        assert all(abs(want[x] - c) <= (0 if c < 1 << noise.BITS else 1) for x, c in got.items())


def test_exact_noise_draws(spark):
    table = noise.gaussian_integers(Fraction(1))
    edges = [(c - 1, x) for x, c in table] + [(c, table[i + 1][0]) for i, (_, c) in enumerate(table[:-1])] + [(0, table[0][0])]
    df = spark.createDataFrame([(r, x) for r, x in edges], "r long, want int").withColumn("n", F.lit(10))
    assert noise.noise_discrete_gaussian_exact(df, "n", Fraction(1), F.col("r")).filter("noisy <> 10 + want").count() == 0
    drawn = noise.noise_discrete_gaussian_exact(spark.range(20000).withColumn("n", F.lit(0)), "n", Fraction(4)).agg(F.avg("noisy").alias("m"), F.var_samp("noisy").alias("v"), F.first("variance").alias("t")).first()
    assert abs(drawn.m) < 0.1 and abs(drawn.v - 4) < 0.3 and abs(drawn.t - 4) < 1e-6


def test_entity_distance_by_hand(spark):
    rows = [("11", "a"), ("12", "a"), ("13", "b"), ("21", "b"), ("22", "b"), ("31", "a")]
    got = {(r.geolevel, r.geocode, r.entity): r.distance for r in geo.geo_entity_distance(spark.createDataFrame([("0" + g, e) for g, e in rows], "geocode string, e string"), [("top", 1), ("mid", 2), ("block", 3)], "e", absent=False).collect()}
    # mid 01: a is all but one of three (take all, give one back), b one; 02: b whole; 03: a whole
    assert got == {("mid", "01", "a"): 2, ("mid", "01", "b"): 1, ("mid", "02", "b"): 1, ("mid", "03", "a"): 1, ("top", "0", "a"): 3, ("top", "0", "b"): 2}
