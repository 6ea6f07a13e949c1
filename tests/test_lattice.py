"""The marginal lattice against queries answered one by one."""

import random

import pytest
from pyspark.sql import functions as F

from cellarium.functions import tables as TB
from cellarium.functions.dims import Dim, Schema
from cellarium.operators import lattice as L
from cellarium.operators import query as Q

SCHEMA = Schema((
    Dim("a", ("x", "y", "z", "w"), {"a2": {"xy": (0, 1), "zw": (2, 3)}, "ax": {"x": (0,)}, "over": {"xy": (0, 1), "yz": (1, 2)}}),
    Dim("b", ("p", "q", "r"), {"b2": {"pq": (0, 1), "r": (2,)}, "bq": {"q": (1,)}}),
    Dim("c", ("m", "n"), {}),
))


@pytest.mark.parametrize("seed", range(3))
def test_answers_are_those_of_the_direct_way(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice(["g", "h"]), rng.randrange(4), rng.randrange(3), rng.randrange(2), rng.randrange(5), rng.randrange(5)) for _ in range(150)]
    df = spark.createDataFrame(rows, "geocode string, a int, b int, c int, orig int, priv int")
    names = rng.sample(["total", "a", "b", "c", "a2", "ax", "b2", "bq", "a * b", "a2 * b2", "ax * c", "a2 * bq * c", "b2 * c", "a * b * c"], 9)
    got = {tuple(r) for r in L.answer(df, names, SCHEMA, ["geocode"]).collect()}
    want = {tuple(r) for r in Q.query_answer_many(df, names, SCHEMA, ["geocode"]).select("geocode", "query", "level", "orig", "priv").collect()}
    assert got == want


def test_groups_that_overlap_all_count(spark):
    df = spark.createDataFrame([("g", k, 0, k % 2, 1) for k in range(4)], "geocode string, a int, b int, c int, n int")
    got = {(r.query, r.level): r.n for r in L.answer(df, ["over", "over * c"], SCHEMA, ["geocode"], ("n",)).collect()}
    assert got == {("over", "xy"): 2, ("over", "yz"): 2, ("over * c", "xy BY m"): 1, ("over * c", "xy BY n"): 1, ("over * c", "yz BY n"): 1, ("over * c", "yz BY m"): 1}
    assert L.answer(df.filter("false"), ["over", "total"], SCHEMA, ["geocode"], ("n",)).count() == 0


@pytest.mark.parametrize(("schema", "tables"), [(TB.households(), TB.HOUSEHOLDS), (TB.persons(), TB.PERSONS)])
def test_spread_is_bounded_by_the_lattice(schema, tables):
    names = list(dict.fromkeys(q for qs in tables.values() for q in qs))
    p = L.plan(schema, names)
    assert {n for _, n, _ in p.queries} == set(names) and len(names) > 100
    assert 5 * p.spread() < p.size(0) * len({k for k, _, _ in p.queries}) and sum(x == 0 for x in p.parent[1:]) <= 12
    for k in range(1, len(p.nodes)):
        assert all(L._step(a, b) is not None for a, b in zip(p.nodes[p.parent[k]], p.nodes[k], strict=True))
    more = L.plan(schema, names[: len(names) // 2])
    assert p.spread() < 2 * more.spread() + p.size(0)  # twice the queries, not twice the spread of the histogram


def test_tables_share_their_queries(spark):
    df = spark.createDataFrame([("g", 1, 1, 1, 3)], "geocode string, a int, b int, c int, n int")
    got = L.table_set(df, {"T1": ["total", "a"], "T2": ["total"]}, SCHEMA, ["geocode"], ("n",))
    assert {(r.table_name, r.query, r.level, r.n) for r in got.collect()} == {("T1", "total", "total", 3), ("T1", "a", "y", 3), ("T2", "total", "total", 3)}
    assert got.groupBy("query").agg(F.sum("n")).count() == 2
