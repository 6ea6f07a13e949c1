"""Queries for budget, noise, invariants, constraints and the top-down fit."""

from __future__ import annotations

import math
from fractions import Fraction
from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import attributes as A
from ..functions import strategies as S
from ..operators import fit as T
from ..operators import hist, noise as N
from ..sources.files import written
from . import base as B
from .base import HIER, SCHEMA, label_sql, query

_INV = "(q_num * geo_num * 4)::bigint as inv_scale_num, (q_den * geo_den * 9)::bigint as inv_scale_den"


def _meas(spark, d):
    """Every run's answers as measurements of units of its own: geocode = run/code."""
    a = B.answers(spark, d).withColumns({"geocode": F.concat("run_id", F.lit("/"), "geocode"), "noisy": F.col("priv")})
    return N.budget_attach(a, B.alloc(spark), (3, 2))


_M = f"(select a.* replace (a.run_id || '/' || a.geocode as geocode), a.priv as noisy, {_INV}, false as budget_error from answers a join alloc using (geolevel, query))"


@query("select geolevel, geocode, query, level, noisy, inv_scale_num, inv_scale_den, budget_error from " + _M)
def budget_attach(spark, d):
    return _meas(spark, d).select("geolevel", "geocode", "query", "level", "noisy", "inv_scale_num", "inv_scale_den", "budget_error")


@query(f"""select geolevel, query, spent, case when g1 = 0 and g2 = 1 then sum(spent) over (partition by g1, g2 order by case geolevel when 'Block' then 0 when 'Nation' then 1 else 2 end) end as cumulative from (
 select geolevel, query, sum(s) as spent, grouping(geolevel) as g1, grouping(query) as g2 from (select geolevel, query, max(inv_scale_num::double / inv_scale_den) as s from {_M} group by all) group by grouping sets ((geolevel, query), (geolevel), (query), ()))""", "spent cumulative")
def budget_rollup(spark, d):
    return N.budget_rollup(_meas(spark, d), [h for h, _ in HIER])


@query(f"select geolevel, min(s) as least, max(s) as most, max(s) - min(s) > 1e-12 as uneven from (select geolevel, geocode, sum(inv_scale_num::double / inv_scale_den) as s from {_M} group by all) group by all", "least most")
def budget_node_spent(spark, d):
    return N.budget_node_spent(_meas(spark, d))


_CELLS = "(select query, unnest(range(15)) as cell from (values ('total'), ('status')) v(query) where query = 'total' union all select 'status', unnest(range(12)))"


def _covers(spark):
    return spark.range(15).select(F.explode(F.array(F.lit("total"), F.when(F.col("id") < 12, "status"))).alias("query"), F.col("id").alias("cell")).filter("query is not null")


@query(f"select geolevel, min(x) as least, max(x) as most from (select geolevel, cell, sum(2 * eps / 2.0::double) as x from (select geolevel, query, max(inv_scale_num::double / inv_scale_den) as eps from {_M} group by all) join {_CELLS} using (query) group by all) group by all", "least most")
def budget_cell_impact(spark, d):
    return N.budget_cell_impact(_meas(spark, d), _covers(spark))


@query("select 'status' as query, cell, 0::bigint as times from (select distinct status * 5 + priority as cell from hist) where cell >= 12")
def budget_impact_gaps(spark, d):
    cells = B.hist(spark, d).select((F.col("status") * 5 + F.col("priority")).cast("long").alias("cell")).distinct()
    cover = _covers(spark).join(cells, "cell").withColumn("coef", F.lit(1))
    return N.budget_impact_gaps(cover, cells).withColumn("times", F.col("times").cast("long")).withColumn("cell", F.col("cell").cast("int"))


@query("select k.geolevel, k.geocode, 'status' as query, w.level, coalesce(a.orig, 0)::bigint as truth from (select distinct geolevel, geocode from rolled) k cross join (select unnest(['Filled', 'Open', 'Pending']) as level) w left join (select * from answers where query = 'status' and run_id = 'run_0') a using (geolevel, geocode, level) union all select geolevel, geocode, query, level, orig from answers where query = 'total' and run_id = 'run_0'")
def measure_query_answers(spark, d):
    return N.measure_query_answers(B.hist(spark, d), HIER, ["status", "total"], SCHEMA)


_KEY = "(geocode::bigint * 15 + status * 5 + priority)"
_UNI = lambda k: f"(((({k}) * 1103515245 + 12345) % 2147483648 + 0.5::double) / 2147483648.0::double)"


def _keyed(spark, d):
    return B.hist(spark, d).withColumn("k", F.col("geocode").cast("long") * 15 + F.col("status") * 5 + F.col("priority"))


_PG = f"(1 - exp(-{0.8} / 2))"


@query(f"select geocode, status, priority, (cnt + floor(ln({_UNI(_KEY)}) / ln(1 - {_PG})) - floor(ln({_UNI(_KEY + ' * 7 + 3')}) / ln(1 - {_PG})))::bigint as noisy, 2 * (1 - {_PG}) / ({_PG} * {_PG})::double as variance from hist", "variance")
def noise_geometric(spark, d):
    h = _keyed(spark, d)
    return N.noise_geometric(h, "cnt", F.lit(0.8), u=(N.uniform(F.col("k")), N.uniform(F.col("k") * 7 + 3))).select("geocode", "status", "priority", "noisy", "variance")


_GT = N.gaussian_table(2.25)
_GV = sum(x * x * (c - b) for (x, c), (_, b) in zip(_GT, [(0, 0.0), *_GT], strict=False))


@query(f"select geocode, status, priority, (cnt + {_GT[0][0]} + least(len(list_filter([{', '.join(repr(c) for _, c in _GT)}]::double[], lambda c: c < {_UNI(_KEY)})), {len(_GT) - 1}))::bigint as noisy, {_GV!r}::double as variance from hist", "variance")
def noise_discrete_gaussian(spark, d):
    h = _keyed(spark, d)
    return N.noise_discrete_gaussian(h, "cnt", 2.25, N.uniform(F.col("k"))).select("geocode", "status", "priority", "noisy", "variance")


_Z = lambda cos, ln: f"sqrt(-2 * {ln}({_UNI(_KEY)})) * {cos}(2 * {math.pi!r}::double * {_UNI(_KEY + ' * 7 + 3')})"


@query(f"select geocode, status, priority, round(cnt + 1.5 * {_Z('cos', 'ln')})::bigint as noisy, 2.25::double as variance from hist", "variance")
def noise_rounded_gaussian(spark, d):
    h = _keyed(spark, d)
    z = F.sqrt(-2 * F.log(N.uniform(F.col("k")))) * F.cos(2 * math.pi * N.uniform(F.col("k") * 7 + 3))
    return N.noise_rounded_gaussian(h, "cnt", 2.25, z).select("geocode", "status", "priority", "noisy", "variance")


@query("select geocode, status, priority, cnt as noisy, 1.0::double as variance from hist", "variance")
def noise_none(spark, d):
    return N.noise_none(B.hist(spark, d), "cnt").select("geocode", "status", "priority", "noisy", "variance")


@query("select geocode, status, priority, null::bigint as noisy, true as endless from hist")
def noise_unmeasured(spark, d):
    return N.noise_unmeasured(B.hist(spark, d), "cnt").select("geocode", "status", "priority", "noisy", (F.col("variance") == float("inf")).alias("endless"))


_IA = f"exp(-{0.8} / 2)"
_IK = f"greatest(0, ceil(ln(0.1::double * (1 + {_IA}) / 2) / ln({_IA})) - 1)"


_BITS = lambda k: f"((({k}) * 1103515245 + 12345) % 2147483648)"
_GI = N.gaussian_integers(Fraction(9, 4))
_GIV = sum(x * x * (c - b) for (x, c), (_, b) in zip(_GI, [(0, 0), *_GI], strict=False)) / 2**N.BITS


@query(f"select geocode, status, priority, (cnt + ([{', '.join(str(x) for x, _ in _GI)}])[1 + len(list_filter([{', '.join(str(c) for _, c in _GI)}]::bigint[], lambda c: c <= {_BITS(_KEY)} * 2147483648 + {_BITS(_KEY + ' * 7 + 3')}))])::bigint as noisy, {_GIV!r}::double as variance from hist", "variance")
def noise_discrete_gaussian_exact(spark, d):
    h = _keyed(spark, d)
    bits = lambda k: F.pmod(k * F.lit(1103515245) + 12345, F.lit(2147483648))
    r = bits(F.col("k")) * F.lit(2147483648) + bits(F.col("k") * 7 + 3)
    return N.noise_discrete_gaussian_exact(h, "cnt", Fraction(9, 4), r).select("geocode", "status", "priority", "noisy", "variance")


_SIX = [(level, n) for n, level in enumerate(S.LEVELS)]
_PL = {"hhgq": "unit_id % 8", "votingage": "(unit_id div 8) % 2", "hispanic": "(unit_id div 2) % 2", "cenrace": "(unit_id div 3) % 63"}
_STRATEGY = S.production()


def _asked(level: str, n: int) -> str:
    """A level's queries one by one, from the records."""
    code = f"substr(geocode, 1, {n})" if n else "'0'"
    part = lambda q: f"select '{level}' as geolevel, {code} as geocode, '{q}' as query, {label_sql(A.pl94(), q)} as level from r"
    return " union all ".join(map(part, _STRATEGY.queries[level]))


@query(f"""select geolevel, geocode, query, level, count(*) as truth, (q_num * geo_num * 4)::bigint as inv_scale_num, (q_den * geo_den * 9)::bigint as inv_scale_den
 from (with r as materialized (select geocode, {', '.join(f"({e.replace(' div ', ' // ')})::int as {c}" for c, e in _PL.items())} from units) {' union all '.join(_asked(*x) for x in _SIX)})
 join (values {', '.join(map(str, _STRATEGY.rows()))}) a(geolevel, query, geo_num, geo_den, q_num, q_den) using (geolevel, query) where level is not null group by all""")
def measure_strategy(spark, d):
    cells = hist.hist_sparse(B.units(spark, d).select("geocode", *[F.expr(e).cast("int").alias(c) for c, e in _PL.items()]), "geocode", list(_PL))
    return N.measure_strategy(cells, _SIX, A.pl94(), _STRATEGY, (3, 2))


@query(f"select geocode, run_id, status, priority, (priv - {_IK})::bigint as lower, (priv + {_IK})::bigint as upper from analysis")
def noise_interval(spark, d):
    a = B.analysis(spark, d).withColumnRenamed("priv", "noisy")
    return N.noise_interval(a, 0.9, F.lit(0.8)).select("geocode", "run_id", "status", "priority", "lower", "upper")


def _blocks(spark, d):
    return _meas(spark, d).filter("geolevel = 'Block'").withColumns({"parent_geocode": F.substring("geocode", 1, 9), "variance": F.lit(2.0) + F.substring("geocode", 7, 5).cast("long") % 3})


_BL = f"(select m.*, substr(geocode, 1, 9) as parent_geocode, (2.0 + substr(geocode, 7)::bigint % 3)::double as variance from {_M} m where geolevel = 'Block')"


@query(f"select parent_geocode as geocode, query, level, sum(noisy)::bigint as noisy, sum(variance) as variance, false as mixed from {_BL} group by all", "variance")
def measure_sum_children(spark, d):
    return N.measure_sum_children(_blocks(spark, d))


@query(f"""select geocode, query, level, cv / (5.0 + cv) * un + 5.0 / (5.0 + cv) * cn as noisy, 5.0 * cv / (5.0 + cv) as variance from (select substr(geocode, 1, 9) as geocode, query, level, max(case when geolevel = 'Nation' then noisy end) as un,
 sum(case when geolevel = 'Block' then noisy end) as cn, sum(case when geolevel = 'Block' then 2.0 + substr(geocode, 7)::bigint % 3 end)::double as cv from {_M} where geolevel <> 'Region' group by 1, 2, 3) where un is not null and cn is not null""", "noisy variance")
def measure_pool(spark, d):
    up = _meas(spark, d).filter("geolevel = 'Nation'").select("geocode", "query", "level", "noisy", F.lit(5.0).alias("variance"))
    return N.measure_pool(up, N.measure_sum_children(_blocks(spark, d)))


@query(f"select geocode, query, level, variance / min(variance) over (partition by parent_geocode) as variance from {_BL}", "variance")
def measure_rescale_variance(spark, d):
    return N.measure_rescale_variance(_blocks(spark, d)).select("geocode", "query", "level", "variance")


# invariants and constraints

_TYPES = {"Urgent": "priority = 0", "Other": "priority > 0"}


def _inv(spark, d):
    p = hist.hist_sparse(B.persons(spark, d), "geocode", ["age"])
    return T.invariant_vectors(p, B.hist(spark, d), "age >= 18", _TYPES)


_I = """(select geocode, 'tot' as invariant, 'total' as level, count(*) as value from persons group by all union all select geocode, 'va', 'adults', count(*) filter (age >= 18) from persons group by all
 union all select geocode, 'gqhh_tot', 'total', count(*) from units group by all union all select geocode, 'gqhh_vect', 'Urgent', count(*) filter (priority = 0) from units group by all union all select geocode, 'gqhh_vect', 'Other', count(*) filter (priority > 0) from units group by all)"""


@query(f"select * from {_I}")
def invariant_vectors(spark, d):
    return _inv(spark, d)


@query(f"select substr(geocode, 1, 3) as geocode, invariant, level, sum(value)::bigint as value from {_I} group by all")
def invariant_rollup(spark, d):
    return T.invariant_rollup(_inv(spark, d), 3)


_C = f"(select 'total' as name, geocode, 'total' as query, 'total' as level, '=' as sign, value as rhs from {_I} where invariant = 'tot' union all select 'gq_lower', geocode, 'priority', priority::varchar, 'ge', count(*) from units group by geocode, priority)"


def _cons(spark, d):
    low = B.units(spark, d).groupBy("geocode", "priority").agg(F.count(F.lit(1)).alias("rhs")).select(F.lit("gq_lower").alias("name"), "geocode", F.lit("priority").alias("query"), F.col("priority").cast("string").alias("level"), F.lit("ge").alias("sign"), "rhs")
    return T.constraint_total(_inv(spark, d)).unionByName(low)


@query(f"select name, geocode, query, level, sign, case when name = 'gq_lower' and level = '0' then greatest(rhs, 20) else rhs end::bigint as rhs from (select name, substr(geocode, 1, 3) as geocode, query, level, sign, sum(rhs) as rhs from {_C} group by all)")
def constraint_rollup(spark, d):
    c = _cons(spark, d)
    own = c.filter("name = 'gq_lower' and level = '0'").select("name", F.substring("geocode", 1, 3).alias("geocode"), "query", "level", "sign").distinct().withColumn("rhs", F.lit(20).cast("long"))
    return T.constraint_rollup(c, own, 3).select("name", "geocode", "query", "level", "sign", "rhs")


def _facilities(spark, d):
    u = B.units(spark, d).groupBy("geocode", F.col("priority").alias("type")).agg(F.count(F.lit(1)).alias("units"))
    t = B.persons(spark, d).groupBy("geocode").agg(F.count(F.lit(1)).alias("total"), F.count_if(F.col("age") < 18).alias("minors"), F.count_if(F.col("age") >= 18).alias("adults"))
    return u, t


_F = "(select u.geocode, u.type, u.units, t.total, t.minors, t.adults, sum(units) over (partition by u.geocode) - units as others from (select geocode, priority as type, count(*) as units from units group by all) u join (select geocode, count(*) as total, count(*) filter (age < 18) as minors, count(*) filter (age >= 18) as adults from persons group by all) t on u.geocode = t.geocode)"


@query(f"select 'gq_lower' as name, geocode, 'type' as query, type::varchar as level, 'ge' as sign, units as rhs from {_F} union all select 'gq_upper', geocode, 'type', type::varchar, 'le', least(total - others, units * 99999)::bigint from {_F}")
def constraint_gq_bounds(spark, d):
    u, t = _facilities(spark, d)
    return T.constraint_gq_bounds(u, t.select("geocode", "total"))


@query(f"select 'gq_va_upper' as name, geocode, 'type * votingage' as query, type || ' BY minors' as level, 'le' as sign, least(minors, units * 99999) as rhs from {_F} union all select 'gq_va_upper', geocode, 'type * votingage', type || ' BY adults', 'le', least(adults, units * 99999) from {_F} union all select 'gq_va_lower', geocode, 'type * votingage', type || ' BY adults', 'ge', greatest(0, units - minors) from {_F}")
def constraint_gq_voting_bounds(spark, d):
    u, t = _facilities(spark, d)
    return T.constraint_gq_voting_bounds(u, t.drop("total"))


@query(f"select 'total' as name, geocode, 'total' as query, 'total' as level, '=' as sign, value as rhs from {_I} where invariant = 'tot'")
def constraint_total(spark, d):
    return T.constraint_total(_inv(spark, d))


@query(f"select 'voting_age' as name, geocode, 'votingage' as query, 'adults' as level, '=' as sign, value as rhs from {_I} where invariant = 'va'")
def constraint_voting_age(spark, d):
    return T.constraint_voting_age(_inv(spark, d))


@query("select distinct 'nurse_nva_0' as name, geocode, 'nursing * nonvoting' as query, 'Nursing BY minors' as level, '=' as sign, 0::bigint as rhs from units")
def constraint_nursing_minors(spark, d):
    return T.constraint_nursing_minors(_inv(spark, d))


@query("select geocode, status, priority, cnt, 'status = 0 and priority = 3' as rule from hist where status = 0 and priority = 3 union all select geocode, status, priority, cnt, 'priority = 4' from hist where priority = 4")
def constraint_structural_zeros(spark, d):
    return T.constraint_structural_zeros(B.hist(spark, d), ["status = 0 and priority = 3", "priority = 4"])


@query("""select geocode, r as relgq, age, count(*) as cnt from (select geocode, ((unit_id * 5 + l_linenumber) % 42)::int as r, (unit_id % 100)::int as age from persons) where (r between 0 and 5 or r between 18 and 22) and age < 15 or r in (6, 7, 8) and age > 89 or r in (10, 12) and age < 30
  or r = 11 and age > 74 or r = 13 and (age < 15 or age > 89) or r = 16 and age > 20 or r in (23, 31, 34, 35) and (age < 17 or age > 65) or r in (24, 25, 26) and age > 25 or r = 27 and age < 20 or r = 32 and (age < 3 or age > 30) or r = 33 and (age < 16 or age > 65)
  or r in (37, 38) and age < 16 or r in (39, 40) and (age < 16 or age > 75) group by all""")
def constraint_legal_ages(spark, d):
    p = B.persons(spark, d).select("geocode", ((F.col("unit_id") * 5 + F.col("l_linenumber")) % 42).cast("int").alias("relgq"), (F.col("unit_id") % 100).cast("int").alias("age"))
    return T.constraint_structural_zeros(hist.hist_sparse(p, "geocode", ["relgq", "age"]), A.age_rules()).select("geocode", "relgq", "age", "cnt")


@query("select geocode, 'status = 0' as rule, a as lhs, 1.5 * b::double as bound from (select geocode, sum(case when status = 0 then cnt else 0 end)::bigint as a, sum(case when status = 1 then cnt else 0 end)::bigint as b from hist group by all) where a > 1.5 * b", "bound")
def constraint_household_bounds(spark, d):
    return T.constraint_household_bounds(B.hist(spark, d), [("status = 0", "status = 1", 1.5)])


@query("select geocode, status, priority, cnt from hist where (status, priority) in (select (status, priority) from hist group by status, priority having sum(cnt) % 3 = 0)")
def constraint_household_size(spark, d):
    h = B.hist(spark, d)
    bad = h.groupBy("status", "priority").agg(F.sum("cnt").alias("n")).filter("n % 3 = 0")
    return T.constraint_household_size(h, bad, ["status", "priority"]).select("geocode", "status", "priority", "cnt")


@query("select coalesce(a.geocode, b.geocode) as geocode, coalesce(x, 0)::bigint as x, coalesce(y, 0)::bigint as y from (select geocode, sum(cnt) as x from hist where status = 0 group by all) a full join (select geocode, sum(cnt) as y from hist where status = 1 group by all) b using (geocode) where coalesce(x, 0) > coalesce(y, 0)")
def constraint_cross_universe(spark, d):
    h = B.hist(spark, d)
    return T.constraint_cross_universe(h.filter("status = 0"), h.filter("status = 1"), "le")


@query(f"select c.name, c.geocode, c.query, c.level, c.sign, c.rhs, coalesce(v.n, 0)::bigint as lhs, case sign when '=' then coalesce(v.n, 0) = rhs when 'le' then coalesce(v.n, 0) <= rhs else coalesce(v.n, 0) >= rhs end as ok from {_C} c left join (select geocode, 'total' as query, 'total' as level, count(*) as n from persons group by all union all select geocode, 'priority', priority::varchar, count(*) from moved group by geocode, priority) v on c.geocode = v.geocode and c.query = v.query and c.level = v.level")
def constraint_check(spark, d):
    a = B.persons(spark, d).groupBy("geocode").agg(F.count(F.lit(1)).alias("value")).select("geocode", F.lit("total").alias("query"), F.lit("total").alias("level"), "value")
    b = B.moved(spark, d).groupBy("geocode", "priority").agg(F.count(F.lit(1)).alias("value")).select("geocode", F.lit("priority").alias("query"), F.col("priority").cast("string").alias("level"), "value")
    return T.constraint_check(a.unionByName(b), _cons(spark, d)).select("name", "geocode", "query", "level", "sign", "rhs", "lhs", "ok")


# the fit: nations' true cells as parents, blocks' protected cells as children


_CELL = ["run_id", "priority"]


def _each_run(df):
    """True totals beside every run's counts."""
    return df.withColumn("run_id", F.explode(F.lit(["run_0", "run_1", "run_2"])))


def _family(spark, d):
    parent = _each_run(B.hist(spark, d).groupBy(F.substring("geocode", 1, 3).alias("geocode"), "priority").agg(F.sum("cnt").alias("total")))
    child = B.analysis(spark, d).groupBy("geocode", *_CELL).agg(F.sum("priv").cast("double").alias("x"))
    return parent, child.withColumns({"parent_geocode": F.substring("geocode", 1, 3), "variance": (1 + F.col("geocode").cast("long") % 4).cast("double")})


_FAM = """fam as (select c.geocode, substr(c.geocode, 1, 3) as parent_geocode, c.run_id, c.priority, c.x, (1 + c.geocode::bigint % 4)::double as variance, p.total from (select geocode, run_id, priority, sum(priv)::double as x from analysis group by all) c
 left join (select substr(geocode, 1, 3) as g, priority, sum(cnt)::bigint as total from hist group by all) p on p.g = substr(c.geocode, 1, 3) and p.priority = c.priority),
con as (select geocode, parent_geocode, run_id, priority, x + (total - sum(x) over w) * variance / sum(variance) over w as x, total from fam window w as (partition by parent_geocode, run_id, priority)),
th as (select *, sum(x) over (partition by parent_geocode, run_id, priority order by x desc, geocode rows unbounded preceding) as s, row_number() over (partition by parent_geocode, run_id, priority order by x desc, geocode) as k from con),
non as (select geocode, parent_geocode, run_id, priority, greatest(x - max((s - total) / k) over (partition by parent_geocode, run_id, priority), 0) as x, total from th),
flo as (select geocode, parent_geocode, run_id, priority, total, floor(round(x, 9))::bigint as f, round(x, 9) - floor(round(x, 9)) as r from non),
rou as (select geocode, parent_geocode, run_id, priority, f + (row_number() over (partition by parent_geocode, run_id, priority order by r desc, geocode) <= total - sum(f) over (partition by parent_geocode, run_id, priority))::bigint as x, total from flo)"""
_W = lambda body: f"select * from (with {_FAM} {body})"
@query(_W("select geocode, parent_geocode, run_id, priority, x from con"), "x")
def topdown_consistent(spark, d):
    parent, child = _family(spark, d)
    return T.topdown_consistent(parent, child, _CELL, "variance").select("geocode", "parent_geocode", *_CELL, "x")


@query(_W("select geocode, parent_geocode, run_id, priority, x from non"), "x")
def topdown_nonnegative(spark, d):
    parent, child = _family(spark, d)
    return T.topdown_nonnegative(parent, T.topdown_consistent(parent, child, _CELL, "variance"), _CELL).select("geocode", "parent_geocode", *_CELL, "x")


@query(_W("select geocode, parent_geocode, run_id, priority, x from rou"))
def topdown_round(spark, d):
    parent, child = _family(spark, d)
    return T.fit_level(parent, child, _CELL).select("geocode", "parent_geocode", *_CELL, "x")


@query("""select geocode, parent_geocode, run_id, status, priority, case when settled then total::double else x end as x, settled from (select c.*, p.total, count(*) over (partition by c.parent_geocode, c.run_id, c.status, c.priority) = 1 or p.total = 0 as settled
  from (select geocode, substr(geocode, 1, 3) as parent_geocode, run_id, status, priority, priv::double as x from analysis) c join (select substr(geocode, 1, 3) as g, status, priority, sum(case when cnt > 1 then cnt else 0 end)::bigint as total from hist group by all) p
  on p.g = c.parent_geocode and p.status = c.status and p.priority = c.priority)""", "x")
def topdown_shortcuts(spark, d):
    """Families of (status, priority) in a nation: rare ones have a single child or, counting blocks of two and more, an empty parent."""
    cell = ["run_id", "status", "priority"]
    parent = B.hist(spark, d).groupBy(F.substring("geocode", 1, 3).alias("geocode"), *cell[1:]).agg(F.sum(F.when(F.col("cnt") > 1, F.col("cnt")).otherwise(0)).alias("total"))
    parent = _each_run(parent)
    child = B.analysis(spark, d).select("geocode", F.substring("geocode", 1, 3).alias("parent_geocode"), *cell, F.col("priv").cast("double").alias("x"))
    return T.topdown_shortcuts(parent, child, cell).select("geocode", "parent_geocode", *cell, "x", "settled")


_ROUND = """a{k} as (select * replace (x - variance * share as x, y + 2.0 * share as y) from (select *, (sum(x) over w - y) / (sum(variance) over w + 2.0) as share from b{j} window w as (partition by geocode, status))),
b{k} as (select geocode, parent_geocode, status, priority, x + (total - sum(x) over w) * variance / sum(variance) over w as x, y, variance, total from a{k} window w as (partition by parent_geocode, status, priority)),
"""


@query("""select geocode, parent_geocode, status, priority, x from (with b0 as (select c.geocode, substr(c.geocode, 1, 3) as parent_geocode, c.status, c.priority, c.priv::double as x, m.y, (1 + c.geocode::bigint % 4)::double as variance, p.total from analysis c
 join (select geocode, status, sum(priv)::double as y from analysis where run_id = 'run_1' group by all) m on m.geocode = c.geocode and m.status = c.status
 join (select substr(geocode, 1, 3) as g, status, priority, sum(cnt)::bigint as total from hist group by all) p on p.g = substr(c.geocode, 1, 3) and p.status = c.status and p.priority = c.priority where c.run_id = 'run_2'),
""" + "".join(_ROUND.format(k=k, j=k - 1) for k in (1, 2)).rstrip(",\n") + " select * from b2)", "x")
def topdown_queries(spark, d):
    cell, a = ["status", "priority"], B.analysis(spark, d)
    parent = B.hist(spark, d).groupBy(F.substring("geocode", 1, 3).alias("geocode"), *cell).agg(F.sum("cnt").alias("total"))
    child = a.filter("run_id = 'run_2'").select("geocode", F.substring("geocode", 1, 3).alias("parent_geocode"), *cell, F.col("priv").cast("double").alias("x"), (1 + F.col("geocode").cast("long") % 4).cast("double").alias("variance"))
    answers = a.filter("run_id = 'run_1'").groupBy("geocode", F.col("status").cast("string").alias("level")).agg(F.sum("priv").alias("noisy")).withColumns({"query": F.lit("status"), "variance": F.lit(2.0)})
    return T.topdown_queries(parent, child, cell, answers, {"status": "cast(status as string)"}, 2).select("geocode", "parent_geocode", *cell, "x")


@query("""select geolevel, geocode, run_id, priority, x from (with root as (select substr(geocode, 1, 1) as geocode, run_id, priority, greatest(0, sum(priv))::bigint as x from analysis group by 1, 2, 3),
""" + "".join(f"""f{n} as (select c.geocode, p.geocode as parent, c.run_id, c.priority, c.x, 1.0::double as variance, coalesce(p.x, 0) as total from (select substr(geocode, 1, {n}) as geocode, run_id, priority, sum(priv)::double as x from analysis group by 1, 2, 3) c left join {up} p on p.geocode = substr(c.geocode, 1, {m}) and p.run_id = c.run_id and p.priority = c.priority),
c{n} as (select geocode, parent, run_id, priority, x + (total - sum(x) over w) * variance / sum(variance) over w as x, total from f{n} window w as (partition by parent, run_id, priority)),
t{n} as (select *, sum(x) over (partition by parent, run_id, priority order by x desc, geocode rows unbounded preceding) as s, row_number() over (partition by parent, run_id, priority order by x desc, geocode) as k from c{n}),
n{n} as (select geocode, parent, run_id, priority, round(greatest(x - max((s - total) / k) over (partition by parent, run_id, priority), 0), 9) as x, total from t{n}),
r{n} as (select geocode, run_id, priority, (floor(x) + (row_number() over (partition by parent, run_id, priority order by x - floor(x) desc, geocode) <= total - sum(floor(x)) over (partition by parent, run_id, priority))::int)::bigint as x from n{n}),
""" for n, m, up in ((3, 1, "root"), (5, 3, "r3"))).rstrip(",\n") + " select 'Region' as geolevel, * from root union all select 'Nation', * from r3 union all select 'Block', * from r5)")
def topdown_levels(spark, d):
    m = hist.geo_rollup(B.analysis(spark, d), HIER, _CELL, ("priv",)).withColumnRenamed("priv", "noisy").withColumn("variance", F.lit(1.0))
    return T.topdown_levels(m, HIER, _CELL)


_NEAR = "case when priority < 2 then 'pressing' else 'other' end"
@query(f"""select geocode, run_id, kind, level, low, most, true as ok from (with
fam as (select c.geocode, substr(c.geocode, 1, 3) as parent, c.run_id, c.priority, c.x, p.total from (select geocode, run_id, priority, sum(priv)::double as x from analysis group by all) c
  join (select substr(geocode, 1, 3) as g, priority, sum(cnt) as total from hist group by all) p on p.g = substr(c.geocode, 1, 3) and p.priority = c.priority),
con as (select * replace (x + (total - sum(x) over w) / count(*) over w as x) from fam window w as (partition by parent, run_id, priority)),
th as (select *, sum(x) over (partition by parent, run_id, priority order by x desc, geocode rows unbounded preceding) as s, row_number() over (partition by parent, run_id, priority order by x desc, geocode) as k from con),
non as (select geocode, parent, run_id, priority, total, greatest(x - max((s - total) / k) over (partition by parent, run_id, priority), 0) as x from th)
select geocode, run_id, 'near' as kind, {_NEAR} as level, floor(round(sum(x), 6))::bigint as low, ceil(round(sum(x), 6))::bigint as most from non group by all
union all select geocode, run_id, 'total', 'total', floor(round(sum(x), 6))::bigint, ceil(round(sum(x), 6))::bigint from non group by all
union all select parent, run_id, 'parent', priority::varchar, max(total)::bigint, max(total)::bigint from non group by parent, run_id, priority)""")
def topdown_round_queries(spark, d):
    """Bounds that the real sums set to every block's sums and every nation's cells, and whether the rounded ones keep them."""
    parent = B.hist(spark, d).groupBy(F.substring("geocode", 1, 3).alias("geocode"), "priority").agg(F.sum("cnt").alias("total")).withColumn("run_id", F.explode(F.lit(["run_0", "run_1", "run_2"])))
    child = B.analysis(spark, d).groupBy("geocode", *_CELL).agg(F.sum("priv").cast("double").alias("x")).withColumn("parent_geocode", F.substring("geocode", 1, 3))
    real = T.topdown_nonnegative(parent, T.topdown_consistent(parent, child, _CELL), _CELL)
    level_of = {"total": "run_id", "near": f"concat(run_id, {_NEAR})"}
    got = T.topdown_round_queries(parent, real, _CELL, level_of)
    sums = [F.sum("x").alias("x"), F.round(F.sum("fitted"), 6).alias("real")]
    kinds = [got.groupBy("geocode", "run_id", F.lit("near").alias("kind"), F.expr(_NEAR).alias("level")).agg(*sums), got.groupBy("geocode", "run_id", F.lit("total").alias("kind"), F.lit("total").alias("level")).agg(*sums)]
    kinds.append(got.groupBy(F.col("parent_geocode").alias("geocode"), "run_id", F.lit("parent").alias("kind"), F.col("priority").cast("string").alias("level")).agg(*sums))
    low, most = F.floor("real"), F.ceil("real")
    return reduce(lambda a, b: a.unionByName(b), kinds).select("geocode", "run_id", "kind", "level", low.alias("low"), most.alias("most"), F.col("x").between(low, most).alias("ok"))


@query(f"""select geolevel, geocode, run_id, sum(orig)::bigint as total, (coalesce(sum(case when priority < 2 then orig end), 0) + 1)::bigint as bound, 0::bigint as broken from rolled group by all""")
def topdown_levels_queries(spark, d):
    """Every level's fit of cells and of a query's answers, under true totals and an upper bound: the totals, and how many rows break the bound or x >= 0."""
    keys = ["geolevel", "geocode", "run_id"]
    cells = written(B.rolled(spark, d).groupBy(*keys, "priority").agg(F.sum("orig").alias("orig"), F.sum("priv").alias("noisy")))
    all_ = cells.select(*keys).distinct().withColumn("priority", F.explode(F.lit(list(range(5))))).join(cells, [*keys, "priority"], "left").fillna(0, ["orig", "noisy"])
    all_ = written(all_)  # every level and query reads it
    meas = all_.withColumn("variance", F.lit(2.0))
    near = F.concat("run_id", F.expr(_NEAR))
    by = all_.groupBy("geolevel", "geocode", near.alias("level")).agg(F.sum("orig").alias("orig"), F.sum("noisy").alias("noisy"))
    answers = by.select("geolevel", "geocode", F.lit("near").alias("query"), "level", "noisy", F.lit(1.0).alias("variance"))
    upper = by.filter("level like '%pressing'").select("geolevel", "geocode", F.lit("near").alias("query"), "level", F.lit("le").alias("sign"), (F.col("orig") + 1).alias("rhs"))
    total = all_.groupBy("geolevel", "geocode", F.col("run_id").alias("level")).agg(F.sum("orig").alias("rhs")).select("geolevel", "geocode", F.lit("total").alias("query"), "level", F.lit("=").alias("sign"), "rhs")
    got = T.topdown_levels(meas, HIER, _CELL, level_of={"total": "run_id", "near": f"concat(run_id, {_NEAR})"}, answers=answers, bounds=total.unionByName(upper))
    pressing = F.sum(F.when(F.col("priority") < 2, F.col("x")).otherwise(0))
    sums = got.groupBy(*keys).agg(F.sum("x").alias("total"), pressing.alias("p"), F.sum((F.col("x") < 0).cast("long")).alias("broken"))
    bound = upper.select("geolevel", "geocode", F.substring("level", 1, 5).alias("run_id"), F.col("rhs").alias("bound"))
    return sums.join(bound, keys).select(*keys, "total", "bound", (F.col("broken") + (F.col("p") > F.col("bound")).cast("long")).alias("broken"))


@query("select geocode, g as parent_geocode, run_id, priority, x + (total - sum(x) over w) / count(*) over w as x from (select c.*, p.total from (select geocode, substr(geocode, 2, 2) as g, run_id, priority, sum(priv)::double as x from analysis group by all) c join (select substr(geocode, 2, 2) as g, priority, sum(cnt) as total from hist group by all) p using (g, priority)) window w as (partition by g, run_id, priority)", "x")
def topdown_state_groups(spark, d):
    _, child = _family(spark, d)
    parent = _each_run(B.hist(spark, d).groupBy(F.substring("geocode", 2, 2).alias("geocode"), "priority").agg(F.sum("cnt").alias("total")))
    return T.topdown_state_groups(parent, child, _CELL, "substr(geocode, 2, 2)").select("geocode", "parent_geocode", *_CELL, "x")


_CLIP = """r{k} as (select * exclude (miss, room, upto) replace (x + sign(miss)::bigint * greatest(0, least(room, abs(miss) - (upto - room))) as x) from (select *, sum(room) over (partition by parent_geocode, run_id, priority order by geocode rows unbounded preceding) as upto
  from (select *, case when miss > 0 then hi - x when miss < 0 then x - lo else 0 end as room from (select *, goal - sum(x) over (partition by parent_geocode, run_id, priority) as miss from r{j})))),
"""


@query("""select geocode, parent_geocode, run_id, priority, x::bigint as x from (with c as (select geocode, substr(geocode, 1, 3) as parent_geocode, geocode::bigint as k, run_id, priority, sum(priv)::bigint as x from analysis group by all),
b as (select *, case when k % 5 = 0 then 0 else greatest(x - 2, 0) end as l, case when k % 3 = 0 then greatest(x - 1, 0) else x + 2 end as h from c),
r0 as (select geocode, parent_geocode, run_id, priority, least(greatest(x, lo), hi) as x, lo, hi, goal from (select *, least(l, h) as lo, case when row_number() over (partition by parent_geocode, run_id, priority order by geocode desc) = 1 then 10000 else h end as hi, sum(x) over (partition by parent_geocode, run_id, priority) as goal from b)),
""" + "".join(_CLIP.format(k=k, j=k - 1) for k in (1, 2, 3, 4)).rstrip(",\n") + " select * from r4)")
def topdown_bounds_clip(spark, d):
    """Bounds tighter than the counts at both ends, wide enough for every family."""
    _, child = _family(spark, d)
    k = F.col("geocode").cast("long")
    child = child.withColumns({"x": F.col("x").cast("long"), "lo": F.when(k % 5 == 0, 0).otherwise(F.greatest(F.col("x").cast("long") - 2, F.lit(0))), "hi": F.when(k % 3 == 0, F.greatest(F.col("x").cast("long") - 1, F.lit(0))).otherwise(F.col("x").cast("long") + 2)})
    child = child.withColumns({"lo": F.least("lo", "hi"), "hi": F.when(F.row_number().over(Window.partitionBy("parent_geocode", *_CELL).orderBy(F.col("geocode").desc())) == 1, F.lit(10000)).otherwise(F.col("hi"))})
    return T.topdown_bounds_clip(child, _CELL).select("geocode", "parent_geocode", *_CELL, F.col("x").cast("long").alias("x"))


@query(_W("select 'Block' as geolevel, count(*) filter (bad) as infeasible from (select parent_geocode, bool_or(total <> x) as bad from (select parent_geocode, run_id, priority, max(total) as total, sum(floor(x))::bigint as x from non group by all) group by all)"))
def topdown_infeasible_count(spark, d):
    parent, child = _family(spark, d)
    x = T.topdown_nonnegative(parent, T.topdown_consistent(parent, child, _CELL, "variance"), _CELL)
    sums = x.groupBy("parent_geocode", *_CELL).agg(F.sum(F.floor("x")).alias("x")).join(parent.select(F.col("geocode").alias("parent_geocode"), *_CELL, "total"), ["parent_geocode", *_CELL])
    return T.topdown_infeasible_count(sums.withColumn("geolevel", F.lit("Block")))


@query("select a.geocode, a.run_id, a.status, a.priority, least(a.priv, h.cnt) as priv from analysis a join hist h using (geocode, status, priority) where least(a.priv, h.cnt) > 0")
def cap_by_reference(spark, d):
    a = B.analysis(spark, d).select("geocode", "run_id", "status", "priority", "priv")
    return T.cap_by_reference(a, B.hist(spark, d), ["geocode", "status", "priority"])
