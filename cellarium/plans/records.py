"""Queries for sinks, expansion and cross-table validation.

Sinks write to a folder of the run beside the tables' session (spark.checkpoint.dir, or a temporary one in
local mode) and give back what a reader finds there.
"""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import expand as E
from ..operators import validate as V
from ..sources import files
from . import base as B
from .base import query


folder = files.scratch


@query("select geocode, status::varchar as status, unit_id::varchar as unit_id from units")
def sink_piped_sorted(spark, d):
    path = folder(spark)
    files.sink_piped_sorted(B.units(spark, d).select("geocode", "status", "unit_id"), path, ["geocode", "unit_id"])
    return files.scan_piped_protected(spark, path)


@query("select count(*) as records, 'r1' as run_id from units")
def sink_with_metadata(spark, d):
    return files.sink_with_metadata(B.units(spark, d).select("geocode", "status"), folder(spark), {"run_id": "r1"}).select("records", "run_id")


@query("select geocode, cnt as x from hist union all select geocode, status from hist")
def sink_multi(spark, d):
    path = folder(spark)
    files.sink_multi(B.hist(spark, d), {f"{path}/a": ["geocode", F.col("cnt").alias("x")], f"{path}/b": ["geocode", F.col("status").cast("long").alias("x")]})
    return spark.read.parquet(f"{path}/a").unionByName(spark.read.parquet(f"{path}/b"))


@query("select geocode, priority, cnt from hist")
def sink_block_table(spark, d):
    path = folder(spark)
    files.sink_block_table(B.hist(spark, d), path, ["geocode", "priority", "cnt"])
    return spark.read.parquet(path)


def _saved(spark, d):
    path = folder(spark)
    m = B.answers(spark, d).select("geolevel", F.concat("geocode", F.lit("/"), "run_id").alias("geocode"), F.substring("geocode", 1, 3).alias("parent_geocode"), "query", "level", F.col("priv").alias("noisy"))
    files.sink_measurements(m, path, "r0", by_parent=8)
    files.sink_measurements(m.withColumn("noisy", F.col("noisy") + 1).withColumn("geolevel", F.concat(F.lit("opt_"), "geolevel")), f"{path}-2", "r0")
    return path


@query("select geolevel, geocode || '/' || run_id as geocode, query, level, priv as noisy from answers")
def sink_measurements(spark, d):
    return files.load_saved_measurements(spark, _saved(spark, d), "r0").select("geolevel", "geocode", "query", "level", "noisy")


@query("select geocode || '/' || run_id as geocode, query, level, priv as noisy from answers where geolevel = 'Nation'")
def load_saved_measurements(spark, d):
    return files.load_saved_measurements(spark, _saved(spark, d), "r0", "Nation").select("geocode", "query", "level", "noisy")


@query("select geocode, run_id, plb, budget_group, status, priority, priv from analysis")
def drop_true_counts(spark, d):
    return files.drop_true_counts(B.analysis(spark, d))


# expansion


@query("select geocode, status::varchar as s, (priority + 1)::varchar as p from units")
def expand_to_records(spark, d):
    return E.expand_to_records(B.hist(spark, d), "cnt", [("geocode", "geocode"), ("s", "cast(status as string)"), ("p", "cast(priority + 1 as string)")])


@query("select geocode, count(*) filter (status = 0) as n_0, count(*) filter (status = 1) as n_1, count(*) filter (status = 2) as n_2 from units group by all")
def counts_wide_by_block(spark, d):
    return E.counts_wide_by_block(B.hist(spark, d), "status", [0, 1, 2])


def _homes(spark, d):
    u = B.units(spark, d)
    kind = F.when(F.col("priority") < 3, "housing").otherwise(F.concat(F.lit("gq"), F.col("priority")))
    units = u.groupBy("geocode", kind.alias("kind")).agg(F.count(F.lit(1)).alias("units"))
    return u.filter("priority < 3 and status <> 2").groupBy("geocode").agg(F.count(F.lit(1)).alias("n")), units


@query("select geocode, case when priority > 2 then 'gq' || priority when status = 2 then 'vacant' else 'household' end as kind, count(*) as n from units group by all")
def expand_vacant_and_gq(spark, d):
    return E.expand_vacant_and_gq(*_homes(spark, d)).groupBy("geocode", "kind").agg(F.count(F.lit(1)).alias("n"))


@query("select geocode, 'gq' as kind from units where priority > 2")
def expand_gq_residual(spark, d):
    h = B.hist(spark, d)
    return E.expand_gq_residual(h.filter("priority <= 2"), h.groupBy("geocode").agg(F.sum("cnt").alias("units")))


@query("select unit_id, case when row_number() over (partition by geocode, status order by unit_id) <= k then 'mortgage' else 'clear' end as detail from units join (select geocode, status, count(*) filter (priority < 2) as k from units group by all) using (geocode, status)")
def assign_detail_in_order(spark, d):
    u = B.units(spark, d)
    k = u.groupBy("geocode", "status").agg(F.count_if(F.col("priority") < 2).alias("k"))
    return E.assign_detail_in_order(u, k, ["geocode", "status"], ["unit_id"], ("mortgage", "clear")).select("unit_id", "detail")


# validation


@query("select unit_id from units where geocode not in (select geocode from xwalk where segment <> '99999')")
def val_unit_reference(spark, d):
    return V.val_unit_reference(B.units(spark, d), B.xwalk(spark, d).filter("segment <> '99999'")).select("unit_id")


@query("select (select count(*) from units) as n_a, (select count(*) from moved where unit_id % 50 <> 1) as n_b, false as equal")
def val_unit_total(spark, d):
    return V.val_unit_total(B.units(spark, d), B.moved(spark, d).filter("unit_id % 50 <> 1"))


@query("select n_a, n_b, n_a = n_b as equal from (select count(*) as n_a, count(*) filter (not (unit_id % 97 = 0 and sex = 0)) as n_b from persons)")
def val_person_total(spark, d):
    """The output has lost some persons."""
    p = B.persons(spark, d)
    return V.val_person_total(p, p.filter("not (unit_id % 97 = 0 and sex = 0)"))


_TC = "select coalesce(a.geocode, b.geocode) as geocode, coalesce(a.priority, b.priority) as priority, coalesce(n_a, 0) as n_a, coalesce(n_b, 0) as n_b from (select geocode, priority, count(*) as n_a from units group by all) a full join (select geocode, priority, count(*) as n_b from moved group by all) b using (geocode, priority)"


@query(f"select * from ({_TC}) where n_a <> n_b")
def val_type_counts(spark, d):
    return V.val_type_counts(B.units(spark, d), B.moved(spark, d), ["geocode", "priority"])


@query("select unit_id from units where status = 1 and priority not in (0, 1, 2)")
def val_occupied(spark, d):
    return V.val_occupied(B.units(spark, d), "status = 1", "priority in (0, 1, 2)").select("unit_id")


@query("select 'status = 2 and priority = 0' as rule, count(*) as n from units where status = 2 and priority = 0 having count(*) > 0 union all select 'price < 1000', count(*) from units where price < 1000 having count(*) > 0")
def val_household_types(spark, d):
    return V.val_household_types(B.units(spark, d), ["status = 2 and priority = 0", "price < 1000"])


@query("""select geocode, unnest(list_filter([case when not a1 and b1 then 'new_vacancy' end, case when a1 and not b1 then 'lost_vacancy' end, case when a2 and not b2 then 'new_occupied' end, case when not a2 and b2 then 'lost_occupied' end], lambda x: x is not null)) as move from (select geocode, bool_or(priority = 4 and status = 2) as a1, bool_and(priority = 4 and status = 2) as a2 from units group by all) join (select geocode, bool_or(p = 4 and status = 2) as b1, bool_and(p = 4 and status = 2) as b2 from (select *, case when unit_id % 7 = 0 then (priority + 1) % 5 else priority end as p from units) group by all) using (geocode)""")
def val_vacancy_moves(spark, d):
    u = B.units(spark, d)
    out = u.withColumn("priority", F.when(F.col("unit_id") % 7 == 0, (F.col("priority") + 1) % 5).otherwise(F.col("priority")))
    return V.val_vacancy_moves(u, out, "priority = 4 and status = 2")


_PU = "(select u.geocode, u.priority, u.units, coalesce(p.persons, 0) as persons from (select geocode, priority, count(*) as units from units group by all) u left join (select geocode, priority, count(*) as persons from persons where age > 40 group by all) p using (geocode, priority))"
_K = ["geocode", "priority"]


@query(f"select geocode, priority, units, persons from {_PU} where persons < units")
def val_person_per_gq(spark, d):
    return V.val_person_per_gq(B.persons(spark, d).filter("age > 40"), B.units(spark, d), _K)


@query("select geocode, priority, count(*) as persons from persons p where not exists (select 1 from units u where u.geocode = p.geocode and u.priority = p.priority and u.status = 0) group by all")
def val_gq_absent(spark, d):
    return V.val_gq_absent(B.persons(spark, d), B.units(spark, d).filter("status = 0"), _K)


@query(f"select geocode, priority, units, persons from {_PU} where persons > 2 * units")
def val_max_per_unit(spark, d):
    return V.val_max_per_unit(B.persons(spark, d).filter("age > 40"), B.units(spark, d), _K, 2)


@query(f"select geocode, priority, persons, units from {_PU} where persons < units")
def val_lower_bounds(spark, d):
    return V.val_lower_bounds(B.persons(spark, d).filter("age > 40"), B.units(spark, d), "geocode", "priority", [0, 1, 2, 3, 4])


@query(f"select geocode, priority, persons, units from {_PU} where persons > 2 * units")
def val_upper_bounds(spark, d):
    return V.val_upper_bounds(B.persons(spark, d).filter("age > 40"), B.units(spark, d), "geocode", "priority", [0, 1, 2, 3, 4], 2)


@query("select state, n_a, n_b, n_a = n_b as equal from (select substr(geocode, 1, 3) as state, count(*) as n_a, count(*) filter (unit_id % 97 <> 0) as n_b from units group by all)")
def val_state_totals(spark, d):
    u = B.units(spark, d)
    return V.val_state_totals(u, u.filter("unit_id % 97 <> 0"), 3)


@query(f"select 'totals' as \"check\", 0::bigint as violations union all select 'types', (select sum((n_a <> n_b)::int * 2 - (n_a <> n_b and (n_a = 0 or n_b = 0))::int)::bigint from ({_TC}))")
def val_sql_pairs(spark, d):
    g = "select geocode, priority, count(*) as n from {} group by geocode, priority"
    return V.val_sql_pairs(spark, {"totals": ("select count(*) from val_in", "select count(*) from val_out"), "types": (g.format("val_in"), g.format("val_out"))}, {"val_in": B.units(spark, d), "val_out": B.moved(spark, d)})


@query(f"select 'types' as \"check\", count(*) as violations, count(*) = 0 as passed from ({_TC}) where n_a <> n_b union all select 'reference', count(*), count(*) = 0 from units where geocode not in (select geocode from xwalk)")
def val_report(spark, d):
    u = B.units(spark, d)
    return V.val_report({"types": V.val_type_counts(u, B.moved(spark, d), _K), "reference": V.val_unit_reference(u, B.xwalk(spark, d))})
