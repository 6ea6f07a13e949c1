"""Queries for accuracy metrics, quantiles, order and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import joins, metrics as M, quantiles as X
from ..sources.files import scratch
from . import base as B
from .base import query

# errors


@query("select *, abs(priv - orig) as \"L1\" from answers")
def err_l1(spark, d):
    return M.err_l1(B.answers(spark, d))


@query("select *, ((priv - orig) * (priv - orig))::double as \"L2\" from answers", '"L2"')
def err_l2(spark, d):
    return M.err_l2(B.answers(spark, d))


@query("select *, priv - orig as signed_error from answers")
def err_signed(spark, d):
    return M.err_signed(B.answers(spark, d))


_REL = """(select geolevel, geocode, run_id, query, priv, orig, case when priv = 0 and orig = 0 then 0.0 when priv > 0 and orig > 0 then abs(p::double / priv - o::double / orig) else 2.0 end as "L1Relative" from (
 select q.geolevel, q.geocode, q.run_id, q.query, t.priv, t.orig, q.priv as p, q.orig as o, row_number() over (partition by q.geolevel, q.geocode, q.run_id, q.query order by q.priv desc, q.level) as k
 from answers q join answers t on q.geolevel = t.geolevel and q.geocode = t.geocode and q.run_id = t.run_id and t.query = 'total' where q.query <> 'total') where k = 1)"""
_RELK = ("geolevel", "geocode", "run_id")


@query(f"select * from {_REL}", '"L1Relative"')
def err_l1_relative(spark, d):
    return M.err_l1_relative(B.answers(spark, d), keys=_RELK)


# panels

_D, _A = "(priv - orig)", "abs(priv - orig)"
_P = {
    "MAE": f"sum({_A})::double / count(*)", "RMS": f"sqrt(sum({_D} * {_D})::double / count(*))", "CoV": f"100 * sqrt(sum({_D} * {_D})::double / count(*)) / nullif(avg(orig), 0)", "MAPE": f"100 * coalesce(sum({_A}::double / nullif(orig, 0)), 0) / count(*)",
    "MALPE": f"100 * coalesce(sum({_D}::double / nullif(orig, 0)), 0) / count(*)", "CountMAPE10": f"(count(*) filter ({_A}::double / nullif(orig, 0) > 0.1))::double", "Counts": "count(*)::double",
}
_PANEL = lambda by, src="answers": " union all ".join(f"select {by}{', ' if by else ''}'{k}' as metric, {e} as value from {src}{' group by all' if by else ''}" for k, e in _P.items())

for _k, _n, _f in (("metric_mae", "MAE", M.metric_mae), ("metric_rmse", "RMS", M.metric_rmse), ("metric_cov", "CoV", M.metric_cov), ("metric_mape", "MAPE", M.metric_mape), ("metric_malpe", "MALPE", M.metric_malpe), ("metric_pct_over10", "CountMAPE10", M.metric_pct_over10)):
    query(f'select {_P[_n]} as "{_n}" from answers', f'"{_n}"', _k)(lambda spark, d, f=_f: f(B.answers(spark, d)))


@query(_PANEL(""), "value")
def metric_panel(spark, d):
    return M.metric_panel(B.answers(spark, d))


@query(_PANEL("geolevel, query"), "value")
def metric_panel_by(spark, d):
    return M.metric_panel_by(B.answers(spark, d), ["geolevel", "query"])


@query("select share_bin, metric, value from (" + _PANEL("share_bin", "(select q.orig, q.priv, case when t.orig = 0 then 'undefined' when q.orig::double / t.orig < 0.1 then '< 0.1' when q.orig::double / t.orig < 0.5 then '[0.1, 0.5)' else '>= 0.5' end as share_bin from answers q join answers t on q.geolevel = t.geolevel and q.geocode = t.geocode and q.run_id = t.run_id and t.query = 'total' where q.query = 'status' and q.level = 'Pending')") + ")", "value")
def metric_share_bins(spark, d):
    a = B.answers(spark, d)
    return M.metric_share_bins(a.filter("query = 'total'"), a.filter("query = 'status' and level = 'Pending'"), [0.1, 0.5], ["geolevel", "geocode", "run_id"])


# total variation and sparsity


@query("select geolevel, geocode, run_id, sum(1 - abs(priv - orig)::double / nullif(2 * orig, 0)) as one_minus_tvd from rolled group by all", "one_minus_tvd")
def tvd_geounit(spark, d):
    return M.tvd_geounit(B.rolled(spark, d), ["geolevel", "geocode", "run_id"])


@query('select geolevel, run_id, sum(abs(priv - orig))::bigint as "L1", sum(orig)::bigint as orig, 1 - sum(abs(priv - orig))::double / nullif(2 * sum(orig), 0) as one_minus_tvd from rolled group by all', "one_minus_tvd")
def tvd_geolevel(spark, d):
    return M.tvd_geolevel(B.rolled(spark, d), ["geolevel", "run_id"])


@query("select query, geolevel, 1 - sum(abs(priv - orig))::double / (2 * max(pop)) as one_minus_tvd from answers join (select geolevel, sum(orig) as pop from answers where query = 'total' group by all) using (geolevel) where query <> 'total' group by all", "one_minus_tvd")
def tvd_query_level(spark, d):
    return M.tvd_query_level(B.answers(spark, d))


_NZ = "select geolevel, geocode, run_id, count(*) filter (orig > 0) as orig_nonzero, count(*) filter (priv > 0) as priv_nonzero from rolled group by all"
_G3 = ["geolevel", "geocode", "run_id"]


@query(_NZ)
def nonzero_cells(spark, d):
    return M.nonzero_cells(B.rolled(spark, d), _G3)


@query(f"select *, orig_nonzero / 15.0::double as orig_celldensity, priv_nonzero / 15.0::double as priv_celldensity from ({_NZ})", "orig_celldensity priv_celldensity")
def cell_density(spark, d):
    return M.cell_density(B.rolled(spark, d), _G3, 15)


@query(f"select *, 1 - orig_nonzero / 15.0::double as orig_cellsparsity, 1 - priv_nonzero / 15.0::double as priv_cellsparsity from ({_NZ})", "orig_cellsparsity priv_cellsparsity")
def cell_sparsity(spark, d):
    return M.cell_sparsity(B.rolled(spark, d), _G3, 15)


@query('select *, abs(priv_sparsity - orig_sparsity) as "L1" from (select geolevel, run_id, 1 - (count(*) filter (orig > 0))::double / (count(distinct geocode) * 15) as orig_sparsity, 1 - (count(*) filter (priv > 0))::double / (count(distinct geocode) * 15) as priv_sparsity from rolled group by all)', 'orig_sparsity priv_sparsity "L1"')
def geolevel_sparsity(spark, d):
    return M.geolevel_sparsity(B.rolled(spark, d), ["geolevel", "run_id"], 15)


@query(f"select geolevel, geocode, run_id, (orig_nonzero - priv_nonzero) / 15.0::double as change from ({_NZ})", "change")
def sparsity_change(spark, d):
    return M.sparsity_change(B.rolled(spark, d), _G3, 15)


# by level

_U = "(select geolevel, geocode, sum(abs(priv - orig)) as s, max(abs(priv - orig)) as m, sum(orig) as o, sum(priv) as p, max(orig) as mo, max(priv) as mp from rolled group by all)"


@query(f"select geolevel, sum(s)::bigint as l1_sum from {_U} group by all")
def l1_sum_level(spark, d):
    return M.l1_sum_level(B.rolled(spark, d))


@query(f"select geolevel, sum(m)::bigint as l1_max_sum from {_U} group by all")
def l1_max_level(spark, d):
    return M.l1_max_level(B.rolled(spark, d))


@query("select geolevel, max(abs(priv - orig)) as l1_max from rolled group by all")
def l1_maxmax_level(spark, d):
    return M.l1_maxmax_level(B.rolled(spark, d))


@query(f"select geolevel, count(*) filter (mo = 0) as zero_orig, count(*) filter (mp = 0) as zero_priv, count(*) filter (mo = 0 and mp = 0) as zero_both from {_U} group by all")
def zero_geounits(spark, d):
    return M.zero_geounits(B.rolled(spark, d))


@query(f"select geolevel, sum(p - o)::bigint as signed_sum, sum(abs(p - o))::bigint as abs_sum, sum(sign(p - o))::bigint as sign_sum from {_U} group by all")
def total_change(spark, d):
    return M.total_change(B.rolled(spark, d))


@query("select geolevel, query, sum(s)::bigint as l1_sum, sum(m)::bigint as l1_max_sum from (select geolevel, query, geocode, sum(abs(priv - orig)) as s, max(abs(priv - orig)) as m from answers group by all) group by all")
def query_l1_level(spark, d):
    return M.query_l1_level(B.answers(spark, d))


# distributions

_HIST = lambda keys, src: f"select {keys}, case when edge = max(edge) over (partition by {keys}) then most else edge end as upper_edge, n from (select {keys}, ((e // greatest(1, most // 20)) + 1) * greatest(1, most // 20) as edge, count(*) as n, max(most) as most from (select *, max(e) over (partition by {keys}) as most from (select *, abs(priv - orig) as e from {src})) group by all)"


@query(_HIST("geolevel, query", "answers"))
def error_histogram(spark, d):
    return M.error_histogram(B.answers(spark, d), ["geolevel", "query"])


@query(_HIST("geolevel, pop_bin", "(select *, case when orig < 1 then 0 else pow(10, length(orig::varchar) - 1) end::bigint as pop_bin from answers)"))
def error_histogram_by_pop(spark, d):
    return M.error_histogram_by_pop(B.answers(spark, d), ["geolevel"])


@query("select geolevel, query, count(*) filter (e = 0) as zeros, count(*) filter (e <> 0) as nonzeros, quantile_disc(e, 0.5) filter (e <> 0) as q50, quantile_disc(e, 0.9) filter (e <> 0) as q90 from (select *, abs(priv - orig) as e from answers) group by all")
def error_quantiles_nonzero(spark, d):
    return M.error_quantiles_nonzero(B.answers(spark, d), ["geolevel", "query"], [0.5, 0.9])


@query("select geolevel, query, error, sum(n) over (partition by geolevel, query order by error)::double / sum(n) over (partition by geolevel, query) as cdf from (select geolevel, query, abs(priv - orig) as error, count(*) as n from answers group by all)", "cdf")
def error_cdf(spark, d):
    return M.error_cdf(B.answers(spark, d), ["geolevel", "query"])


_QS = ", ".join(f"quantile_cont(e, {p}) as q{round(100 * p)}" for p in M.QUANTILES)


@query(f"select geolevel, bin, count(*) as n, avg(e) as mean_l1, avg(100 * e / nullif(orig, 0)) as mean_pct, {_QS} from (select geolevel, abs(priv - orig)::double as e, orig, unnest(list_filter([case when orig > 0 and orig <= 10 then '(0, 10]' end, case when orig > 10 and orig <= 100 then '(10, 100]' end, case when orig > 0 then '(0, inf]' end], lambda x: x is not null)) as bin from answers where query = 'total') group by all", "mean_l1 mean_pct " + " ".join(f"q{round(100 * p)}" for p in M.QUANTILES))
def total_pop_bins(spark, d):
    return M.total_pop_bins(B.answers(spark, d).filter("query = 'total'"), [(0, 10), (10, 100), (0, None)], ["geolevel"])


@query("select bin, avg(abs(priv - orig)) as mean_l1, count(*) as n from (select *, (orig >= 0)::int + (orig >= 5)::int + (orig >= 50)::int as bin from answers) group by rollup (bin)", "mean_l1")
def l1_by_pop_bin(spark, d):
    return M.l1_by_pop_bin(B.answers(spark, d), [0, 5, 50])


@query("select geolevel, bin, avg(e) as mean, avg((e <= 0.05)::int) as share_within, quantile_cont(e, 0.5) as median from (select geolevel, (orig >= 0)::int + (orig >= 5)::int + (orig >= 50)::int as bin, abs(priv - orig)::double / greatest(1, orig) as e from answers where query = 'total') group by grouping sets ((geolevel, bin), (geolevel))", "mean share_within median")
def relative_total_error(spark, d):
    return M.relative_total_error(B.answers(spark, d).filter("query = 'total'"), [0, 5, 50])


@query(f'select geolevel, query, avg((r <= 0.05)::int) as share_within, avg(r) as mean, quantile_cont(r, 0.5) as median, count(*) as n_all, count(r) as n_defined from (select *, nullif("L1Relative", 2.0) as r from {_REL} where orig >= 2) group by all', "share_within mean median")
def relative_query_error(spark, d):
    return M.relative_query_error(M.err_l1_relative(B.answers(spark, d), keys=_RELK), ["geolevel", "query"], cutoff=2)


@query("select avg(abs(priv - orig)) as mae, avg((abs(priv - orig) <= 5)::int) as share_within from answers where query = 'total' and geolevel = 'Nation'", "mae share_within")
def county_goal(spark, d):
    return M.county_goal(B.answers(spark, d).filter("query = 'total' and geolevel = 'Nation'"), 5)


@query('select geocode, abs(priv - orig) as "L1" from answers where query = \'total\' and geolevel = \'Nation\'')
def area_state_total_l1(spark, d):
    return M.area_state_total_l1(B.answers(spark, d).filter("query = 'total'"), "Nation")


# diversity

_BLAU = "(select geolevel, geocode, run_id, 1 - sum(n * n)::double / nullif(sum(n) * sum(n), 0) as blau from (select geolevel, geocode, run_id, priority, sum(orig) as n from rolled group by all) group by all)"


@query(f"select * from {_BLAU}", "blau")
def blau_index(spark, d):
    return M.blau_index(B.rolled(spark, d), _G3, ["priority"])


@query(f"""select quintile, count(*) as n, avg(priv - orig) as mean_signed, avg(abs(priv - orig)) as mean_abs from (select b.*, t.orig, t.priv, ((blau > e1)::int + (blau > e2)::int + (blau > e3)::int + (blau > e4)::int + 1)::int as quintile
 from {_BLAU} b join (select geolevel, geocode, run_id, orig, priv from answers where query = 'total') t using (geolevel, geocode, run_id),
 (select quantile_cont(blau, 0.2) as e1, quantile_cont(blau, 0.4) as e2, quantile_cont(blau, 0.6) as e3, quantile_cont(blau, 0.8) as e4 from {_BLAU} where blau is not null) where blau is not null) group by all""", "mean_signed mean_abs")
def blau_quintile_errors(spark, d):
    return M.blau_quintile_errors(B.rolled(spark, d), _G3, ["priority"])


@query("select category, size, avg(abs(priv - orig)) as mae, count(*) as n from (select *, case when orig < 10 then '0-9' when orig < 100 then '10-99' else '100+' end as size from (select geolevel, geocode, run_id, case when status = 2 then 'P' else 'N' || priority end as category, sum(orig) as orig, sum(priv) as priv from rolled group by all)) group by grouping sets ((category, size), (category))", "mae")
def race8_errors(spark, d):
    return M.race8_errors(B.rolled(spark, d), F.when(F.col("status") == 2, "P").otherwise(F.concat(F.lit("N"), F.col("priority"))), _G3)


# runs

_BIN = "case when orig < 1 then '[0-1)' when orig < 10 then '[1-10)' when orig < 100 then '[10-100)' else '100 +' end as orig_count_bin"


@query(f"select geolevel, geocode, query, level, {_BIN}, avg(priv - orig) as signed_error, avg((priv - orig)::double / greatest(1, orig)) as re from answers group by all", "signed_error re")
def avg_signed_error_bins(spark, d):
    return M.avg_signed_error_bins(B.answers(spark, d), [0, 1, 10, 100], ["geolevel", "geocode", "query", "level"])


@query(f"select geolevel, query, {_BIN}, avg(abs(priv - orig)) as abs_error, avg(abs(priv - orig)::double / greatest(1, orig)) as re from answers group by all", "abs_error re")
def avg_abs_error_bins(spark, d):
    return M.avg_abs_error_bins(B.answers(spark, d), [0, 1, 10, 100], ["geolevel", "query"])


@query("select geolevel, geocode, query, level, (3 * sum(priv * priv) - sum(priv) * sum(priv))::double / 6 as sample_variance_priv from answers group by all", "sample_variance_priv")
def sample_variance_n(spark, d):
    return M.sample_variance_n(B.answers(spark, d), "priv", 3, ["geolevel", "geocode", "query", "level"])


@query("select geolevel, geocode, query, level, stddev_samp(priv) as sd, greatest(1, max(priv) filter (run_id = 'run_0')) as base, stddev_samp(priv) / greatest(1, max(priv) filter (run_id = 'run_0')) as cv from answers group by all", "sd cv")
def table_cv(spark, d):
    return M.table_cv(B.answers(spark, d), ["geolevel", "geocode", "query", "level"], "run_0")


@query("select q.geocode, q.geolevel, q.level, avg(q.orig::double / nullif(t.orig, 0)) as orig_share, avg(q.priv::double / nullif(t.priv, 0)) as priv_share from answers q join answers t on q.geolevel = t.geolevel and q.geocode = t.geocode and q.run_id = t.run_id and t.query = 'total' where q.query = 'status' group by all", "orig_share priv_share")
def voting_race_share(spark, d):
    a = B.answers(spark, d)
    return M.voting_race_share(joins.join_race_to_total(a.filter("query = 'status'"), a.filter("query = 'total'")), ["geocode", "geolevel", "level"])


@query("select geocode, geolevel, level, avg(orig) as avg_orig, avg(priv) as avg_priv from answers where query = 'status' group by all", "avg_orig avg_priv")
def avg_pop_runs(spark, d):
    return M.avg_pop_runs(B.answers(spark, d).filter("query = 'status'"), ["geocode", "geolevel", "level"])


@query("select geocode, geolevel, round(avg(sqrt(greatest(v, 0)) / nullif(a, 0)), 4) as relative_variation from (select geocode, geolevel, level, (3 * sum(priv * priv) - sum(priv) * sum(priv))::double / 6 as v, avg(priv) as a from answers where query = 'status' group by all) group by all", "relative_variation")
def variation_vs_average(spark, d):
    return M.variation_vs_average(B.answers(spark, d).filter("query = 'status'"), ["geocode", "geolevel", "level"], 3)


@query("select geocode, geolevel, round(avg(sqrt(v) / nullif(orig, 0)), 4) as relative_variation from (select geocode, geolevel, level, orig, round(sum((priv - orig) * (priv - orig) / 3.0::double), 4) as v from answers where query = 'status' group by all) group by all", "relative_variation")
def variation_vs_true(spark, d):
    return M.variation_vs_true(B.answers(spark, d).filter("query = 'status'"), ["geocode", "geolevel", "level"], 3)


@query("select geocode, geolevel, run_id, orig, priv, area, orig / area as density_orig, priv / area as density_priv, priv / area - orig / area as diff_density, abs(priv / area - orig / area) as l1_density from answers join (select geocode, sum(abs(c_acctbal)) as area from customers group by all) using (geocode) where query = 'total' and geolevel = 'Block'", "area density_orig density_priv diff_density l1_density")
def population_density(spark, d):
    area = B.customers(spark, d).groupBy("geocode").agg(F.sum(F.abs("c_acctbal")).alias("area")).withColumn("geolevel", F.lit("Block"))
    pop = B.answers(spark, d).filter("query = 'total'").select("geocode", "geolevel", "run_id", "orig", "priv")
    return M.population_density(pop, area)


@query("""with u2 as (select geolevel, geocode, sum(abs(priv - orig))::double as l1, max(abs(priv - orig))::double as linf, sum(orig) as o from rolled group by all)
select 'a' as metric_group, geolevel, 'L1' as metric, 'sum' as statistic, sum(l1) as value from u2 where geolevel <> 'Block' group by all
union all select 'b', geolevel, 'tvd', 'avg', avg(l1 / nullif(2 * o, 0)) from u2 where geolevel = 'Block' group by all
union all select 'c', geolevel, 'LInf', 'q' || p, case p when 0 then quantile_cont(linf, 0) when 25 then quantile_cont(linf, 0.25) when 50 then quantile_cont(linf, 0.5) when 75 then quantile_cont(linf, 0.75) else quantile_cont(linf, 1) end from u2, (select unnest([0, 25, 50, 75, 100]) as p) where geolevel = 'Nation' group by geolevel, p""".replace("with u2 as (", "select * from (with u2 as (") + ")", "value")
def metric_groups(spark, d):
    return M.metric_groups(B.rolled(spark, d), {"a": (["Region", "Nation"], ["L1"], "sum"), "b": (["Block"], ["tvd"], "avg"), "c": (["Nation"], ["LInf"], "quantiles")})


# quantiles, order, sets


@query("select geolevel, query, q as quantile, case q when 0.1 then o1 when 0.5 then o5 else o9 end as orig, case q when 0.1 then p1 when 0.5 then p5 else p9 end as priv from (select geolevel, query, quantile_cont(orig, 0.1) as o1, quantile_cont(orig, 0.5) as o5, quantile_cont(orig, 0.9) as o9, quantile_cont(priv, 0.1) as p1, quantile_cont(priv, 0.5) as p5, quantile_cont(priv, 0.9) as p9 from answers group by all), (select unnest([0.1, 0.5, 0.9])::double as q)", "quantile orig priv")
def quantile_group(spark, d):
    return X.quantile_group(B.answers(spark, d), ["orig", "priv"], ["geolevel", "query"], [0.1, 0.5, 0.9])


@query("select 0.25::double as quantile, quantile_disc(priv, 0.25) as priv from answers union all select 0.5, quantile_disc(priv, 0.5) from answers union all select 0.95, quantile_disc(priv, 0.95) from answers", "quantile")
def quantile_approx(spark, d):
    return X.quantile_approx(B.answers(spark, d), "priv", [0.25, 0.5, 0.95])


_AGED = "(select *, orig + age % 3 as priv from (select geocode, sex, age, count(*) as orig from persons group by all))"


def _aged(spark, d):
    from ..operators import hist

    h = hist.hist_sparse(B.persons(spark, d), "geocode", ["sex", "age"]).withColumnRenamed("cnt", "orig")
    return h.withColumn("priv", F.col("orig") + F.col("age") % 3)


@query(f"select geocode as nation, q as quantile, case q when 0.25 then o1 else o2 end as orig, case q when 0.25 then p1 else p2 end as priv from (select geocode, max(o1) as o1, max(o2) as o2, max(p1) as p1, max(p2) as p2 from (select geocode, quantile_cont(age, 0.25) as o1, quantile_cont(age, 0.5) as o2, null as p1, null as p2 from (select substr(geocode, 1, 3) as geocode, age, unnest(range(orig)) from {_AGED}) group by all union all select geocode, null, null, quantile_cont(age, 0.25), quantile_cont(age, 0.5) from (select substr(geocode, 1, 3) as geocode, age, unnest(range(priv)) from {_AGED}) group by all) group by all), (select unnest([0.25, 0.5])::double as q)", "quantile orig priv")
def quantile_weighted_age(spark, d):
    return X.quantile_weighted_age(_aged(spark, d).withColumn("nation", F.substring("geocode", 1, 3)), ["nation"], "age", [0.25, 0.5])


@query(f"""with t as (select sex, geocode, sum(orig) > 0 and sum(priv) > 0 as valid from {_AGED} group by all),
o as (select sex, geocode, quantile_cont(age, 0.5) as q from (select sex, geocode, age, unnest(range(orig)) from {_AGED}) group by all), p as (select sex, geocode, quantile_cont(age, 0.5) as q from (select sex, geocode, age, unnest(range(priv)) from {_AGED}) group by all)
select sex, 'Block' as geolevel, '1.0' as plb, 0.5::double as quantile, avg(abs(p.q - o.q)) as mean_l1, (select avg(valid::int) from t where t.sex = o.sex) as survival from o join p using (sex, geocode) group by sex""".replace("with t as", "select * from (with t as") + ")", "quantile mean_l1 survival")
def category_age_quantiles(spark, d):
    df = _aged(spark, d).withColumns({"geolevel": F.lit("Block"), "plb": F.lit("1.0"), "run_id": F.lit("run_0")})
    return X.category_age_quantiles(df, "sex", [0.5])


@query("select count(*) filter (o_custkey < b) as violations from (select o_custkey, lag(o_custkey) over (order by o_orderkey) as b from orders)")
def check_sorted(spark, d):
    path = scratch(spark)
    B.table(spark, d, "orders").orderBy("o_orderkey").write.parquet(path)
    return X.check_sorted(spark, path, ["o_custkey"])


@query("select unit_id, row_number() over (order by price, unit_id) as record_number from units")
def record_number(spark, d):
    return X.record_number(B.units(spark, d), ["price", "unit_id"]).select("unit_id", "record_number")


@query("select unit_id, count(*) over () as failures from units where price > 150000 order by unit_id limit 5")
def top_failed(spark, d):
    return X.top_failed(B.units(spark, d), "price > 150000", 5, ["unit_id"]).select("unit_id", "failures")


@query("select geocode, status, null::int as priority from hist union all select geocode, null, priority from hist")
def set_union_by_name(spark, d):
    h = B.hist(spark, d)
    return X.set_union_by_name([h.select("geocode", "status"), h.select("geocode", "priority")])


@query("select geocode, priority from units except select geocode, priority from moved where geocode like '1%'")
def set_subtract(spark, d):
    return X.set_subtract(B.units(spark, d).select("geocode", "priority"), B.moved(spark, d).filter("geocode like '1%'").select("geocode", "priority"))


@query("select distinct geocode, segment from customers")
def set_distinct(spark, d):
    return X.set_distinct(B.customers(spark, d).select("geocode", "segment"))


@query("select geocode, unit_id, priority from units qualify row_number() over (partition by geocode order by unit_id) = 1")
def set_dedup(spark, d):
    return X.set_dedup(B.units(spark, d).select("geocode", "unit_id", "priority"), ["geocode"], ["unit_id"])
