"""Registered queries against DuckDB on the smallest tables, and what every plan must be free of."""

import glob
import math
import os
import re

import duckdb
import pytest

from cellarium.plans import accuracy, base, fitting, households, published, records, tabulation  # noqa: F401

SF = "/root/testdata/sf0.001"
#: One query of each kind of plan; the rest run in the driver's comparison at sf0.01.
NAMES = """scan_fixed_width run_path_metadata check_legal_values check_record_layout recode_input_person recode_race_combination recode_output_unit bin_counts bin_sql bin_power10 unflat_index geo_parent
geo_entity_distance geo_bypass_single_child geo_check_path_budget join_orig_priv join_ratio_denominator hist_dense hist_nested hist_arith hist_equal geo_rollup geo_rollup_any query_grouped_marginal query_answer_many
query_all_marginals query_combo query_sparse_matrix table_product table_full_workload sql_table_pipeline err_l1_relative metric_panel metric_panel_by metric_share_bins tvd_geounit geolevel_sparsity error_histogram
error_cdf total_pop_bins blau_quintile_errors table_cv variation_vs_average metric_groups quantile_group quantile_weighted_age category_age_quantiles check_sorted record_number set_subtract set_dedup budget_rollup
noise_geometric noise_discrete_gaussian noise_interval measure_pool constraint_rollup constraint_check topdown_consistent topdown_nonnegative topdown_round topdown_levels topdown_bounds_clip sink_measurements
expand_vacant_and_gq assign_detail_in_order val_type_counts val_vacancy_moves val_sql_pairs val_report scan_delimited scan_piped_protected scan_geo_reference scan_area_reference scan_runs recode_from_output
recode_output_person_relationship recode_output_household recode_output_citizen_race topdown_shortcuts topdown_queries constraint_legal_ages table_product_citizens relative_query_error relative_total_error val_person_total topdown_round_queries recode_household_type_largest recode_output_largest recode_output_largest_units
query_by_name_largest constraint_rules_2010 constraint_rules_persons noise_discrete_gaussian_exact query_by_name_facilities""".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


def text(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "null"
    return f"{v:.6f}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, duck, name):
    df = base.QUERIES[name](spark, SF)
    rel = duck.sql(base.SQL[name])
    cols = sorted(df.columns)
    assert cols == sorted(rel.columns)
    got = sorted(tuple(map(text, r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    at = [rel.columns.index(c) for c in cols]
    want = sorted(tuple(text(r[i]) for i in at) for r in rel.fetchall())
    assert got == want and got


def test_every_query_has_sql():
    assert set(base.QUERIES) == set(base.SQL)


@pytest.mark.parametrize("module", [tabulation, accuracy, fitting, households])
def test_no_python_and_no_cartesian_product_in_plans(spark, module):
    for name, f in base.QUERIES.items():
        if getattr(module, name, None) is None or name in ("top_failed", "topdown_round_queries", "topdown_levels_queries"):  # these fit a family in a task
            continue
        plan = f(spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("BatchEvalPython|ArrowEvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct", plan), name
