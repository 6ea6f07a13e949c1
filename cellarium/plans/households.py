"""Queries of the largest household schema and of the rule sets of three schemas.

Orders stand for households and units: their dimensions are remainders of the order number, beside status and priority.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attributes as A
from ..functions import households as H
from ..functions import rules as R
from ..functions.dims import Schema
from ..operators import fit as T
from ..operators import hist, query as Q, recode
from . import base as B
from .base import query

_DIMS = {
    "sex": "unit_id % 2", "hhage": "unit_id % 9", "hispanic": "(unit_id div 2) % 2", "hhrace": "unit_id % 7", "elderly": "(unit_id div 3 + priority) % 4", "hhtenshort": "status % 2", "hhtype_dhch": "(unit_id * 5 + priority) % 522",
    "hhsize": "unit_id % 8", "hhtype": "(unit_id div 8 + priority) % 24", "multi": "(unit_id div 5) % 2", "tenvacgq": "(unit_id div 7 + status) % 35",
}


def _households(spark, d):
    return B.units(spark, d).select("unit_id", "geocode", *[F.expr(e).cast("int").alias(c) for c, e in _DIMS.items()])


# The types once more, as SQL over all combinations of what a household can be made of.
_TYPES = """types as (select (row_number() over (order by c, not alone, r, o, k, minor, multi, size) - 1)::int as hhtype_dhch, * from (
  select *, (size = 1) as alone from (values (0, 'married', 'opposite-sex'), (1, 'married', 'same-sex'), (2, 'cohabiting', 'opposite-sex'), (3, 'cohabiting', 'same-sex'), (4, '', '')) a(c, couple, sexes),
   (values (0, true), (1, false)) b(r, relatives), (values (0, 'under6'), (1, '6to17'), (2, 'both'), (3, '')) e(o, own), (values (0, 'under6'), (1, '6to17'), (2, 'both'), (3, '')) f(k, child),
   (values (false), (true)) g(minor), (values (false), (true)) h(multi), (select unnest(range(1, 8))::int as size))
  where case when alone then couple = '' and not relatives and own = '' and child = '' and not multi
   else (relatives or couple <> 'married' and own = '' and not multi) and (own = '' or child in (own, 'both')) and (child = '' or minor) and not (multi and couple = '' and minor and child = '')
    and size >= case when multi then 1 + (couple <> '')::int + case child when '' then 2 when 'both' then if(own in ('', 'both'), 3, 2) else 2 end
     else greatest(2, 1 + (couple <> '')::int + case child when '' then if(relatives and couple <> 'married', 1, 0) when 'both' then 2 else 1 end) end end)"""
_HOUSE = f"{_TYPES}, house as (select unit_id, geocode, {', '.join(f'({e.replace(" div ", " // ")})::int as {c}' for c, e in _DIMS.items())} from units), typed as (select * from house join types using (hhtype_dhch))"
_T = lambda body: f"select * from (with {_HOUSE} {body})"


@query(_T("""select geocode, case when couple = 'married' or own <> '' or relatives then 'Family' else 'none' end as family, case when couple <> 'married' or own = '' then 'none' when own = 'under6' then 'Married with children under 6 only'
 when own = '6to17' then 'Married with children 6 to 17 years only' else 'Married with children under 6 years and 6 to 17 years' end as married_children, (size = 2 and minor)::int as two_with_child, (alone and minor)::int as child_alone, count(*) as n from typed group by all"""))
def recode_household_type_largest(spark, d):
    groups = H.household_type_full().recodes
    flag = lambda name: list(groups[name].popitem()[1])
    df = recode.recode_household_type(_households(spark, d), "hhtype_dhch", {"family": groups["family"], "married_children": groups["married_with_children_levels"], "two_with_child": flag("type2_onechild"), "child_alone": flag("child_alone")}, "none")
    return df.groupBy("geocode", "family", "married_children", "two_with_child", "child_alone").agg(F.count(F.lit(1)).alias("n"))


_OUT = {
    "TEN": "if(hhtenshort = 0, '1', '3')", "HHSIZE": "size::varchar", "HHT": "case when couple = 'married' then '1' when relatives then (if(sex = 0, '2', '3')) when sex = 0 then if(alone, '4', '5') else if(alone, '6', '7') end",
    "HHT2": "case when couple = 'married' and own <> '' then '01' when couple = 'married' then '02' when couple <> '' and own <> '' then '03' when couple <> '' then '04' when sex = 1 and alone then '05' when sex = 1 and own <> '' then '06' when sex = 1 and relatives then '07' when sex = 1 then '08' when alone then '09' when own <> '' then '10' when relatives then '11' else '12' end",
    "CPLT": "case when size = 1 then '0' when couple = 'married' and sexes = 'opposite-sex' then '1' when couple = 'married' then '2' when couple <> '' and sexes = 'opposite-sex' then '3' when couple <> '' then '4' else '5' end",
    "UPART": "case when size = 1 then '0' when couple = 'cohabiting' and sexes = 'same-sex' then if(sex = 0, '1', '3') when couple = 'cohabiting' then if(sex = 0, '2', '4') else '5' end",
    "MULTG": "case when size < 3 then '0' when multi_1 then '2' else '1' end", "HHLDRAGE": "(hhage + 1)::varchar", "HHSPAN": "(hispanic + 1)::varchar", "HHRACE": "'0' || (hhrace + 1)", "PAOC": "case own when 'under6' then '1' when '6to17' then '2' when 'both' then '3' else '4' end",
    "P18": "minor::int::varchar", "P60": "(elderly > 0)::int::varchar", "P65": "(elderly > 1)::int::varchar", "P75": "(elderly > 2)::int::varchar", "PAC": "case child when 'under6' then '1' when '6to17' then '2' when 'both' then '3' else '4' end", "HHSEX": "(sex + 1)::varchar",
}


@query(_T("""select 'MUD' as "SCHEMA_TYPE_CODE", '1.1.0' as "SCHEMA_BUILD_ID", geocode, '2' as "RTYPE", '000' as "GQTYPE", '0' as "VACS", """ + ", ".join(f'{e} as "{c}"' for c, e in _OUT.items()) + ", count(*) as n from typed group by all"))
def recode_output_largest(spark, d):
    df = _households(spark, d).drop("multi", "hhsize", "hhtype", "tenvacgq")
    out = recode.recode_output_largest(df)
    return out.groupBy(*out.columns).agg(F.count(F.lit(1)).alias("n"))


@query(_T("""select geocode, if(tenvacgq <= 10, '2', '4') as "RTYPE", case when tenvacgq <= 10 then '000' else (['101', '102', '103', '104', '105', '106', '201', '202', '203', '301', '401', '402', '403', '404', '405', '501', '601', '602', '701', '801', '802', '900', '901', '997'])[tenvacgq - 10] end as "GQTYPE",
 '0' as "TEN", case when tenvacgq between 4 and 10 then (tenvacgq - 3)::varchar else '0' end as "VACS", '00' as "HHT2", '0' as "HHSIZE", count(*) as n from house where tenvacgq > 3 group by all"""))
def recode_output_largest_units(spark, d):
    """Units that hold no household: occupied ones are the households' rows."""
    out = recode.recode_output_unit(_households(spark, d).filter("tenvacgq > 3"), recode.LARGEST_UNIT_LAYOUT)
    keys = ["geocode", "RTYPE", "GQTYPE", "TEN", "VACS", "HHT2", "HHSIZE"]
    return out.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


_NAMES = ["family * hhover65", "sex * ownchild_under18 * presence60", "size1 * tenure_2lev", "other_with_children_levels", "notalone * hispanic"]
_AGE65 = "case when hhage < 6 then '15 to 64 years' else '65 years and over' end"
_P60 = "case when elderly = 0 then 'No one over 60' else 'At least one over 60' end"


@query(_T(f"""select geocode, query, level, sum(n)::bigint as cnt from (
 select geocode, 'family * hhover65' as query, {_AGE65} || ' BY Family' as level, count(*) as n from typed where couple = 'married' or own <> '' or relatives group by all
 union all select geocode, 'sex * ownchild_under18 * presence60', if(sex = 0, 'Male', 'Female') || ' BY ' || {_P60} || ' BY Householder has own child under 18', count(*) from typed where own <> '' group by all
 union all select geocode, 'size1 * tenure_2lev', if(hhtenshort = 0, 'Owned', 'Not owned') || ' BY 1-person household', count(*) from typed where size = 1 group by all
 union all select geocode, 'other_with_children_levels', case own when 'under6' then 'Other with children under 6 only' when '6to17' then 'Other with children 6 to 17 years only' else 'Other with children under 6 years and 6 to 17 years' end, count(*) from typed where couple <> 'married' and own <> '' group by all
 union all select geocode, 'notalone * hispanic', if(hispanic = 0, 'Not Hispanic or Latino', 'Hispanic or Latino') || ' BY Non-Family not alone', count(*) from typed where not alone and couple <> 'married' and own = '' and not relatives group by all) group by all"""))
def query_by_name_largest(spark, d):
    schema = H.largest()
    cells = hist.hist_sparse(_households(spark, d), "geocode", schema.names)
    return Q.query_answer_many(cells, _NAMES, schema, ["geocode"], ("cnt",)).select("geocode", "query", "level", "cnt")


# rule sets

_TERM = {
    "size1": "size = 1", "size2": "size = 2", "size3": "size = 3", "size4": "size = 4", "size2plus": "size > 1", "vacant": "size = 0", "age_under60": "hhage < 5", "age_60to64": "hhage = 5", "age_65to74": "hhage = 6", "age_75plus": "hhage >= 7", "age_60plus": "hhage >= 5",
    "hhover24": "hhage > 0", "age_15to24": "hhage = 0", "elderly3": "elderly = 3", "invert_elderly0": "elderly > 0", "invert_elderly1": "elderly <> 1", "invert_elderly2": "elderly <> 2", "invert_elderly3": "elderly < 3", "pres_under65": "elderly < 2", "pres_under60": "elderly = 0",
    "male": "sex = 0", "female": "sex = 1", "yes_multi": "multi = 1", "no_multi": "multi = 0",
}
_NEW = _TERM | {
    "ownchild_under6": "own in ('under6', 'both')", "ownchild_under18": "own <> ''", "child_alone": "alone and minor", "type2_onechild": "size = 2 and minor", "type2_onechildxhh": "size = 2 and child <> ''", "type2_couple": "size = 2 and couple <> ''",
    "type3_twochild": "size = 3 and own = 'both'", "type3_couple_with_child": "size = 3 and couple <> '' and own <> ''", "type4_couple_with_twochildren": "size = 4 and own = 'both' and couple <> ''",
}
#: The older types that a size or three generations rule out.
_IN = {
    "ownchild_under6": "0, 2, 4, 6, 8, 10, 13, 15, 19, 21", "ownchild_under18": "0, 1, 2, 4, 5, 6, 8, 9, 10, 13, 14, 15, 19, 20, 21", "alone": "18", "non2type": "0, 1, 2, 4, 5, 6, 8, 9, 10, 11, 13, 14, 15, 16, 18, 21", "type2_onechild": "19, 20", "type2_couple": "3, 7, 12, 17",
    "non3type": "2, 6, 10, 15, 18", "type3_notmulti": "0, 1, 3, 4, 5, 7, 8, 9, 11, 12, 13, 14, 16, 17, 21, 23", "type3_twochild": "21", "type3_couple_with_child": "0, 1, 4, 5, 8, 9, 13, 14", "type4_notmulti": "2, 6, 10, 12, 15, 17, 23", "type4_couple_with_twochildren": "2, 6, 10, 15", "never_multi": "12, 17, 18, 23",
}
_OLD = _TERM | {k: f"hhtype in ({v})" for k, v in _IN.items()} | {"invert_alone": "hhtype <> 18"}


def _level(schema: Schema, name: str) -> str:
    return " BY ".join(next(iter(groups)) for _, groups in schema.parse(name)).replace("'", "''")


def _zeros(rules, schema, term, table: str) -> str:
    """Structural zeros one by one."""
    each = [r for r in rules if r.rhs == 0 and len(r.terms) == 1]
    part = lambda r: f"select '{r.name}' as rule, geocode, '{_level(schema, r.terms['main'][0])}' as level, '=' as sign, count(*) as lhs, 0 as rhs from {table} where " + " and ".join(f"({term[t]})" for t in r.terms["main"][0].split(" * ")) + " group by geocode"
    return " union all ".join(map(part, each))


_VECT = "case when tenvacgq < 11 then 'Housing Units' else ([" + ", ".join(f"'{x.replace(chr(39), chr(39) * 2)}'" for x in A.GROUP_QUARTERS) + "])[tenvacgq - 10] end"
_MIXED = f"""select 'total' as rule, geocode, 'total' as level, 'le' as sign, count(*) as lhs, 3 * count(*) filter (tenvacgq < 11) as rhs from house group by all
 union all select 'tot_hh', geocode, 'total', '=', sum(k), 0 from (select geocode, 1 as k from house union all select geocode, -1 from house where tenvacgq < 4) group by geocode
 union all select 'owned', geocode, level, '=', sum(k), 0 from (select geocode, if(hhtenshort = 0, 'Owned', 'Not owned') as level, 1 as k from house union all select geocode, if(tenvacgq < 2, 'Owned', 'Not owned'), -1 from house where tenvacgq < 4) group by geocode, level
 union all select 'gq_vect', geocode, {_VECT} as level, '=', count(*), count(*) + if(geocode::bigint % 3 = 0, 1, 0) from house group by geocode, level"""
_OK = "case sign when '=' then lhs = rhs when 'le' then lhs <= rhs else lhs >= rhs end as ok"


def _ruled(spark, d, schema: Schema, rules):
    df = _households(spark, d)
    unit = hist.hist_sparse(df, "geocode", ["tenvacgq"])
    units = H.largest_units()
    vector = unit.withColumn("level", units.level("hhgq_vector")).groupBy("geocode", "level").agg((F.sum("cnt") + F.when(F.col("geocode").cast("long") % 3 == 0, 1).otherwise(0)).alias("value")).select("geocode", F.lit("gqhh_vect").alias("invariant"), "level", "value")
    housing = unit.groupBy("geocode").agg(F.sum(F.when(F.col("tenvacgq") < 11, 3 * F.col("cnt")).otherwise(0)).alias("value")).select("geocode", F.lit("tot_hu").alias("invariant"), F.lit("total").alias("level"), "value")
    return T.constraint_rules({"main": hist.hist_sparse(df, "geocode", schema.names), "unit": unit}, {"main": schema, "unit": units}, rules, vector.unionByName(housing))


@query(_T(f"select rule, geocode, level, sign, lhs::bigint as lhs, rhs::bigint as rhs, {_OK} from ({_zeros(R.LARGEST, H.largest(), _NEW, 'typed')} union all {_MIXED})"))
def constraint_rules_largest(spark, d):
    return _ruled(spark, d, H.largest(), R.LARGEST)


@query(_T(f"select rule, geocode, level, sign, lhs::bigint as lhs, rhs::bigint as rhs, {_OK} from ({_zeros(R.HOUSEHOLDS_2010, H.households_2010(), _OLD, '(select *, hhsize as size from house)')} union all {_MIXED})"))
def constraint_rules_2010(spark, d):
    return _ruled(spark, d, H.households_2010(), R.HOUSEHOLDS_2010)


_REL = Schema((A.relationship(), A.age()))
_PERSON = {"rel_parents": "rel in (6, 8)", "rel_children": "rel in (2, 3, 4, 9)", "rel_cantbekids": "rel in (0, 1, 6, 8, 9, 12, 13)", "age_lessthan15": "age < 15", "age_lessthan30": "age < 30", "age_greaterthan89": "age > 89"}
_GQ = "case when rel < 15 then 'Household' else ([" + ", ".join(f"'{x.replace(chr(39), chr(39) * 2)}'" for x in A.RELATIVE_FACILITIES) + "])[rel - 14] end"


@query(f"""select rule, geocode, level, sign, lhs::bigint as lhs, rhs::bigint as rhs, {_OK} from (with p as (select geocode, ((unit_id * 3 + l_linenumber) % 43)::int as rel, (unit_id % 100)::int as age from persons)
 select 'total' as rule, geocode, 'total' as level, '=' as sign, count(*) as lhs, count(*) + if(geocode::bigint % 5 = 0, 1, 0) as rhs from p group by geocode
 union all select 'hhgq_total_lb', geocode, {_GQ} as level, 'ge', count(*), 2 from p group by geocode, level union all select 'hhgq_total_ub', geocode, {_GQ} as level, 'le', count(*), 4 from p group by geocode, level
 union all {_zeros(R.PERSONS, _REL, _PERSON, 'p')})""")
def constraint_rules_persons(spark, d):
    df = B.persons(spark, d).select("geocode", ((F.col("unit_id") * 3 + F.col("l_linenumber")) % 43).cast("int").alias("rel"), (F.col("unit_id") % 100).cast("int").alias("age"))
    cells = hist.hist_sparse(df, "geocode", ["rel", "age"])
    total = cells.groupBy("geocode").agg((F.sum("cnt") + F.when(F.col("geocode").cast("long") % 5 == 0, 1).otherwise(0)).alias("value")).select("geocode", F.lit("tot").alias("invariant"), F.lit("total").alias("level"), "value")
    kinds = cells.select("geocode", _REL.level("gqlevels").alias("level")).distinct()
    bounds = kinds.select("geocode", F.explode(F.array(*[F.struct(F.lit(k).alias("invariant"), F.lit(v).cast("long").alias("value")) for k, v in (("gq_lower", 2), ("gq_upper", 4))])).alias("x"), "level").select("geocode", "x.invariant", "level", "x.value")
    return T.constraint_rules({"main": cells}, {"main": _REL}, R.PERSONS, total.unionByName(bounds))


_KIN = Schema((A.relationship_gq(), A.sex(), A.cenrace()))
_PEOPLE = {"relgq": "(unit_id * 5 + l_linenumber) % 42", "sex": "sex", "cenrace": "(unit_id + l_linenumber * 11) % 63"}
_CLASS = "case when relgq < 18 then 'HOUSEHOLD' when relgq < 24 then 'Correctional facilities for adults' when relgq < 27 then 'Juvenile facilities' when relgq = 27 then 'Nursing facilities/Skilled-nursing facilities' when relgq < 33 then 'Other institutional facilities' when relgq = 33 then 'College/University student housing' when relgq = 34 then 'Military quarters' else 'Other noninstitutional facilities' end"
_RACE = "case when cenrace < 6 then (['White', 'Black or African American', 'American Indian and Alaska Native', 'Asian', 'Native Hawaiian and Other Pacific Islander', 'Some Other Race'])[cenrace + 1] || ' alone' when cenrace = 6 then 'Black or African American and White' when cenrace = 7 then 'American Indian and Alaska Native and White' when cenrace = 8 then 'Asian and White' when cenrace = 11 then 'American Indian and Alaska Native and Black or African American' else 'Balance/remainder' end"


@query(f"""select geocode, query, level, count(*) as cnt from (with p as (select geocode, {', '.join(f"({e.replace(' div ', ' // ')})::int as {c}" for c, e in _PEOPLE.items())} from persons)
 select geocode, 'hhgq8lev' as query, {_CLASS} as level from p union all select geocode, 'spouses_unmarried_partners * sex', 'Spouses & Unmarried Partners BY ' || if(sex = 0, 'Male', 'Female') from p where relgq between 2 and 5
 union all select geocode, 'people_in_households', 'People in Households' from p where relgq < 18 union all select geocode, 'hhgq8lev * cenrace11cats', {_CLASS} || ' BY ' || {_RACE} from p
 union all select geocode, 'tomr', 'Two or more races' from p where cenrace > 5 union all select geocode, 'cenrace_7lev_two_comb', case when cenrace > 10 then 'Two or more races' when cenrace < 6 then (['white', 'black', 'aian', 'asian', 'nhopi', 'sor'])[cenrace + 1] else (['black', 'aian', 'asian', 'nhopi', 'sor'])[cenrace - 5] end from p) group by all""")
def query_by_name_facilities(spark, d):
    names = ["hhgq8lev", "spouses_unmarried_partners * sex", "people_in_households", "hhgq8lev * cenrace11cats", "tomr", "cenrace_7lev_two_comb"]
    cells = hist.hist_sparse(B.persons(spark, d).select("geocode", *[F.expr(e).cast("int").alias(c) for c, e in _PEOPLE.items()]), "geocode", _KIN.names)
    return Q.query_answer_many(cells, names, _KIN, ["geocode"], ("cnt",)).select("geocode", "query", "level", "cnt")
