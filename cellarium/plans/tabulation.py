"""Queries for scans, filters, recodes, geography, joins and tabulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import attributes as A
from ..functions import dims as D
from ..operators import filters, geo, hist, joins, query as Q, recode
from ..sources import files
from . import base as B
from .base import HIER, KEYS, NAMES, PR, PS, SCHEMA, ST, query

SUM = B.SUM

# scans: the tables' own rows, written as files and read back by the scans


def _written(df, form, **options):
    path = files.scratch(df.sparkSession)
    df.write.options(**options).format(form).save(path)
    return path


def _places(spark, d):
    """Customers as a reference file: the geocode in its five parts."""
    c = B.customers(spark, d)
    parts = {"TABBLKST": F.col("region"), "TABBLKCOU": F.col("nation"), "TABTRACTCE": F.substring("bucket", 1, 1), "TABBLKGRPCE": F.substring("bucket", 2, 1), "TABBLK": F.lit("9"), "OIDTABBLK": F.col("c_custkey").cast("string")}
    area = F.abs("c_acctbal").cast("long").cast("string")
    return c.select(*[v.alias(k) for k, v in parts.items()], area.alias("AREALAND"), area.alias("AREAWATER"))


@query("select geocode, count(*) as n, sum(price)::double as price from units group by all", "price")
def scan_delimited(spark, d):
    path = _written(B.units(spark, d).select("geocode", "unit_id", "price"), "csv", sep="|", header=True)
    got = files.scan_delimited(spark, path, "geocode string, unit_id long, price double", "|", True)
    return got.groupBy("geocode").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("price"))


@query("select unit_id, geocode, status from units where status <> 2")
def scan_fixed_width(spark, d):
    lines = B.units(spark, d).select(F.concat(F.lit("U"), F.lpad(F.col("unit_id").cast("string"), 12, " "), "geocode", F.col("status").cast("string")).alias("value"))
    return files.scan_fixed_width(spark, _written(lines, "text"), [("unit_id", 1, 12, "bigint"), ("geocode", 13, 5, "string"), ("status", 18, 1, "int")], ~F.col("value").endswith("2"))


@query("select geocode, status::varchar as status, count(*) as n from units group by all")
def scan_piped_protected(spark, d):
    """Every file has its header and comment lines among the rows."""
    u = B.units(spark, d).select(F.when(F.col("unit_id") % 5 == 0, F.concat(F.lit("#"), "geocode")).otherwise(F.col("geocode")).alias("geocode"), "status")
    u = u.unionByName(B.units(spark, d).filter("unit_id % 5 = 0").select("geocode", "status"))
    return files.scan_piped_protected(spark, _written(u, "csv", sep="|", header=True, comment="~")).groupBy("geocode", "status").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct c_custkey::varchar as \"OIDTABBLK\", geocode || '9' as geocode from customers")
def scan_geo_reference(spark, d):
    places = _places(spark, d).drop("AREALAND", "AREAWATER")
    return files.scan_geo_reference(spark, _written(places.unionByName(places), "csv", sep="|", header=True))


@query("select geocode || '9' as geocode, sum(trunc(abs(c_acctbal))::bigint / 2589988.0) as land, sum(2 * trunc(abs(c_acctbal))::bigint / 2589988.0) as area from customers group by all", "land area")
def scan_area_reference(spark, d):
    got = files.scan_area_reference(spark, _written(_places(spark, d).drop("OIDTABBLK"), "csv", sep="|", header=True))
    return got.groupBy("geocode").agg(F.sum("land").alias("land"), F.sum("area").alias("area"))


@query("select geocode, status, run_id, plb, count(*) as n from (select geocode, status, 'run_0' as run_id, 1.0::double as plb from units union all select geocode, status, 'run_1', 2.0::double from moved) group by all", "plb")
def scan_runs(spark, d):
    runs = {_written(df.select("geocode", "status"), "parquet"): {"run_id": r, "plb": p, "budget_group": None} for df, r, p in ((B.units(spark, d), "run_0", 1.0), (B.moved(spark, d), "run_1", 2.0))}
    return files.scan_runs(spark, runs).groupBy("geocode", "status", "run_id", "plb").agg(F.count(F.lit(1)).alias("n"))


@query("select unit_id, (unit_id % 50)::double / 1000 as plb, 'run_' || (unit_id % 25) as run_id, 'td00' || (unit_id % 3) as budget_group from units", "plb")
def run_path_metadata(spark, d):
    u = B.units(spark, d).select("unit_id", F.concat(F.lit("s3://x/td00"), F.col("unit_id") % 3, F.lit("/data-run"), F.col("unit_id") % 25, F.lit(".0-epsilon"), F.col("unit_id") % 50, F.lit("E-3/part-0")).alias("path"))
    return files.run_path_metadata(u, F.col("path")).select("unit_id", "plb", "run_id", "budget_group")


@query("select geocode, 'run_7' as run_id, count(*) as n from units group by all")
def add_run_metadata(spark, d):
    return files.add_run_metadata(B.units(spark, d).groupBy("geocode").agg(F.count(F.lit(1)).alias("n")), {"run_id": "run_7", "plb": None})


# filters


@query("select unit_id, geocode from units where geocode like '10%'")
def filter_test_area(spark, d):
    return filters.filter_test_area(B.units(spark, d), ["region", "nation", "bucket"], "10").select("unit_id", "geocode")


@query("select unit_id, 'Closed' as status from units where status = 0")
def filter_drop_unmapped(spark, d):
    return filters.filter_drop_unmapped(recode.recode_case(B.units(spark, d), "status", {0: "Closed"}), ["status"]).select("unit_id", "status")


@query("select 'Segment' as geolevel, segment as geocode, sum(orig)::bigint as orig, sum(priv)::bigint as priv from analysis join xwalk using (geocode) where segment <> '99999' group by all")
def geo_drop_not_in_area(spark, d):
    df = hist.geo_rollup_any(joins.join_crosswalk(B.analysis(spark, d), B.xwalk(spark, d), ["segment"]), [], ["segment"], [])
    return filters.geo_drop_not_in_area(df.withColumn("geolevel", F.lit("Segment")), {"SEGMENT": "99999"})


@query("select * from answers where not regexp_matches(level, '^Not|^Open')")
def filter_level_regex(spark, d):
    return filters.filter_level_regex(B.answers(spark, d), "^Not|^Open")


@query("select a.* from analysis a where (geocode, run_id, plb) in (select (geocode, run_id, plb) from analysis group by geocode, run_id, plb having sum(orig) > 0 and sum(priv) > 0)")
def filter_valid_geounit_trials(spark, d):
    return filters.filter_valid_geounit_trials(B.analysis(spark, d), ["geocode", "run_id", "plb"])


@query("select * from answers where orig >= 20")
def filter_population_cutoff(spark, d):
    return filters.filter_population_cutoff(B.answers(spark, d), 20)


@query("select geocode, status, priority, priv::double / orig as r from analysis where priv::double / orig <> 2.0", "r")
def filter_undefined_ratio(spark, d):
    return filters.filter_undefined_ratio(B.analysis(spark, d).select("geocode", "status", "priority", (F.col("priv") / F.col("orig")).alias("r")), "r")


@query("select geocode, substr(geocode, 1, 3) as parent_geocode, status, priority, cnt from hist h where exists (select 1 from hist p where substr(p.geocode, 1, 3) = substr(h.geocode, 1, 3) and p.status = h.status and p.priority = h.priority and p.cnt > 3)")
def filter_parent_nonzero(spark, d):
    h = B.hist(spark, d)
    parent = h.filter("cnt > 3").groupBy(F.substring("geocode", 1, 3).alias("geocode"), "status", "priority").agg(F.sum("cnt").alias("cnt"))
    return filters.filter_parent_nonzero(h.withColumn("parent_geocode", F.substring("geocode", 1, 3)), parent, ["status", "priority"]).select("geocode", "parent_geocode", "status", "priority", "cnt")


@query("select unit_id, 'status' as \"column\", status::varchar as value from units where status not in (0, 1) union all select unit_id, 'priority', priority::varchar from units where not (priority between 0 and 2 or priority = 4)")
def check_legal_values(spark, d):
    return filters.check_legal_values(B.units(spark, d), {"status": [(0, 1)], "priority": [(0, 2), (4, 4)]}, "unit_id")


@query("""select unit_id, concat_ws(',', case when not (price between 1000 and 200000) then 'price: range' end, case when segment not in ('BUILDING', 'MACHINERY') then 'segment: enum' end, case when (status = 2) <> (length(nullif(bucket, '07')) is null) then 'b: null_if' end) as reasons from units""")
def check_record_layout(spark, d):
    u = B.units(spark, d).withColumn("b", F.nullif("bucket", F.lit("07")))
    rules = [("price", "range", 1000, 200000), ("segment", "enum", ["BUILDING", "MACHINERY"], None), ("geocode", "width", 5, None), ("unit_id", "required", None, None), ("b", "null_if", None, "status = 2")]
    return filters.check_record_layout(u, rules).select("unit_id", F.concat_ws(",", "reasons").alias("reasons"))


# recodes


@query(f"select unit_id, case status when 0 then 'Filled' when 1 then 'Open' else '-1' end as status from units")
def recode_case(spark, d):
    return recode.recode_case(B.units(spark, d), "status", {0: "Filled", 1: "Open"}).select("unit_id", "status")


@query(f"select unit_id, {PR} as priority from units")
def recode_levels_labels(spark, d):
    there = recode.recode_levels_labels(B.units(spark, d), "priority", B.PRIORITY.labels)
    back = recode.recode_levels_labels(recode.recode_levels_labels(there, "priority", B.PRIORITY.labels, True), "priority", B.PRIORITY.labels)
    return back.select("unit_id", "priority")


#: Legal facility codes with their levels, as the SQL has them.
_FACILITIES = "101 18, 102 19, 103 20, 104 21, 105 22, 106 23, 201 24, 202 25, 203 26, 301 27, 401 28, 402 29, 403 30, 404 31, 405 32, 501 33, 601 34, 602 35, 701 36, 801 37, 802 38, 900 39, 901 40, 702 41, 704 41, 706 41, 903 41, 904 41"
_FACILITY_CODES = [x.split(" ")[0] for x in _FACILITIES.split(", ")]


def _person_codes(spark, d):
    p = B.persons(spark, d)
    return p.select("unit_id", "l_linenumber", "geocode", (F.col("sex") + 1).cast("string").alias("QSEX"), F.lpad((F.col("age") * 3).cast("string"), 3, "0").alias("QAGE"), (F.col("status") % 2 + 1).cast("string").alias("CENHISP"),
                    F.lpad((F.col("unit_id") % 65).cast("string"), 2, "0").alias("CENRACE"), F.when(F.col("priority") == 0, "   ").otherwise(F.get(F.lit(_FACILITY_CODES), (F.col("unit_id") % 28).cast("int"))).alias("QGQTYP"),
                    F.when(F.col("priority") == 0, F.col("l_linenumber") + 19 + F.col("unit_id") % 2 * 10).otherwise(37 + F.col("status") % 2).cast("string").alias("RELSHIP"))


_FAC = "(values " + ", ".join("({}, '{}', {})".format(k, *x.split(" ")) for k, x in enumerate(_FACILITIES.split(", "))) + ") f(k, code, level)"
_CODES = f"select unit_id, l_linenumber, sex, case when age * 3 between 0 and 115 then age * 3 end as age, case when age * 3 between 0 and 115 then (age * 3 >= 18)::int end as votingage, status % 2 as hispanic, case when priority = 0 then 0 else least(code::int // 100, 7) end as hhgq, case when unit_id % 65 between 1 and 63 then (unit_id % 65 - 1)::int end as cenrace, (case when priority = 0 then l_linenumber + 19 + unit_id % 2 * 10 end)::int as rel, case when priority > 0 then level end as fac, count(*) over (partition by unit_id) as pop from persons join {_FAC} on k = unit_id % 28"


@query(f"""select unit_id, l_linenumber, sex, age, votingage, hispanic, hhgq, cenrace, case when rel = 20 and pop = 1 then 0 when rel = 20 and pop > 1 then 1
   when rel = 21 then 2 when rel = 22 then 3 when rel = 23 then 4 when rel = 24 then 5 when rel = 25 then 6 when rel = 26 then 7 when rel = 30 then 11 when rel = 31 then 12 when rel = 32 then 13 when rel = 33 then 14 when rel = 34 then 15 when rel = 35 then 16 when rel = 36 then 17 else fac end as relgq,
   nullif(concat_ws(',', case when age is null then 'age' end, case when votingage is null then 'votingage' end, case when cenrace is null then 'cenrace' end), '') as error from ({_CODES})""")
def recode_input_person(spark, d):
    units = B.persons(spark, d).groupBy("unit_id").agg(F.count(F.lit(1)).alias("FINAL_POP"))
    return recode.recode_input_person(_person_codes(spark, d), units, "unit_id").select("unit_id", "l_linenumber", "sex", "age", "votingage", "hispanic", "hhgq", "cenrace", "relgq", "error")


@query(f"select hhgq, votingage, hispanic, cenrace, count(*) as n from ({_CODES}) group by all")
def recode_input_pl94(spark, d):
    return recode.recode_input_pl94(_person_codes(spark, d)).groupBy("hhgq", "votingage", "hispanic", "cenrace").agg(F.count(F.lit(1)).alias("n"))


@query("select unit_id, case when priority = 0 then 0 else least(priority * 2, 7) end as hhgq from units")
def recode_input_unit(spark, d):
    return recode.recode_input_unit(B.units(spark, d).withColumn("QGQTYP", F.when(F.col("priority") == 0, None).otherwise((F.col("priority") * 200 + 5).cast("string")))).select("unit_id", "hhgq")


@query(f"select unit_id, l_linenumber, sex, age, (age >= 18)::int as votingage, status % 2 as hispanic, case when priority > 0 then level when l_linenumber = 1 then unit_id % 2 else l_linenumber end as relgq from persons join {_FAC} on k = unit_id % 23")
def recode_from_output(spark, d):
    facility = F.get(F.lit(_FACILITY_CODES), (F.col("unit_id") % 23).cast("int"))
    out = B.persons(spark, d).withColumns({"QSEX": (F.col("sex") + 1).cast("string"), "QAGE": F.col("age").cast("string"), "CENHISP": (F.col("status") % 2 + 1).cast("string"), "GQTYPE": F.when(F.col("priority") > 0, facility).otherwise("000"),
        "RELSHIP": (F.col("l_linenumber") + 19).cast("string"), "LIVE_ALONE": F.when(F.col("unit_id") % 2 == 0, "1").otherwise("9")}).drop("sex", "age")
    return recode.recode_from_output(out, ["sex", "age", "votingage", "hispanic", "relgq"]).select("unit_id", "l_linenumber", "sex", "age", "votingage", "hispanic", "relgq")


@query("""select unit_id, bit_count(m)::int as numraces, case m when 0 then null when 1 then 0 when 2 then 1 when 4 then 2 when 3 then 3 when 5 then 4 when 6 then 5 else 6 end as cenrace from (select unit_id, (unit_id % 8)::int as m from units)""")
def recode_race_combination(spark, d):
    u = B.units(spark, d).withColumns({f"r{i}": (F.shiftright("unit_id", i) % 2).cast("int") for i in range(3)})
    return recode.recode_race_combination(u, ["r0", "r1", "r2"]).select("unit_id", F.col("numraces").cast("int").alias("numraces"), "cenrace")


@query("select age_group, count(*) as n from (select case when age between 0 and 17 then 'minor' when age between 18 and 44 then 'adult' else '-1' end as age_group from persons) group by all")
def recode_age_groups(spark, d):
    return recode.recode_age_groups(B.persons(spark, d), "age", [(0, 17, "minor"), (18, 44, "adult")]).groupBy("age_group").agg(F.count(F.lit(1)).alias("n"))


@query("select unit_id, (priority in (0, 1, 2))::int as family, (priority in (2, 4))::int as alone from units")
def recode_household_type(spark, d):
    return recode.recode_household_type(B.units(spark, d), "priority", {"family": [0, 1, 2], "alone": [2, 4]}).select("unit_id", "family", "alone")


@query("select \"group\", count(*) as n from (select case when t in (0, 1, 2, 3) then 'Occupied' when t between 4 and 10 then 'Vacant' else '-1' end as \"group\" from (select status * 5 + priority as t from units)) group by all")
def recode_tenure_vacancy_gq(spark, d):
    return recode.recode_tenure_vacancy_gq(B.units(spark, d).withColumn("t", F.col("status") * 5 + F.col("priority")), "t", "occupiedVacant").groupBy("group").agg(F.count(F.lit(1)).alias("n"))


@query("""select geocode, case when priority = 0 then '3' else '5' end as "RTYPE", case when priority = 0 then '000' else priority || '01' end as "GQTYPE", (sex + 1)::varchar as "QSEX", age as "QAGE", lpad((l_linenumber)::varchar, 2, '0') as "CENRACE", count(*) as n from persons group by all""")
def recode_output_person(spark, d):
    p = B.persons(spark, d).withColumns({"hhgq": F.col("priority"), "hispanic": F.lit(0), "cenrace": F.col("l_linenumber") - 1, "rel": F.lit(0)})
    return recode.recode_output_person(p).groupBy("geocode", "RTYPE", "GQTYPE", "QSEX", "QAGE", "CENRACE").agg(F.count(F.lit(1)).alias("n"))


@query("""select geocode, case when r < 18 then '3' else '5' end as "RTYPE", case when r < 18 then '000' else ['101', '102', '103', '104', '105', '106', '201', '202', '203', '301', '401', '402', '403', '404', '405', '501', '601', '602', '701', '801', '802', '900', '901', '997'][r - 17] end as "GQTYPE",
   case when r in (0, 1) then '20' when r between 2 and 17 then (r + 19)::varchar when r between 18 and 32 then '37' else '38' end as "RELSHIP", count(*) as n from (select geocode, ((unit_id + l_linenumber) % 42)::int as r from persons) group by all""")
def recode_output_person_relationship(spark, d):
    p = B.persons(spark, d).withColumns({"relgq": ((F.col("unit_id") + F.col("l_linenumber")) % 42).cast("int"), "hispanic": F.lit(0), "cenrace": F.lit(0)})
    return recode.recode_output_person(p, recode.RELATIONSHIP_LAYOUT).groupBy("geocode", "RTYPE", "GQTYPE", "RELSHIP").agg(F.count(F.lit(1)).alias("n"))


@query("""select geocode, case when status = 2 then '0' else (priority % 4 + 1)::varchar end as "TEN", case when status = 2 then '1' else '0' end as "VACS", case when status = 2 then 0 else priority + 1 end as "HHSIZE", case when priority > 1 then 1 else 0 end as "P65", count(*) as n from units group by all""")
def recode_output_unit(spark, d):
    u = B.units(spark, d).withColumns({"hhgq": F.lit(0), "vacs": (F.col("status") == 2).cast("int"), "ten": F.col("priority") % 4, "hhsize": F.col("priority") + 1, "sex": F.lit(0), "elderly": F.col("priority"), "multi": F.lit(0)})
    return recode.recode_output_unit(u).groupBy("geocode", "TEN", "VACS", "HHSIZE", "P65").agg(F.count(F.lit(1)).alias("n"))


# The output's codes by type, once more as SQL lists.
_HOUSEHOLDS = "(select geocode, (unit_id % 24)::int as t, (unit_id // 24 % 2)::int as s, (unit_id // 7 % 7 + 1)::int as z, status, priority from units)"


@query(f"""select geocode, case when t in (0, 1, 2, 3, 4, 5, 6, 7) then '1' when t in (8, 9, 10, 11, 13, 14, 15, 16, 19, 20, 21, 22) then case s when 0 then '2' else '3' end
    else case when s = 0 and z = 1 then '4' when s = 0 then '5' when z = 1 then '6' else '7' end end as "HHT",
  case when t in (0, 1, 2, 4, 5, 6) then '01' when t in (3, 7) then '02' when t in (8, 9, 10, 13, 14, 15) then '03' when t in (11, 12, 16, 17) then '04' when t = 18 then case s when 1 then '05' else '09' end
    when t in (19, 20, 21) then case s when 1 then '06' else '10' end when t = 22 then case s when 1 then '07' else '11' end else case s when 1 then '08' else '12' end end as "HHT2",
  case when t in (0, 1, 2, 3) then '1' when t in (4, 5, 6, 7) then '2' when t in (8, 9, 10, 11, 12) then '3' when t in (13, 14, 15, 16, 17) then '4' else '0' end as "CPLT",
  case when t in (13, 14, 15, 16, 17) then case s when 0 then '1' else '3' end when t in (8, 9, 10, 11, 12) then case s when 0 then '2' else '4' end else '5' end as "UPART",
  case when z < 3 then '0' else (status % 2 + 1)::varchar end as "MULTG", priority + 3 as "HHLDRAGE", (status % 2 + 1)::varchar as "HHSPAN", '0' || (priority + 1) as "HHRACE",
  case when t in (0, 4, 8, 13, 19) then '1' when t in (1, 5, 9, 14, 20) then '2' when t in (2, 6, 10, 15, 21) then '3' else '4' end as "PAOC", 9 as "P18", (priority in (1, 2, 3))::int as "P60", (priority in (2, 3))::int as "P65", (priority = 3)::int as "P75", count(*) as n from {_HOUSEHOLDS} group by all""")
def recode_output_household(spark, d):
    u = B.units(spark, d).withColumns({"hhtype": (F.col("unit_id") % 24).cast("int"), "sex": (F.floor(F.col("unit_id") / 24) % 2).cast("int"), "hhsize": (F.floor(F.col("unit_id") / 7) % 7 + 1).cast("int"),
        "multi": F.col("status") % 2, "hhage": F.col("priority") + 2, "hispanic": F.col("status") % 2, "hhrace": F.col("priority"), "elderly": F.col("priority") % 4})
    cols = ["geocode", "HHT", "HHT2", "CPLT", "UPART", "MULTG", "HHLDRAGE", "HHSPAN", "HHRACE", "PAOC", "P18", "P60", "P65", "P75"]
    return recode.recode_output_unit(u, recode.HOUSEHOLD_LAYOUT).groupBy(*cols).agg(F.count(F.lit(1)).alias("n"))


@query("""select "CVAPRACE", count(*) as n from (select case when status = 1 and age >= 18 then case when sex = 1 then 1 when r = 0 then 2 when r = 1 then 3 when r = 2 then 4 when r = 3 then 5 when r = 4 then 6 when r = 5 then 7
   when r = 6 then 8 when r = 7 then 9 when r = 8 then 10 when r = 11 then 11 else 12 end end as "CVAPRACE" from (select *, unit_id % 63 as r from persons)) group by all""")
def recode_output_citizen_race(spark, d):
    p = B.persons(spark, d).withColumns({"citizen": (F.col("status") == 1).cast("int"), "votingage": (F.col("age") >= 18).cast("int"), "hispanic": F.col("sex"), "cenrace": (F.col("unit_id") % 63).cast("int")})
    return recode.recode_output_citizen_race(p).groupBy("CVAPRACE").agg(F.count(F.lit(1)).alias("n"))


@query("select distinct geolevel, geocode, rpad(substr(geocode, 1, 1), 1, 'X') as region, rpad(substr(geocode, 2, 2), 2, 'X') as nation, rpad(substr(geocode, 4, 2), 2, 'X') as bucket from rolled")
def geo_split_padded(spark, d):
    return recode.geo_split_padded(B.rolled(spark, d).select("geolevel", "geocode").distinct(), "geocode", [("region", 1), ("nation", 2), ("bucket", 2)])


@query(f"select unit_id, {ST} || ' BY ' || {PR} as level from units")
def merge_dims_to_level(spark, d):
    u = recode.recode_levels_labels(recode.recode_levels_labels(B.units(spark, d), "status", B.STATUS.labels), "priority", B.PRIORITY.labels)
    return recode.merge_dims_to_level(u, ["status", "priority"]).select("unit_id", "level")


@query("select geocode, (status * 5 + priority)::bigint as cell, cnt from hist")
def flat_index(spark, d):
    return recode.flat_index(B.hist(spark, d), ["status", "priority"], [3, 5]).select("geocode", "cell", "cnt")


@query("select geocode, status, priority, cnt from hist")
def unflat_index(spark, d):
    return recode.unflat_index(recode.flat_index(B.hist(spark, d), ["status", "priority"], [3, 5]).drop("status", "priority"), ["status", "priority"], [3, 5]).select("geocode", "status", "priority", "cnt")


@query("select bin, count(*) as n from (select case when priv < 1 then '[0-1)' when priv < 5 then '[1-5)' when priv < 10 then '[5-10)' else '10 +' end as bin from analysis) group by all")
def bin_counts(spark, d):
    return recode.bin_counts(B.analysis(spark, d), "priv", [0, 1, 5, 10]).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("select bin, count(*) as n from (select case when x is null then 'NaN' when x < 0 then '(-Inf, 0)' when x < 1 then '[0, 1)' when x < 5 then '[1, 5)' else '[5, +Inf)' end as bin from (select nullif(priv - orig, 1) as x from analysis)) group by all")
def bin_sql(spark, d):
    return recode.bin_sql(B.analysis(spark, d).withColumn("x", F.nullif(F.col("priv") - F.col("orig"), F.lit(1))), "x", [0, 1, 5]).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("select bin, count(*) as n from (select case when orig < 1 then 0 else pow(10, length(orig::varchar) - 1) end::bigint as bin from answers) group by all")
def bin_power10(spark, d):
    return recode.bin_power10(B.answers(spark, d), "orig").groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


@query("select bin, count(*) as n from (select (orig >= 0)::int + (orig >= 3)::int + (orig >= 30)::int as bin from answers) group by all")
def bin_digitize(spark, d):
    return recode.bin_digitize(B.answers(spark, d), "orig", [0, 3, 30]).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


# geography


@query('select distinct geocode, substr(geocode, 1, 1) as "Region", substr(geocode, 1, 3) as "Nation", substr(geocode, 1, 5) as "Block" from customers')
def geo_trunk_columns(spark, d):
    return geo.geo_trunk_columns(B.customers(spark, d).select("geocode").distinct(), HIER)


@query("select distinct geocode, geolevel, case length(geocode) when 5 then substr(geocode, 1, 3) when 3 then substr(geocode, 1, 1) end as parent_geocode from rolled")
def geo_parent(spark, d):
    return geo.geo_parent(B.rolled(spark, d).select("geocode").distinct(), HIER).select("geocode", "geolevel", "parent_geocode")


@query('select distinct geocode, region || segment as "SEG", region || nation || bucket as "CELL" from customers')
def geo_crosswalk(spark, d):
    return geo.geo_crosswalk(B.customers(spark, d), {"SEG": ["region", "segment"], "CELL": ["region", "nation", "bucket"]}).distinct()


_RANGES = [("00000", "04999", "legal"), ("05000", "09999", "legal"), ("10000", "20999", "statistical"), ("21000", "99999", "state")]
_RSQL = "(values ('00000', '04999', 'legal'), ('05000', '09999', 'legal'), ('10000', '20999', 'statistical'), ('21000', '99999', 'state')) r(lo, hi, class)"


def _ranges(spark):
    return spark.createDataFrame(_RANGES, "lo string, hi string, class string")


@query(f"select distinct geocode, class, class in ('legal', 'state') as in_class from customers left join {_RSQL} on geocode between lo and hi")
def geo_area_class(spark, d):
    return geo.geo_area_class(B.customers(spark, d).select("geocode").distinct(), _ranges(spark), ["legal", "state"], "geocode")


@query("select c_custkey, case when region in ('1', '3') and bucket <> '05' then 'M' || bucket else 'P' || segment end as entity from customers")
def geo_off_spine_entity(spark, d):
    return geo.geo_off_spine_entity(B.customers(spark, d).withColumn("tribal", F.col("bucket") == "05"), ["1", "3"], "region", "bucket", "segment").select("c_custkey", "entity")


@query(f"select distinct geocode, case when class = 'legal' then '1' || region || geocode || nation || bucket else '0' || region || nation || bucket end as spine from customers left join {_RSQL} on geocode between lo and hi")
def geo_spine_key(spark, d):
    return geo.geo_spine_key(B.customers(spark, d).select("geocode", "region", "nation", "bucket").distinct(), _ranges(spark), ["legal"], ["region", "nation", "bucket"], "geocode").select("geocode", "spine")


@query("select 'S' || geocode as geocode, count(*) as n from units where geocode not like '4%' group by all union all select geocode, count(*) from units where geocode like '4%' group by all")
def geo_spine_remap(spark, d):
    m = B.customers(spark, d).select("geocode", F.concat(F.lit("S"), "geocode").alias("spine")).filter("geocode not like '4%'").distinct()
    there = geo.geo_spine_remap(B.units(spark, d), m)
    back = geo.geo_spine_remap(there, m, True)
    return geo.geo_spine_remap(back, m).groupBy("geocode").agg(F.count(F.lit(1)).alias("n"))


@query("select c_custkey, lpad(c_custkey::varchar, (select max(length(c_custkey::varchar)) from customers)::int, '0') as a, lpad(bucket, 2, '0') as b from customers")
def geo_pad_widths(spark, d):
    return geo.geo_pad_widths(B.customers(spark, d).select("c_custkey", F.col("c_custkey").cast("string").alias("a"), F.col("bucket").cast("int").cast("string").alias("b")), ["a", "b"])


@query("select geocode, substr(geocode, 1, 3) as parent, lpad((row_number() over (partition by substr(geocode, 1, 3) order by geocode) - 1)::varchar, 4, '0') as child_id from (select distinct geocode from customers)")
def geo_dense_child_ids(spark, d):
    return geo.geo_dense_child_ids(B.customers(spark, d).select("geocode", F.substring("geocode", 1, 3).alias("parent")).distinct(), "parent", ["geocode"])


@query("select geocode, string_agg(case when n > 0 then '1' else '0' end, '' order by p) as signature from (select g.geocode, p, count(unit_id) as n from (select distinct geocode from units) g cross join (select unnest(range(5))::int as p) left join units u on u.geocode = g.geocode and u.priority = p group by all) group by geocode")
def geo_gq_signature(spark, d):
    wide = B.units(spark, d).groupBy("geocode").agg(*[F.count_if(F.col("priority") == p).alias(f"n{p}") for p in range(5)])
    return geo.geo_gq_signature(wide, [f"n{p}" for p in range(5)]).select("geocode", "signature")


@query("select parent, unit, entities, dense_rank() over (partition by parent order by entities)::int as group_no from (select region as parent, nation as unit, array_to_string(list_sort(list(distinct segment)), ',') as entities from customers group by all)")
def geo_group_same_entities(spark, d):
    c = B.customers(spark, d).select(F.col("region").alias("parent"), F.col("nation").alias("unit"), "segment")
    return geo.geo_group_same_entities(c, "parent", "unit", "segment")


@query("""select geolevel, geocode, entity, least(a, b + 1)::bigint as distance from (
  select 'Nation' as geolevel, substr(geocode, 1, 3) as geocode, entity, sum(hit) as a, sum(1 - hit) as b from bl group by all
  union all select 'Region', substr(geocode, 1, 1), entity, sum(least(a, b + 1)), sum(least(b, a + 1)) from (select substr(geocode, 1, 3) as geocode, entity, sum(hit) as a, sum(1 - hit) as b from bl group by all) group by all)
""".replace("from bl", "from (select w.geocode, e.segment as entity, (w.segment = e.segment)::int as hit from xwalk w join (select distinct substr(geocode, 1, 1) as r, segment from xwalk) e on substr(w.geocode, 1, 1) = e.r)"))
def geo_entity_distance(spark, d):
    return geo.geo_entity_distance(B.xwalk(spark, d), HIER, "segment")


#: A hierarchy in which some parents have one child: nations by the tens of their number.
TENS = [("Region", 1), ("Tens", 2), ("Nation", 3)]


def _shares(spark, d):
    x = hist.geo_rollup(B.hist(spark, d), TENS, [])
    return x.select("geolevel", "geocode", (F.when(F.col("geolevel") == "Region", 0.5).otherwise(0.25)).alias("share"))


_SH = "(select distinct geolevel, geocode, case geolevel when 'Region' then 0.5 else 0.25 end::double as share from (select 'Region' as geolevel, substr(geocode, 1, 1) as geocode from hist union all select 'Tens', substr(geocode, 1, 2) from hist union all select 'Nation', substr(geocode, 1, 3) from hist))"


@query(f"""select geolevel, geocode, (case when geolevel = 'Nation' then case when pn = 1 then 0 else share end when geolevel = 'Tens' then case when pn = 1 then 0 else share + case when kids = 1 then 0.25 else 0 end end
   else share + case when kids = 1 then 0.25 + case when gk = 1 then 0.25 else 0 end else 0 end end)::double as share from (
  select s.*, case geolevel when 'Nation' then (select count(*) from {_SH} x where x.geolevel = 'Nation' and substr(x.geocode, 1, 2) = substr(s.geocode, 1, 2)) when 'Tens' then (select count(*) from {_SH} x where x.geolevel = 'Tens' and substr(x.geocode, 1, 1) = substr(s.geocode, 1, 1)) end as pn,
   case geolevel when 'Tens' then (select count(*) from {_SH} x where x.geolevel = 'Nation' and substr(x.geocode, 1, 2) = s.geocode) when 'Region' then (select count(*) from {_SH} x where x.geolevel = 'Tens' and substr(x.geocode, 1, 1) = s.geocode) end as kids,
   case geolevel when 'Region' then (select count(*) from {_SH} x where x.geolevel = 'Nation' and substr(x.geocode, 1, 1) = s.geocode) end as gk from {_SH} s)""", "share")
def geo_bypass_single_child(spark, d):
    return geo.geo_bypass_single_child(_shares(spark, d), TENS).select("geolevel", "geocode", "share")


@query(f"select geocode as leaf, 0.75::double as spent from {_SH} where geolevel = 'Nation' and geocode like '2%'", "spent")
def geo_check_path_budget(spark, d):
    s = _shares(spark, d).withColumn("share", F.when((F.col("geolevel") == "Tens") & F.col("geocode").startswith("2"), 0.0).otherwise(F.col("share")))
    return geo.geo_check_path_budget(s, TENS, 1.0)


# joins


@query("select unit_id, geocode from units")
def join_unit_geography(spark, d):
    ref = B.customers(spark, d).select(F.col("c_custkey").alias("block"), "geocode")
    u = B.table(spark, d, "orders").select(F.col("o_orderkey").alias("unit_id"), F.col("o_custkey").alias("block"))
    return joins.join_unit_geography(u, ref).select("unit_id", "geocode")


@query("select unit_id, l_linenumber, geocode from persons")
def join_person_unit(spark, d):
    p = B.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit_id"), "l_linenumber")
    return joins.join_person_unit(p, B.units(spark, d).select("unit_id", "geocode"), "unit_id").select("unit_id", "l_linenumber", "geocode")


@query("select u.geocode, u.cnt as units, coalesce(p.persons, 0)::bigint as persons from (select geocode, sum(cnt)::bigint as cnt from hist group by all) u left join (select geocode, count(*) as persons from persons where age > 45 and status = 0 group by all) p using (geocode)")
def join_two_universes(spark, d):
    p = B.persons(spark, d).filter("age > 45 and status = 0").groupBy("geocode").agg(F.count(F.lit(1)).alias("persons"))
    return joins.join_two_universes(p, Q.query_total(B.hist(spark, d)).withColumnRenamed("cnt", "units"), ["geocode"]).select("geocode", "units", "persons")


@query("select coalesce(a.geocode, b.geocode) as geocode, coalesce(a.status, b.status) as status, coalesce(a.priority, b.priority) as priority, coalesce(orig, 0) as orig, coalesce(priv, 0) as priv, coalesce(run_id, 'run_0') as run_id from (select geocode, status, priority, cnt as orig from hist) a full join (select geocode, (status + 1) % 3 as status, priority, priv, run_id from analysis) b using (geocode, status, priority)")
def join_orig_priv(spark, d):
    """The protected side's statuses are moved by one, so that rows on both sides find no partner."""
    orig = B.hist(spark, d).withColumnRenamed("cnt", "orig")
    priv = B.analysis(spark, d).select("geocode", ((F.col("status") + 1) % 3).alias("status"), "priority", "priv", "run_id")
    return joins.join_orig_priv(orig, priv, ["status", "priority"], {"run_id": "run_0"})


@query("select geocode, segment, sum(cnt)::bigint as cnt from hist join xwalk using (geocode) group by all")
def join_crosswalk(spark, d):
    return joins.join_crosswalk(B.hist(spark, d), B.xwalk(spark, d), ["segment"]).groupBy("geocode", "segment").agg(F.sum("cnt").alias("cnt"))


@query("select geocode, substr(geocode, 1, 3) as parent_geocode, status, priority, cnt, sum(cnt) over (partition by substr(geocode, 1, 3), status, priority)::bigint as parent_cnt from hist")
def join_parent_children(spark, d):
    h = B.hist(spark, d)
    up = h.groupBy(F.substring("geocode", 1, 3).alias("geocode"), "status", "priority").agg(F.sum("cnt").alias("cnt"))
    return joins.join_parent_children(up, h.withColumn("parent_geocode", F.substring("geocode", 1, 3)), ["status", "priority"]).select("geocode", "parent_geocode", "status", "priority", "cnt", "parent_cnt")


@query("""select geocode, query, level, up as noisy, low as child_noisy from (select substr(geocode, 1, 3) || '/' || run_id as geocode, query, level, max(case when geolevel = 'Nation' then priv end) as up, sum(case when geolevel = 'Block' then priv end)::bigint as low
 from answers where geolevel <> 'Region' group by all) where up is not null and low is not null""")
def join_lower_measurements(spark, d):
    """Every run's units are units of their own: geocode = code/run."""
    a = B.answers(spark, d).withColumnRenamed("priv", "noisy").withColumns({"variance": F.lit(1.0), "parent_geocode": F.concat(F.substring("geocode", 1, 3), F.lit("/"), "run_id"), "geocode": F.concat("geocode", F.lit("/"), "run_id")})
    low = a.filter("geolevel = 'Block'")
    return joins.join_lower_measurements(a.filter("geolevel = 'Nation'"), low).select("geocode", "query", "level", "noisy", "child_noisy")


@query("""select geolevel, geocode, run_id, query, level, orig, orig_sum, priv_sum from (select *, max(case when query = 'total' then orig end) over w as orig_sum, max(case when query = 'total' then priv end) over w as priv_sum
 from answers window w as (partition by geolevel, geocode, run_id)) where query <> 'total'""")
def join_ratio_denominator(spark, d):
    return joins.join_ratio_denominator(B.answers(spark, d), keys=("geolevel", "geocode", "run_id")).select("geolevel", "geocode", "run_id", "query", "level", "orig", "orig_sum", "priv_sum")


@query("select a.geocode, a.geolevel, a.run_id, a.orig, s.area from answers a join (select geocode, sum(abs(c_acctbal)) as area from customers group by all) s on a.geocode = s.geocode where a.query = 'total' and a.geolevel = 'Block'", "area")
def join_population_area(spark, d):
    area = B.customers(spark, d).groupBy("geocode").agg(F.sum(F.abs("c_acctbal")).alias("area")).withColumn("geolevel", F.lit("Block"))
    return joins.join_population_area(B.answers(spark, d).filter("query = 'total'"), area).select("geocode", "geolevel", "run_id", "orig", "area")


@query("select q.geocode, q.geolevel, q.run_id, q.level, q.orig, q.priv, t.orig as orig_total, t.priv as priv_total from answers q join answers t on q.geolevel = t.geolevel and q.geocode = t.geocode and q.run_id = t.run_id and t.query = 'total' where q.query = 'status'")
def join_race_to_total(spark, d):
    a = B.answers(spark, d)
    return joins.join_race_to_total(a.filter("query = 'status'"), a.filter("query = 'total'")).select("geocode", "geolevel", "run_id", "level", "orig", "priv", "orig_total", "priv_total")


@query("select coalesce(a.geocode, b.geocode) as geocode, coalesce(a.priority, b.priority) as priority, coalesce(n_a, 0) as n_a, coalesce(n_b, 0) as n_b from (select geocode, priority, count(*) as n_a from units group by all) a full join (select geocode, priority, count(*) as n_b from moved group by all) b using (geocode, priority)")
def join_counts_by_type(spark, d):
    return joins.join_counts_by_type(B.units(spark, d), B.moved(spark, d), ["geocode", "priority"])


@query("select unit_id from units where geocode in (select geocode from xwalk where segment = 'BUILDING')")
def join_membership(spark, d):
    return joins.join_membership(B.units(spark, d), B.xwalk(spark, d).filter("segment = 'BUILDING'"), "geocode").select("unit_id")


@query(f"select class, count(*) as n from units join {_RSQL} on geocode between lo and hi group by all")
def join_range_codes(spark, d):
    return joins.join_range_codes(B.units(spark, d), _ranges(spark), "geocode").groupBy("class").agg(F.count(F.lit(1)).alias("n"))


# histograms


@query("select * from hist")
def hist_sparse(spark, d):
    return B.hist(spark, d)


@query("select geocode, string_agg(cell || ':' || cnt, ',' order by cell) as cells from (select geocode, status * 5 + priority as cell, cnt from hist) group by all")
def hist_nested(spark, d):
    n = hist.hist_nested(B.hist(spark, d), "geocode", ["status", "priority"], [3, 5])
    return n.select("geocode", F.array_join(F.transform("cells", lambda x: F.concat_ws(":", x["cell"], x["cnt"])), ",").alias("cells"))


@query("select geocode, status, priority, coalesce(cnt, 0)::bigint as cnt from (select distinct geocode from hist) cross join (select unnest(range(3))::int as status) cross join (select unnest(range(5))::int as priority) left join hist using (geocode, status, priority)")
def hist_dense(spark, d):
    return hist.hist_dense(B.hist(spark, d), SCHEMA).select("geocode", "status", "priority", "cnt")


@query("""select u.geocode, n.priority, coalesce(n.orig, 0)::bigint as orig, coalesce(n.priv, 0)::bigint as priv from (select distinct run_id || '/' || geocode || '/' || s as geocode from hist, (select unnest(['run_0', 'run_1', 'run_2']) as run_id), (select unnest([0, 1, 2]) as s)) u
 left join (select run_id || '/' || geocode || '/' || status as geocode, priority, orig, priv from analysis where orig <> 0 or priv <> 0) n using (geocode)""")
def hist_nonzero(spark, d):
    """A unit is a block's orders of one status in one run: many are empty."""
    code = lambda status: F.concat_ws("/", "run_id", "geocode", status).alias("geocode")
    every = B.hist(spark, d).select("geocode", F.explode(F.lit(["run_0", "run_1", "run_2"])).alias("run_id")).distinct().withColumn("s", F.explode(F.lit([0, 1, 2]))).select(code("s"))
    return hist.hist_nonzero(B.analysis(spark, d).select(code("status"), "priority", "orig", "priv"), every, ["priority"])


@query("select geocode, priority, count(distinct unit_id) as units from persons group by all")
def hist_units_from_persons(spark, d):
    return hist.hist_units_from_persons(B.persons(spark, d), "geocode", "priority", "unit_id")


@query("select geocode, priority as p, 'run_0' as run_id, count(*) as priv from moved group by all")
def hist_from_output(spark, d):
    out = B.moved(spark, d).withColumn("PRIO", (F.col("priority") + 1).cast("string"))
    return hist.hist_from_output(out, ["region", "nation", "bucket"], {"p": "cast(PRIO as int) - 1"}, {"run_id": "run_0"})


@query("select run_id, geocode, status, priority, (orig - priv)::bigint as cnt from analysis where orig <> priv")
def hist_arith(spark, d):
    keys, runs = ["run_id", "geocode", "status", "priority"], B.analysis(spark, d)
    return hist.hist_arith(B.hist(spark, d).withColumn("run_id", F.explode(F.lit(["run_0", "run_1", "run_2"]))), runs.select(*keys, F.col("priv").alias("cnt")), "subtract", keys)


@query("select run_id, geocode, status, priority, orig as count_a, priv as count_b from analysis where abs(orig - priv) > 1")
def hist_equal(spark, d):
    keys, runs = ["run_id", "geocode", "status", "priority"], B.analysis(spark, d)
    return hist.hist_equal(B.hist(spark, d).withColumn("run_id", F.explode(F.lit(["run_0", "run_1", "run_2"]))), runs.select(*keys, F.col("priv").alias("cnt")), keys, 1)


@query("select geolevel, geocode, status, priority, orig as cnt from rolled where run_id = 'run_0'")
def geo_rollup(spark, d):
    return hist.geo_rollup(B.hist(spark, d), HIER, ["status", "priority"])


@query(f"select geolevel, geocode, run_id, {SUM} from (select geolevel, geocode, run_id, orig, priv from rolled where geolevel <> 'Nation' union all select 'segment', segment, run_id, orig, priv from analysis join xwalk using (geocode)) group by all")
def geo_rollup_any(spark, d):
    df = joins.join_crosswalk(B.analysis(spark, d), B.xwalk(spark, d), ["segment"])
    return hist.geo_rollup_any(df, [h for h in HIER if h[0] != "Nation"], ["segment"], ["run_id"])


@query("select 'region' as geolevel, region as geocode, sum(c_acctbal) as area from customers group by all union all select 'segment', segment, sum(c_acctbal) from customers group by all", "area")
def geo_rollup_area(spark, d):
    return hist.geo_rollup_area(B.customers(spark, d).withColumnRenamed("c_acctbal", "area"), ["region", "segment"], ["area"])


# queries


@query("select geocode, priority, sum(cnt)::bigint as cnt from hist where status in (0, 1) group by all")
def query_subset_marginal(spark, d):
    return Q.query_subset_marginal(B.hist(spark, d), {"status": [0, 1]}, ["priority"])


@query("select geocode, 'Closed' as status, case when priority < 2 then 'P' else 'Q' end as priority, sum(cnt)::bigint as cnt from hist where status = 0 and priority < 4 group by all")
def query_grouped_marginal(spark, d):
    return Q.query_grouped_marginal(B.hist(spark, d), {"status": {"Closed": (0,)}, "priority": {"P": (0, 1), "Q": (2, 3)}})


@query("select geocode, sum(cnt)::bigint as cnt from hist group by all")
def query_total(spark, d):
    return Q.query_total(B.hist(spark, d))


@query("select * from hist")
def query_detailed(spark, d):
    return Q.query_detailed(B.hist(spark, d), ["status", "priority"])


@query(f"select geocode, {ST} as status, {PS} as priority, sum(cnt)::bigint as cnt from hist group by all")
def query_by_name(spark, d):
    return Q.query_by_name(B.hist(spark, d), "pressing * status", SCHEMA)


@query(f"select geolevel, geocode, run_id, plb, 'closed * pressing' as query, 'Closed BY ' || {PS} as level, {SUM} from rolled where status = 0 group by all")
def query_answer(spark, d):
    return Q.query_answer(B.rolled(spark, d), "closed * pressing", SCHEMA, KEYS)


@query("select * from answers")
def query_answer_many(spark, d):
    return B.answers(spark, d)


@query(f"select geocode, level, sum(2 * a - 0.5 * b)::double as answer from (select geocode, {ST} as level, sum(cnt) as a, 0 as b from hist group by all union all select geocode, 'Closed', 0, sum(cnt) from hist where status = 0 group by all) group by all", "answer")
def query_combo(spark, d):
    return Q.query_combo(B.hist(spark, d), SCHEMA, {"status": 2.0, "closed": -0.5}, ["geocode"])


@query(f"select geocode, level, sum(x)::bigint as answer from (select geocode, {ST} as level, -count(*) as x from units group by all union all select geocode, {ST}, count(*) from persons group by all) group by all")
def query_multi_hist(spark, d):
    p = hist.hist_sparse(B.persons(spark, d), "geocode", ["status", "priority"])
    return Q.query_multi_hist([(p, "status", 1), (B.hist(spark, d), "status", -1)], SCHEMA, ["geocode"])


@query("select geocode, sum(case when status = 0 and priority > 2 then cnt else 0 end)::bigint as inside, sum(case when status = 0 and priority > 2 then 0 else cnt end)::bigint as outside from hist group by all")
def query_predicate_pair(spark, d):
    return Q.query_predicate_pair(B.hist(spark, d), "status = 0 and priority > 2")


@query("select geocode, \"row\", sum(coef * cnt)::bigint as answer from hist join (select c as cell, (c % 4) as \"row\", c + 1 as coef from (select unnest(range(15)) as c)) on status * 5 + priority = cell group by all")
def query_sparse_matrix(spark, d):
    m = spark.range(15).select(F.col("id").alias("cell"), (F.col("id") % 4).alias("row"), (F.col("id") + 1).alias("coef"))
    return Q.query_sparse_matrix(B.hist(spark, d), m, ["status", "priority"], [3, 5])


@query("select geocode, status, priority, sum(cnt)::bigint as cnt, (1 - grouping(status) + 1 - grouping(priority))::int as n_dims from hist group by grouping sets ((geocode, status, priority), (geocode, status), (geocode, priority), (geocode))")
def query_all_marginals(spark, d):
    return Q.query_all_marginals(B.hist(spark, d), ["status", "priority"])


@query("select s || ' BY ' || p as level, count(geocode) as n from (select unnest(['Filled', 'Open', 'Pending']) as s) cross join (select unnest(['Urgent', 'High', 'Medium', 'None', 'Low']) as p) left join answers on level = s || ' BY ' || p group by all")
def query_levels(spark, d):
    levels = Q.query_levels(spark, "status * priority", SCHEMA)
    return levels.join(B.answers(spark, d).filter("query = 'status * priority'"), "level", "left").groupBy("level").agg(F.count("geocode").alias("n"))


@query(f"select 'T1' as table_name, geolevel, geocode, run_id, plb, query, level, orig, priv from answers where query in ('total', 'status') union all select 'T2', geolevel, geocode, run_id, plb, query, level, orig, priv from answers where query in ('status', 'status * priority')")
def table_product(spark, d):
    return Q.table_product(B.rolled(spark, d), {"T1": ["total", "status"], "T2": ["status", "status * priority"]}, ["T1", "T2"], SCHEMA, KEYS)


_AGES = "case when age >= 18 then '18 years and over' else '17 years and under' end"
_CITIZENS = "case when status = 1 then 'Citizen' else 'Non-citizen' end"
_RACES = "case when r < 6 then '1 race' when r < 21 then '2 races' when r < 41 then '3 races' when r < 56 then '4 races' when r < 62 then '5 races' else '6 races' end"
_P3 = {"votingage": _AGES, "votingage * numraces": f"{_AGES} || ' BY ' || {_RACES}", "votingage * citizen": f"{_AGES} || ' BY ' || {_CITIZENS}", "votingage * numraces * citizen": f"{_AGES} || ' BY ' || {_RACES} || ' BY ' || {_CITIZENS}"}


@query("select * from (" + " union all ".join(f"select t as table_name, g as geocode, '{q}' as query, {level} as level, count(*) as cnt from p join (values ('P3_CVAP')" + ("" if "citizen" in q else ", ('P3')") + ") v(t) on true group by all" for q, level in _P3.items()).replace("from p ", "from (select *, substr(geocode, 1, 3) as g, (unit_id % 63)::int as r from persons) p ") + ")")
def table_product_citizens(spark, d):
    """The published tables of the voting age with and without citizenship; races by their number only, to keep the SQL readable."""
    p = B.persons(spark, d).select(F.substring("geocode", 1, 3).alias("geocode"), F.lit(0).alias("hhgq"), (F.col("age") >= 18).cast("int").alias("votingage"), F.lit(0).alias("hispanic"), (F.col("unit_id") % 63).cast("int").alias("cenrace"), (F.col("status") == 1).cast("int").alias("citizen"))
    schema = A.pl94_citizens()
    cells = p.groupBy("geocode", *schema.names).agg(F.count(F.lit(1)).alias("cnt"))
    tables = {t: [q for q in A.TABLES[t] if "cenrace" not in q] for t in ("P3", "P3_CVAP")}
    return Q.table_product(cells, tables, list(tables), schema, ["geocode"], ("cnt",)).select("table_name", "geocode", "query", "level", "cnt")


_FULL = f"(select k.*, w.level, coalesce(a.orig, 0)::bigint as orig, coalesce(a.priv, 0)::bigint as priv, a.orig is null as was_missing from (select distinct geolevel, geocode, run_id, plb from rolled) k cross join (select s || ' BY ' || p as level from (select unnest(['Filled', 'Open', 'Pending']) as s) cross join (select unnest(['Urgent', 'High', 'Medium', 'None', 'Low']) as p)) w left join (select * from answers where query = 'status * priority') a using (geolevel, geocode, run_id, plb, level))"


@query(f"select geolevel, geocode, run_id, plb, 'status * priority' as query, level, orig, priv, was_missing from {_FULL}")
def table_full_workload(spark, d):
    a = B.answers(spark, d).filter("query = 'status * priority'")
    return Q.table_full_workload(a, ["status * priority"], SCHEMA, KEYS)


@query(f"select geolevel, sum(was_missing::int)::bigint as missing from {_FULL} group by all")
def table_missing_counts(spark, d):
    return Q.table_missing_counts(B.answers(spark, d).filter("query = 'status * priority'"), ["status * priority"], SCHEMA, KEYS)


@query("select region, max(n)::bigint as most from (select substr(geocode, 1, 1) as region, s + substr(geocode, 4, 2)::int % 3 as n from (select geocode, sum(cnt) as s from hist group by all)) group by all")
def sql_table_pipeline(spark, d):
    out = Q.sql_table_pipeline(
        spark, {"cells": B.hist(spark, d)}, {"blocks": "select geocode, sum(cnt) as n from cells group by geocode"}, {"blocks": ("n", "cast(substr(geocode, 4, 2) as int) % 3")},
        {"regions": "select substr(geocode, 1, 1) as region, max(n) as most from blocks{t} group by 1"},
    )
    return out["regions_noisy"]


@query("select geocode, cnt * 2 as twice from hist")
def sql_add_drop_measures(spark, d):
    return Q.sql_add_drop_measures(B.hist(spark, d), {"twice": "cnt * 2"}, ["cnt", "status", "priority"])


@query("select geolevel, count(distinct geocode) as geounits from rolled group by all")
def geolevel_counts(spark, d):
    return Q.geolevel_counts(B.rolled(spark, d))


@query("select geolevel, plb, count(*) as num_obs from (select distinct geolevel, plb, geocode, run_id from rolled) group by all")
def num_obs(spark, d):
    return Q.num_obs(B.rolled(spark, d))


@query(f"select geolevel, run_id, {SUM} from rolled group by all")
def sum_by(spark, d):
    return Q.sum_by(B.rolled(spark, d), ["geolevel", "run_id"])


@query("select geolevel, avg(priv) as avg_priv from rolled group by all", "avg_priv")
def avg_by(spark, d):
    return Q.avg_by(B.rolled(spark, d), ["geolevel"], "priv")


@query("select geocode, count(*) as population from persons group by all")
def sql_population_by_block(spark, d):
    return Q.sql_population_by_block(hist.hist_sparse(B.persons(spark, d), "geocode", ["age", "sex"]))


@query("select geocode, count(*) as population from persons where age >= 18 group by all")
def sql_voting_age_by_block(spark, d):
    return Q.sql_voting_age_by_block(hist.hist_sparse(B.persons(spark, d), "geocode", ["age", "sex"]))


@query("select substr(geocode, 1, 1) as state, substr(geocode, 2, 2) as county, age, sex, count(*) as population from persons group by all")
def sql_age_pyramid(spark, d):
    p = B.persons(spark, d).withColumns({"state": F.substring("geocode", 1, 1), "county": F.substring("geocode", 2, 2)})
    return Q.sql_age_pyramid(hist.hist_sparse(p, "state", ["county", "age", "sex"]), ["state", "county"])


# the dimension library on a large schema: persons by age group, sex and race group


@query("""select geocode, case when age < 4 then 'Aged 3 and under' end as age, case when sex = 0 then 'Male' else 'Female' end as sex, count(*) as cnt from persons where age < 4 group by all""", name="query_by_name_ages")
def _ages(spark, d):
    h = hist.hist_sparse(B.persons(spark, d), "geocode", ["age", "sex"])
    return Q.query_by_name(h, "under4 * sex", D.Schema((A.age(), A.sex())))


@query("""select geocode, case when r < 6 then '1 race' when r < 21 then '2 races' when r < 41 then '3 races' when r < 56 then '4 races' when r < 62 then '5 races' else '6 races' end as cenrace, count(*) as cnt from (select geocode, unit_id % 63 as r from persons) group by all""", name="query_by_name_races")
def _races(spark, d):
    h = hist.hist_sparse(B.persons(spark, d).withColumn("cenrace", F.col("unit_id") % 63), "geocode", ["cenrace"])
    return Q.query_by_name(h, "numraces", D.Schema((A.cenrace(),)))
