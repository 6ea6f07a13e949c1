"""Frames that the registered queries share, as DataFrames and as the same SQL.

Orders stand for housing units, their line items for persons, customers' places for blocks: geocode = region
(1 digit), nation (2), customer number modulo 20 (2).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import Dim, Schema
from ..operators import hist as H
from ..operators import query as Q

HIER = [("Region", 1), ("Nation", 3), ("Block", 5)]
STATUS = Dim("status", ("Filled", "Open", "Pending"), {"closed": {"Closed": (0,)}, "closed2": {"Closed": (0,), "Not closed": (1, 2)}})
PRIORITY = Dim("priority", ("Urgent", "High", "Medium", "None", "Low"), {"pressing": {"Pressing": (0, 1), "Other": (2, 3, 4)}, "pressingOnly": {"Pressing": (0, 1)}})
SCHEMA = Schema((STATUS, PRIORITY))
NAMES = ["total", "status", "pressing", "status * priority"]
KEYS = ["geolevel", "geocode", "run_id", "plb"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), 6) + F.lit(0.0) for c, kind in df.dtypes if kind == "double"})


def query(sql: str | None = None, doubles: str = "", name: str | None = None):
    """Register a function of (spark, folder); its double columns, named in ``doubles``, are rounded to 6 digits."""

    def put(f):
        key = name or f.__name__
        QUERIES[key] = lambda spark, d: rounded(f(spark, d))
        if sql is not None:
            s = WITH + sql.strip()
            if doubles:
                s = f"select * replace ({', '.join(f'round({c}, 6) + 0.0 as {c}' for c in doubles.split())}) from ({s})"
            SQL[key] = s
        return f

    return put


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def customers(spark: SparkSession, d: str) -> DataFrame:
    """(c_custkey, geocode parts, geocode, segment, c_acctbal)"""
    c, n, r = table(spark, d, "customer"), table(spark, d, "nation"), table(spark, d, "region")
    j = c.join(n, c.c_nationkey == n.n_nationkey).join(r, n.n_regionkey == r.r_regionkey)
    parts = {"region": F.col("r_regionkey").cast("string"), "nation": F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), "bucket": F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0")}
    return j.withColumns(parts).select("c_custkey", "region", "nation", "bucket", F.concat("region", "nation", "bucket").alias("geocode"), F.col("c_mktsegment").alias("segment"), "c_acctbal")


def units(spark: SparkSession, d: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2)
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit_id"), "o_custkey", status.alias("status"), (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("priority"), F.col("o_totalprice").alias("price"))
    return o.join(customers(spark, d), F.col("o_custkey") == F.col("c_custkey")).drop("c_custkey", "o_custkey", "c_acctbal")


def persons(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit_id"), "l_linenumber", F.col("l_quantity").cast("int").alias("age"), F.when(F.col("l_returnflag") == "A", 0).otherwise(1).alias("sex"))
    return li.join(units(spark, d).select("unit_id", "geocode", "status", "priority"), "unit_id")


def moved(spark: SparkSession, d: str) -> DataFrame:
    """The output's copy of the units: another priority where unit_id % 97 = 0."""
    return units(spark, d).withColumn("priority", F.when(F.col("unit_id") % 97 == 0, (F.col("priority") + 1) % 5).otherwise(F.col("priority")))


def hist(spark: SparkSession, d: str) -> DataFrame:
    return H.hist_sparse(units(spark, d), "geocode", ["status", "priority"])


def analysis(spark: SparkSession, d: str) -> DataFrame:
    """True and protected counts of three runs; the protected ones come from an integer hash."""
    run = F.explode(F.sequence(F.lit(0), F.lit(2)))
    h = hist(spark, d).withColumn("_run", run)
    key = F.col("geocode").cast("long") * 15 + F.col("status") * 5 + F.col("priority") + F.col("_run") * 7919
    priv = F.greatest(F.lit(0), F.col("cnt") + (key * 1103515245 + 12345) % 2147483648 % 5 - 2)
    return h.select("geocode", F.concat(F.lit("run_"), "_run").alias("run_id"), F.lit("1.0").alias("plb"), F.lit("td1").alias("budget_group"), "status", "priority", F.col("cnt").alias("orig"), priv.cast("long").alias("priv"))


def rolled(spark: SparkSession, d: str) -> DataFrame:
    return H.geo_rollup_any(analysis(spark, d), HIER, [], ["run_id", "plb", "status", "priority"])


def answers(spark: SparkSession, d: str) -> DataFrame:
    return Q.query_answer_many(rolled(spark, d), NAMES, SCHEMA, KEYS)


def xwalk(spark: SparkSession, d: str) -> DataFrame:
    """(geocode, segment): the off-spine area of a block is its commonest segment; one block in seven has none."""
    c = customers(spark, d).groupBy("geocode", "segment").agg(F.count(F.lit(1)).alias("n"))
    best = c.groupBy("geocode").agg(F.min(F.struct(-F.col("n"), F.col("segment"))).alias("x")).select("geocode", F.col("x.segment").alias("segment"))
    return best.withColumn("segment", F.when(F.col("geocode").cast("long") % 7 == 0, "99999").otherwise(F.col("segment")))


def case_sql(col: str, groups: dict[str, tuple[int, ...]]) -> str:
    """A dimension's groups as SQL; null outside them."""
    of = lambda label: label.replace("'", "''")
    return f"case {' '.join(f"when {col} in ({', '.join(map(str, ix))}) then '{of(label)}'" for label, ix in groups.items())} end"


def label_sql(schema: Schema, name: str) -> str:
    """A query's level as SQL, for groups that do not overlap."""
    return " || ' BY ' || ".join(case_sql(d.name, groups) for d, groups in schema.parse(name)) or "'total'"


ST = "case status when 0 then 'Filled' when 1 then 'Open' else 'Pending' end"
PR = "case priority when 0 then 'Urgent' when 1 then 'High' when 2 then 'Medium' when 3 then 'None' else 'Low' end"
PS = "case when priority < 2 then 'Pressing' else 'Other' end"
SUM = "sum(orig)::bigint as orig, sum(priv)::bigint as priv"
#: Budget of every level, and of its queries: level's share, then query's.
ALLOC = [
    ("Region", "total", 1, 2, 1, 8), ("Region", "status", 1, 2, 3, 8), ("Region", "pressing", 1, 2, 1, 4), ("Region", "status * priority", 1, 2, 1, 4),
    ("Nation", "total", 1, 4, 1, 4), ("Nation", "status", 1, 4, 1, 4), ("Nation", "pressing", 1, 4, 1, 4), ("Nation", "status * priority", 1, 4, 1, 4),
    ("Block", "total", 1, 4, 1, 3), ("Block", "status", 1, 4, 1, 3), ("Block", "pressing", 1, 4, 1, 6), ("Block", "status * priority", 1, 4, 1, 6),
]
WITH = f"""
with customers as (select c_custkey, r_regionkey::varchar as region, lpad(n_nationkey::varchar, 2, '0') as nation, lpad((c_custkey % 20)::varchar, 2, '0') as bucket,
    r_regionkey::varchar || lpad(n_nationkey::varchar, 2, '0') || lpad((c_custkey % 20)::varchar, 2, '0') as geocode, c_mktsegment as segment, c_acctbal
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
units as (select o_orderkey as unit_id, case o_orderstatus when 'F' then 0 when 'O' then 1 else 2 end as status, substr(o_orderpriority, 1, 1)::int - 1 as priority, o_totalprice as price,
    region, nation, bucket, geocode, segment from orders join customers on o_custkey = c_custkey),
persons as (select unit_id, l_linenumber, l_quantity::int as age, case when l_returnflag = 'A' then 0 else 1 end as sex, geocode, status, priority from lineitem join units on l_orderkey = unit_id),
moved as (select * replace (case when unit_id % 97 = 0 then (priority + 1) % 5 else priority end as priority) from units),
hist as (select geocode, status, priority, count(*) as cnt from units group by all),
analysis as materialized (select geocode, 'run_' || run as run_id, '1.0' as plb, 'td1' as budget_group, status, priority, cnt as orig,
    greatest(0, cnt + ((geocode::bigint * 15 + status * 5 + priority + 7919 * run) * 1103515245 + 12345) % 2147483648 % 5 - 2)::bigint as priv
  from hist, (select unnest([0, 1, 2]) as run)),
rolled as materialized (select 'Region' as geolevel, substr(geocode, 1, 1) as geocode, run_id, plb, status, priority, {SUM} from analysis group by all
  union all select 'Nation', substr(geocode, 1, 3), run_id, plb, status, priority, {SUM} from analysis group by all
  union all select 'Block', geocode, run_id, plb, status, priority, {SUM} from analysis group by all),
answers as materialized (select geolevel, geocode, run_id, plb, 'total' as query, 'total' as level, {SUM} from rolled group by all
  union all select geolevel, geocode, run_id, plb, 'status', {ST}, {SUM} from rolled group by all
  union all select geolevel, geocode, run_id, plb, 'pressing', {PS}, {SUM} from rolled group by all
  union all select geolevel, geocode, run_id, plb, 'status * priority', {ST} || ' BY ' || {PR}, {SUM} from rolled group by all),
xwalk as (select geocode, case when geocode::bigint % 7 = 0 then '99999' else segment end as segment from
  (select geocode, segment, row_number() over (partition by geocode order by count(*) desc, segment) as k from customers group by geocode, segment) where k = 1),
alloc(geolevel, query, geo_num, geo_den, q_num, q_den) as (values {', '.join(map(str, ALLOC))})
"""


def alloc(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ALLOC, "geolevel string, query string, geo_num long, geo_den long, q_num long, q_den long")
