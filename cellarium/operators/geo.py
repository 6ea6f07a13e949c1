"""Geography: prefixes, off-spine areas, spine keys and budget along the hierarchy.

``hier`` is a list of (level, prefix length), from the root down; length 0 is the whole country.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

Hier = list[tuple[str, int]]


def geo_trunk_columns(df: DataFrame, hier: Hier, geocode: str = "geocode") -> DataFrame:
    return df.withColumns({level: F.substring(geocode, 1, n) if n else F.lit("0") for level, n in hier})


def geo_parent(df: DataFrame, hier: Hier, geocode: str = "geocode") -> DataFrame:
    """geolevel by the code's length, and parent_geocode (null at the root)."""
    level, parent = F, F
    for k, (name, n) in enumerate(hier):
        level = level.when(F.length(geocode) == n, F.lit(name))
        parent = parent.when(F.length(geocode) == n, F.substring(geocode, 1, hier[k - 1][1]) if k else F.lit(None))
    return df.withColumns({"geolevel": level, "parent_geocode": parent})


#: Off-spine area -> the columns whose codes make its id unique.
AREAS = {
    "SLDU": ["STATE", "SLDU"], "SLDL": ["STATE", "SLDL"], "CD": ["STATE", "CD"], "SDELM": ["STATE", "SDELM"], "SDSEC": ["STATE", "SDSEC"], "SDUNI": ["STATE", "SDUNI"], "UA": ["UA"], "UGA": ["STATE", "UGA"], "PUMA": ["STATE", "PUMA"],
    "PLACE": ["STATE", "PLACE"], "COUSUB": ["STATE", "COUNTY", "COUSUB"], "SUBMCD": ["STATE", "COUNTY", "COUSUB", "SUBMCD"], "VTD": ["STATE", "COUNTY", "VTD"], "COUNTY_NSMCD": ["STATE", "COUNTY"],
}


def geo_crosswalk(xwalk: DataFrame, columns: dict[str, list[str]] = AREAS, geocode: str = "geocode") -> DataFrame:
    """(geocode, an id for each area type)."""
    return xwalk.select(geocode, *[F.concat(*parts).alias(name) for name, parts in columns.items()])


def geo_area_class(df: DataFrame, ranges: DataFrame, classes: list[str] | None = None, code: str = "code") -> DataFrame:
    """df with the class of the code range (lo, hi, class) it lies in, and whether that is one of ``classes``."""
    out = df.join(F.broadcast(ranges), F.col(code).between(F.col("lo"), F.col("hi")), "left").drop("lo", "hi")  # a few dozen ranges
    return out if classes is None else out.withColumn("in_class", F.coalesce(F.col("class").isin(classes), F.lit(False)))


def geo_off_spine_entity(df: DataFrame, strong_states: list[str], state: str = "STATE", mcd: str = "COUSUB", place: str = "PLACE", tribal: str = "tribal") -> DataFrame:
    """The minor civil division in states where these govern, outside tribal areas; else the place."""
    return df.withColumn("entity", F.when(F.col(state).isin(strong_states) & ~F.coalesce(F.col(tribal), F.lit(False)), F.concat(F.lit("M"), F.col(mcd))).otherwise(F.concat(F.lit("P"), F.col(place))))


def geo_spine_key(ref: DataFrame, ranges: DataFrame, classes: list[str], parts: list[str], area: str) -> DataFrame:
    """spine: 1, state, area, rest in tribal areas; 0 and the plain code elsewhere. parts = state, county, rest..."""
    got = geo_area_class(ref, ranges, classes, area)
    inside = F.concat(F.lit("1"), parts[0], area, *parts[1:])
    return got.withColumn("spine", F.when(F.col("in_class"), inside).otherwise(F.concat(F.lit("0"), parts[0], *parts[1:]))).drop("class", "in_class")


def geo_spine_remap(df: DataFrame, mapping: DataFrame, back: bool = False) -> DataFrame:
    """geocode -> spine code by mapping (geocode, spine), or back."""
    a, b = ("spine", "geocode") if back else ("geocode", "spine")
    m = mapping.select(F.col(a).alias("_from"), F.col(b).alias("_to"))
    return df.join(m, df["geocode"] == m["_from"], "left").withColumn("geocode", F.coalesce("_to", "geocode")).drop("_from", "_to")


def geo_pad_widths(df: DataFrame, segments: list[str]) -> DataFrame:
    """Every segment zero-padded to the widest of its level; one row of widths comes to the driver."""
    widest = df.agg(*[F.max(F.length(s)).alias(s) for s in segments]).first()
    return df.withColumns({s: F.lpad(F.col(s), widest[s] or 0, "0") for s in segments})


def geo_dense_child_ids(df: DataFrame, parent: str, order: list[str], width: int = 4) -> DataFrame:
    """Consecutive child numbers in every parent."""
    return df.withColumn("child_id", F.lpad((F.row_number().over(Window.partitionBy(parent).orderBy(*order)) - 1).cast("string"), width, "0"))


def geo_gq_signature(df: DataFrame, type_cols: list[str]) -> DataFrame:
    return df.withColumn("signature", F.concat(*[F.when(F.col(c) > 0, "1").otherwise("0") for c in type_cols]))


def geo_group_same_entities(blocks: DataFrame, parent: str, unit: str, entity: str) -> DataFrame:
    """Units of a parent with the same set of entities share a group number."""
    sets = blocks.groupBy(parent, unit).agg(F.array_join(F.sort_array(F.collect_set(entity)), ",").alias("entities"))
    return sets.withColumn("group_no", F.dense_rank().over(Window.partitionBy(parent).orderBy("entities")))


def geo_entity_distance(blocks: DataFrame, hier: Hier, entity: str, geocode: str = "geocode", absent: bool = True) -> DataFrame:
    """(geolevel, geocode, entity, distance): fewest units to add and take away, from the blocks up; entities of the same root with no block in a unit are at 0 there.

    A block is at distance 1 from nothing and 0 from its own entity; above, a part is reached by taking in the children's parts or by
    taking all and giving back what is outside: min(sum inside, sum outside + 1). An entity without blocks in a unit costs 0
    from nothing and 1 (take the unit away) from the whole, whatever the unit, so only pairs that occur are worked on
    and a unit's children without the entity enter as their number. absent=False leaves the rows of 0 out; else they are added at the end.
    """
    own = blocks.select(F.col(geocode).alias("g"), F.col(entity).alias("e")).distinct()
    now = own.select("g", "e", F.lit(1).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    units = own.select("g").distinct()
    out = []
    for level, n in reversed(hier[:-1]):
        up = F.substring("g", 1, n)
        kids = units.groupBy(up.alias("g")).agg(F.count(F.lit(1)).alias("kids"))
        sums = now.groupBy(up.alias("g"), "e").agg(F.sum("a").alias("sa"), F.sum("b").alias("sb"), F.count(F.lit(1)).alias("with")).join(kids, "g")
        outside = F.col("sb") + F.col("kids") - F.col("with")
        now = sums.select("g", "e", F.least("sa", outside + 1).alias("a"), F.least(outside, F.col("sa") + 1).alias("b"))
        units = kids.select("g")
        out.append(now.select(F.lit(level).alias("geolevel"), F.col("g").alias("geocode"), F.col("e").alias("entity"), F.col("a").alias("distance")))
    near = reduce(DataFrame.unionByName, out)
    if not absent:
        return near
    root = F.substring("geocode", 1, hier[0][1]).alias("root")
    named = near.select(root, "entity").distinct()
    every = near.select("geolevel", "geocode", root).distinct().join(named, "root").drop("root")
    return every.join(near, ["geolevel", "geocode", "entity"], "left").withColumn("distance", F.coalesce("distance", F.lit(0)))


def geo_bypass_single_child(alloc: DataFrame, hier: Hier) -> DataFrame:
    """alloc (geolevel, geocode, share): an only child's share moves to its parent, from the leaves up."""
    df = alloc
    for (level, n), (below, _) in zip(reversed(hier[:-1]), reversed(hier[1:]), strict=True):
        kids = df.filter(F.col("geolevel") == below).groupBy(F.substring("geocode", 1, n).alias("geocode")).agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("s"))
        lone = kids.filter("n = 1").select("geocode", "s")
        up = lone.select(F.lit(level).alias("geolevel"), "geocode", F.col("s").alias("_add"))
        down = lone.select(F.lit(below).alias("geolevel"), F.col("geocode").alias("_p"), F.lit(True).alias("_zero"))
        df = df.join(up, ["geolevel", "geocode"], "left").withColumn("share", F.col("share") + F.coalesce("_add", F.lit(0))).drop("_add")
        df = df.withColumn("_p", F.substring("geocode", 1, n)).join(down, ["geolevel", "_p"], "left").withColumn("share", F.when(F.col("_zero"), 0).otherwise(F.col("share"))).drop("_p", "_zero")
    return df


def prefixes(geocode: Column, hier: Hier) -> Column:
    """Array of (geolevel, geocode) of a code's ancestors and itself."""
    return F.array(*[F.struct(F.lit(level).alias("geolevel"), (F.substring(geocode, 1, n) if n else F.lit("0")).alias("geocode")) for level, n in hier])


def geo_check_path_budget(alloc: DataFrame, hier: Hier, total: float, tol: float = 1e-9) -> DataFrame:
    """Leaves whose path from the root does not sum to the total."""
    leaves = alloc.filter(F.col("geolevel") == hier[-1][0]).select(F.col("geocode").alias("leaf"))
    path = leaves.select("leaf", F.explode(prefixes(F.col("leaf"), hier)).alias("x")).select("leaf", "x.geolevel", "x.geocode")
    return path.join(alloc, ["geolevel", "geocode"], "left").groupBy("leaf").agg(F.sum("share").alias("spent")).filter(F.abs(F.coalesce("spent", F.lit(0)) - total) > tol)
