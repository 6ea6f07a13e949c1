"""Scalar recodes: all are column expressions, without joins or Python per row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import attributes as A
from ..functions.dims import UNMAPPED, recode_column
from ..functions.households import type_table


def recode_case(df: DataFrame, col: str, mapping: dict, default: str | None = UNMAPPED, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, recode_column(F.col(col), mapping, default))


def recode_levels_labels(df: DataFrame, col: str, levels: list[str], to_index: bool = False) -> DataFrame:
    if to_index:
        return df.withColumn(col, F.array_position(F.lit(list(levels)), F.col(col)).cast("int") - 1)
    return df.withColumn(col, F.get(F.lit(list(levels)), F.col(col).cast("int")))


def facility_class(code: Column) -> Column:
    """Facility type of a three-digit code: its hundreds, 7 at most; none for households."""
    return F.when(code.isNull() | (F.trim(code) == ""), 0).otherwise(F.least(F.floor(code.try_cast("int") / 100).cast("int"), F.lit(7)))


def facility_codes() -> dict[str, int]:
    """Three-digit facility code -> level of the relationship dimension."""
    first = len(A.RELATIONSHIPS)
    codes = {label.split(" ")[1]: first + i for i, label in enumerate(A.GROUP_QUARTERS)}
    return codes | {c: codes["997"] for c in A.OTHER_FACILITIES}


def relationship(rel: Column, facility: Column, size: Column) -> Column:
    """Level of the relationship dimension: householders by the size of their unit, other relationships by code, residents of facilities by facility."""
    code = F.create_map(*[F.lit(x) for kv in facility_codes().items() for x in kv])
    return F.when((rel == 20) & (size == 1), 0).when((rel == 20) & (size > 1), 1).when(rel.between(21, 36), rel - 19).when(rel.isin(37, 38), F.try_element_at(code, facility))


def _persons(df: DataFrame) -> dict[str, Column]:
    age, race = F.col("QAGE").try_cast("int"), F.col("CENRACE").try_cast("int")
    return {
        "sex": F.col("QSEX").try_cast("int") - 1, "age": F.when(age.between(0, 115), age), "votingage": F.when(age.between(0, 115), (age >= 18).cast("int")),
        "hispanic": F.col("CENHISP").try_cast("int") - 1, "hhgq": facility_class(F.col("QGQTYP")), "cenrace": F.when(race.between(1, 63), race - 1),
    }


def recode_input_person(df: DataFrame, units: DataFrame | None = None, key: str = "MAFID") -> DataFrame:
    """Schema indices of a person record; ``error`` names the fields whose code is illegal.

    units: (key, FINAL_POP), joined where the persons do not have FINAL_POP themselves.
    """
    df = df if units is None else df.join(units.select(key, "FINAL_POP"), key, "left")
    cols = _persons(df) | {"relgq": relationship(F.col("RELSHIP").try_cast("int"), F.col("QGQTYP"), F.col("FINAL_POP").try_cast("int"))}
    bad = F.concat_ws(",", *[F.when(c.isNull(), F.lit(n)) for n, c in cols.items()])
    return df.withColumns(cols | {"error": F.nullif(bad, F.lit(""))})


def recode_input_pl94(df: DataFrame) -> DataFrame:
    """Only facility, voting age, ethnicity and race."""
    cols = {k: v for k, v in _persons(df).items() if k in ("hhgq", "votingage", "hispanic", "cenrace")}
    return df.withColumns(cols)


def recode_input_unit(df: DataFrame) -> DataFrame:
    return df.withColumn("hhgq", facility_class(F.col("QGQTYP")))


#: Output column -> expression that gives the schema index back.
FROM_OUTPUT = {
    "hhgq": "cast(GQTYPE as int) div 100",
    "sex": "cast(QSEX as int) - 1",
    "age": "cast(QAGE as int)",
    "votingage": "case when cast(QAGE as int) >= 18 then 1 else 0 end",
    "hispanic": "cast(CENHISP as int) - 1",
    "cenrace": "cast(CENRACE as int) - 1",
    "citizen": "case when CITIZEN = '1' then 1 else 0 end",
    "relgq": "case when cast(GQTYPE as int) <> 0 then try_element_at(map(" + ", ".join(f"'{c}', {i}" for c, i in facility_codes().items()) + "), GQTYPE)"
    " when RELSHIP = '20' then case when LIVE_ALONE = '1' then 0 else 1 end else cast(RELSHIP as int) - 19 end",
}


def recode_from_output(df: DataFrame, columns: list[str], rules: dict[str, str] = FROM_OUTPUT) -> DataFrame:
    return df.withColumns({c: F.expr(rules[c]) for c in columns})


def recode_race_combination(df: DataFrame, flags: list[str]) -> DataFrame:
    """cenrace: place of the set of raised flags among the combinations (null if none is raised); numraces."""
    combos = A.race_combinations(tuple(flags))
    bits = reduce(lambda a, b: a + b, [F.col(f).cast("int") * (1 << i) for i, f in enumerate(flags)])
    place = {sum(1 << i for i in c): k for k, c in enumerate(combos)}
    table = F.lit([place.get(m, -1) for m in range(1 << len(flags))])
    return df.withColumns({"cenrace": F.nullif(F.get(table, bits), F.lit(-1)), "numraces": F.bit_count(bits)})


def recode_age_groups(df: DataFrame, col: str, groups: list[tuple[int, int, str]], out: str = "age_group") -> DataFrame:
    """groups: (first age, last age, label)"""
    c = F
    for lo, hi, label in groups:
        c = c.when(F.col(col).between(lo, hi), F.lit(label))
    return df.withColumn(out, c.otherwise(F.lit(UNMAPPED)))


def recode_household_type(df: DataFrame, col: str, predicates: dict[str, list[int] | dict[str, tuple[int, ...]]], default: str = UNMAPPED) -> DataFrame:
    """A column per recode: for a list of types a flag, for groups (label -> types, as a dimension's recodes) the label, or default outside them."""

    def one(of) -> Column:
        return recode_column(F.col(col), {i: g for g, ix in of.items() for i in ix}, default) if isinstance(of, dict) else F.col(col).isin(of).cast("int")

    return df.withColumns({name: one(of) for name, of in predicates.items()})


def recode_tenure_vacancy_gq(df: DataFrame, col: str, grouping: str, out: str = "group") -> DataFrame:
    groups = A.tenure_vacancy_gq().recodes[grouping]
    return recode_case(df, col, {i: g for g, ix in groups.items() for i in ix}, out=out)


def _select(df: DataFrame, layout: list[tuple[str, str]]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in layout])


#: Output layouts as (column, expression over schema indices); a state-out-of-scope field is filled with its own code.
PERSON_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MPD'"), ("SCHEMA_BUILD_ID", "'1.0'"), ("geocode", "geocode"), ("RTYPE", "case when hhgq = 0 then '3' else '5' end"),
    ("GQTYPE", "case when hhgq = 0 then '000' else concat(cast(hhgq as string), '01') end"), ("RELSHIP", "case when hhgq = 0 then cast(coalesce(rel, 0) + 20 as string) else '99' end"),
    ("QSEX", "cast(sex + 1 as string)"), ("QAGE", "age"), ("CENHISP", "cast(hispanic + 1 as string)"), ("CENRACE", "lpad(cast(cenrace + 1 as string), 2, '0')"), ("LIVE_ALONE", "'9'"),
]
#: The same for a schema with the relationship dimension: its first 18 levels are relationships, then facilities, institutional to level 32.
RELATIONSHIP_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MPD'"), ("SCHEMA_BUILD_ID", "'1.0'"), ("geocode", "geocode"), ("RTYPE", "case when relgq < 18 then '3' when relgq < 42 then '5' end"),
    ("GQTYPE", "case when relgq < 18 then '000' else try_element_at(array(" + ", ".join(f"'{g.split(' ')[1]}'" for g in A.GROUP_QUARTERS) + "), relgq - 17) end"),
    ("RELSHIP", "case when relgq < 2 then '20' when relgq < 18 then cast(relgq + 19 as string) when relgq < 33 then '37' when relgq < 42 then '38' end"),
    ("QSEX", "cast(sex + 1 as string)"), ("QAGE", "age"), ("CENHISP", "cast(hispanic + 1 as string)"), ("CENRACE", "lpad(cast(cenrace + 1 as string), 2, '0')"), ("LIVE_ALONE", "'9'"),
]
UNIT_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MUD'"), ("SCHEMA_BUILD_ID", "'1.0'"), ("geocode", "geocode"), ("RTYPE", "case when hhgq = 0 then '2' else '4' end"), ("GQTYPE", "case when hhgq = 0 then '000' else concat(cast(hhgq as string), '01') end"),
    ("TEN", "case when vacs > 0 then '0' else cast(ten + 1 as string) end"), ("VACS", "cast(vacs as string)"), ("HHSIZE", "case when vacs > 0 then 0 else hhsize end"), ("HHSEX", "cast(sex + 1 as string)"), ("P60", "case when elderly > 0 then 1 else 0 end"), ("P65", "case when elderly > 1 then 1 else 0 end"), ("P75", "case when elderly > 2 then 1 else 0 end"), ("MULTG", "cast(multi + 1 as string)"),
]

#: Occupied units of the schema with 24 household types. Which types are couples of which kind, have own children of which
#: ages, or are no families; codes of types without a couple differ by the householder's sex. What the schema cannot tell is 9.
_OWN = "hhtype in (0, 1, 2, 4, 5, 6, 8, 9, 10, 13, 14, 15, 19, 20, 21)"
_ALONE_BY_SEX = "lpad(cast(case when hhtype = 18 then 5 when hhtype < 22 then 6 when hhtype = 22 then 7 else 8 end + if(sex = 0, 4, 0) as string), 2, '0')"
HOUSEHOLD_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MUD'"), ("SCHEMA_BUILD_ID", "'1.0'"), ("geocode", "geocode"), ("RTYPE", "'2'"), ("GQTYPE", "'000'"), ("TEN", "'9'"), ("VACS", "'0'"), ("HHSIZE", "hhsize"),
    ("HHT", "case when hhtype < 8 then '1' when hhtype in (12, 17, 18, 23) then cast(4 + 2 * sex + if(hhsize = 1, 0, 1) as string) when hhtype < 24 then cast(2 + sex as string) else '0' end"),
    ("HHT2", f"case when hhtype < 8 then if({_OWN}, '01', '02') when hhtype < 18 then if({_OWN}, '03', '04') when hhtype < 24 then {_ALONE_BY_SEX} else '00' end"),
    ("CPLT", "case when hhtype < 4 then '1' when hhtype < 8 then '2' when hhtype < 13 then '3' when hhtype < 18 then '4' else '0' end"),
    ("UPART", "case when hhtype between 13 and 17 then if(sex = 0, '1', '3') when hhtype between 8 and 12 then if(sex = 0, '2', '4') else '5' end"),
    ("MULTG", "case when hhsize < 3 then '0' else cast(multi + 1 as string) end"), ("HHLDRAGE", "hhage + 1"), ("HHSPAN", "cast(hispanic + 1 as string)"), ("HHRACE", "concat('0', cast(hhrace + 1 as string))"),
    ("PAOC", "case when hhtype in (0, 4, 8, 13, 19) then '1' when hhtype in (1, 5, 9, 14, 20) then '2' when hhtype in (2, 6, 10, 15, 21) then '3' else '4' end"),
    ("P18", "9"), ("P60", "if(elderly > 0, 1, 0)"), ("P65", "if(elderly > 1, 1, 0)"), ("P75", "if(elderly > 2, 1, 0)"), ("PAC", "'9'"), ("HHSEX", "cast(sex + 1 as string)"),
]


#: The output's codes. Occupied units of the largest household schema, as expressions over its indices and what the type says (see `type_table`).
LARGEST_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MUD'"), ("SCHEMA_BUILD_ID", "'1.1.0'"), ("geocode", "geocode"), ("RTYPE", "'2'"), ("GQTYPE", "'000'"), ("TEN", "if(hhtenshort = 0, '1', '3')"), ("VACS", "'0'"), ("HHSIZE", "cast(size as string)"),
    ("HHT", "case when couple = 'married' then '1' when relatives then cast(2 + sex as string) else cast(4 + 2 * sex + if(alone, 0, 1) as string) end"),
    ("HHT2", "lpad(cast(case couple when 'married' then if(own <> '', 1, 2) when 'cohabiting' then if(own <> '', 3, 4) else case when alone then 5 when own <> '' then 6 when relatives then 7 else 8 end + if(sex = 0, 4, 0) end as string), 2, '0')"),
    ("CPLT", "case when alone then '0' when couple = '' then '5' else cast(if(couple = 'married', 1, 3) + if(sexes = 'same-sex', 1, 0) as string) end"),
    ("UPART", "case when alone then '0' when couple <> 'cohabiting' then '5' else cast(1 + 2 * sex + if(sexes = 'same-sex', 0, 1) as string) end"),
    ("MULTG", "case when size <= 2 then '0' when multi then '2' else '1' end"), ("HHLDRAGE", "cast(hhage + 1 as string)"), ("HHSPAN", "cast(hispanic + 1 as string)"), ("HHRACE", "concat('0', cast(hhrace + 1 as string))"),
    ("PAOC", "case own when 'under6' then '1' when '6to17' then '2' when 'both' then '3' else '4' end"), ("P18", "if(minor, '1', '0')"), ("P60", "if(elderly >= 1, '1', '0')"), ("P65", "if(elderly >= 2, '1', '0')"), ("P75", "if(elderly >= 3, '1', '0')"),
    ("PAC", "case child when 'under6' then '1' when '6to17' then '2' when 'both' then '3' else '4' end"), ("HHSEX", "cast(sex + 1 as string)"),
]
#: Vacant units and group quarters of that schema: what only households have is 0.
LARGEST_UNIT_LAYOUT = [
    ("SCHEMA_TYPE_CODE", "'MUD'"), ("SCHEMA_BUILD_ID", "'1.1.0'"), ("geocode", "geocode"), ("RTYPE", "if(tenvacgq <= 10, '2', '4')"),
    ("GQTYPE", "case when tenvacgq <= 10 then '000' else element_at(array(" + ", ".join(f"'{g.split(' ')[1]}'" for g in A.GROUP_QUARTERS) + "), tenvacgq - 10) end"),
    ("TEN", "'0'"), ("VACS", "if(tenvacgq between 4 and 10, cast(tenvacgq - 3 as string), '0')"), *[(c, "'00'" if c in ("HHT2", "HHRACE") else "'0'") for c in ("HHSIZE", "HHT", "HHT2", "CPLT", "UPART", "MULTG", "HHLDRAGE", "HHSPAN", "HHRACE", "PAOC", "P18", "P60", "P65", "P75", "PAC", "HHSEX")],
]


def recode_output_largest(df: DataFrame, col: str = "hhtype_dhch") -> DataFrame:
    """Households of the largest schema in output form; an index without a type stops the job."""
    types = type_table(df.sparkSession).withColumnRenamed("hhtype", "_type")
    known = df.join(F.broadcast(types), F.col(col) == F.col("_type"), "left")  # a fixed table of 522 rows
    checked = known.withColumn("size", F.when(F.col("_type").isNotNull(), F.col("size")).otherwise(F.raise_error(F.lit("no such household type")).cast("int")))
    return _select(checked, LARGEST_LAYOUT)


def recode_output_person(df: DataFrame, layout: list[tuple[str, str]] = PERSON_LAYOUT) -> DataFrame:
    return _select(df, layout)


def recode_output_unit(df: DataFrame, layout: list[tuple[str, str]] = UNIT_LAYOUT) -> DataFrame:
    return _select(df, layout)


def recode_output_citizen_race(df: DataFrame) -> DataFrame:
    """Race and ethnicity of citizens of voting age, 1 to 12: Hispanic, a race alone, one of four pairs, or the rest."""
    pairs = {(0, 1): 8, (0, 2): 9, (0, 3): 10, (1, 2): 11}  # by places of the races
    code = [n + 2 if len(c) == 1 else pairs.get(tuple(sorted(c)), 12) for c in A.race_combinations(A.RACES) for n in c[:1]]
    race = F.when(F.col("hispanic") == 1, 1).otherwise(F.get(F.lit(code), F.col("cenrace")))
    return df.withColumn("CVAPRACE", F.when((F.col("citizen") == 1) & (F.col("votingage") == 1), race))


def geo_split_padded(df: DataFrame, geocode: str, widths: list[tuple[str, int]]) -> DataFrame:
    """Parts of a geocode; digits that it does not have are X."""
    out, at = {}, 1
    for name, w in widths:
        out[name] = F.rpad(F.substring(geocode, at, w), w, "X")
        at += w
    return df.withColumns(out)


def merge_dims_to_level(df: DataFrame, dims: list[str], sep: str = " BY ", out: str = "level") -> DataFrame:
    return df.withColumn(out, F.concat_ws(sep, *dims) if dims else F.lit("total")).drop(*dims)


def flat_index(df: DataFrame, dims: list[str], shape: list[int], out: str = "cell") -> DataFrame:
    """Row-major index of the cell."""
    at = F.lit(0).cast("long")
    for d, n in zip(dims, shape, strict=True):
        at = at * n + F.col(d).cast("long")
    return df.withColumn(out, at)


def unflat_index(df: DataFrame, dims: list[str], shape: list[int], col: str = "cell") -> DataFrame:
    out, below = {}, 1
    for d, n in reversed(list(zip(dims, shape, strict=True))):
        out[d] = (F.floor(F.col(col) / below) % n).cast("int")
        below *= n
    return df.withColumns(dict(reversed(out.items())))


def bin_counts(df: DataFrame, col: str, bins: list[int], out: str = "bin") -> DataFrame:
    """``[a-b)`` with lower ends included, ``z +`` from the last; values below the first go to the first."""
    c = F
    for a, b in zip(bins, bins[1:], strict=False):
        c = c.when(F.col(col) < b, F.lit(f"[{a}-{b})"))
    return df.withColumn(out, c.otherwise(F.lit(f"{bins[-1]} +")) if len(bins) > 1 else F.lit(f"{bins[-1]} +"))


def bin_sql(df: DataFrame, col: str, bins: list[int], out: str = "bin") -> DataFrame:
    x = F.col(col)
    c = F.when(x.isNull() | F.isnan(x.cast("double")), "NaN").when(x < bins[0], f"(-Inf, {bins[0]})")
    for a, b in zip(bins, bins[1:], strict=False):
        c = c.when(x < b, F.lit(f"[{a}, {b})"))
    return df.withColumn(out, c.otherwise(F.lit(f"[{bins[-1]}, +Inf)")))


def bin_power10(df: DataFrame, col: str, out: str = "bin") -> DataFrame:
    """0, 1, 10, 100, ...: the decimal magnitude of a count, by its number of digits."""
    n = F.length(F.col(col).cast("long").cast("string"))
    return df.withColumn(out, F.when(F.col(col) < 1, 0).otherwise(F.concat(F.lit("1"), F.repeat(F.lit("0"), n - 1)).cast("long")).cast("long"))


def bin_digitize(df: DataFrame, col: str, starts: list[int], out: str = "bin") -> DataFrame:
    """How many starts are at or below the value."""
    return df.withColumn(out, reduce(lambda a, b: a + b, [(F.col(col) >= s).cast("int") for s in starts]))
