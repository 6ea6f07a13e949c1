"""Whole sets of published tables by marginal lattice."""

from __future__ import annotations

from itertools import product

from pyspark.sql import functions as F

from ..functions import tables as TB
from ..functions.dims import Schema
from ..operators import lattice
from . import base as B
from .base import case_sql, query

_UNIT = {
    "hhsex": "unit_id % 2", "hhage": "unit_id % 9", "hisp": "(unit_id div 2) % 2", "hhrace": "unit_id % 7", "hhsize": "unit_id % 8", "hhtype": "(unit_id div 8 + priority) % 24", "elderly": "(unit_id div 3 + priority) % 4", "multi": "(unit_id div 5) % 2", "rent": "status % 2",
}
_PERSON = {"hhgq": "(unit_id div 3 + l_linenumber) % 8", "sex": "sex", "age": "(unit_id * 7 + age) % 116", "hispanic": "(unit_id div 2) % 2", "cenrace": "(unit_id + l_linenumber * 11) % 63"}


def _sql(tables: dict[str, list[str]], schema: Schema, dims: dict[str, str], source: str) -> str:
    """Every query on its own, from the records."""
    parts = []
    for name in dict.fromkeys(q for qs in tables.values() for q in qs):
        sides = []
        for d, groups in schema.parse(name):
            layers: list[dict] = []  # of groups that do not overlap
            for k, v in groups.items():
                at = next((x for x in layers if not any(set(v) & set(w) for w in x.values())), None)
                layers.append({k: v}) if at is None else at.update({k: v})
            sides.append([case_sql(d.name, x) for x in layers])
        parts += [f"select geocode, '{name}' as query, {' || chr(32) || '.join(' || '.join([x]) for x in _between(pick)) or "'total'"} as level from r" for pick in product(*sides)]
    names = ", ".join(f"('{t}', '{q}')" for t, qs in tables.items() for q in dict.fromkeys(qs))
    cols = ", ".join(f"({e.replace(' div ', ' // ')})::int as {c}" for c, e in dims.items())
    return f"select table_name, geocode, query, level, cnt from (with r as materialized (select substr(geocode, 1, 3) as geocode, {cols} from {source}), t(table_name, query) as (values {names}) select table_name, geocode, query, level, count(*) as cnt from t join ({' union all '.join(parts)}) using (query) where level is not null group by all)"


def _between(parts) -> list[str]:
    return [x for p in parts for x in ("'BY'", p)][1:]


def _set(df, tables, schema, dims):
    cells = df.select(F.substring("geocode", 1, 3).alias("geocode"), *[F.expr(e).cast("int").alias(c) for c, e in dims.items()]).groupBy("geocode", *schema.names).agg(F.count(F.lit(1)).alias("cnt"))
    return lattice.table_set(cells, tables, schema, ["geocode"], ("cnt",))


@query(_sql(TB.HOUSEHOLDS, TB.households(), _UNIT, "units"))
def table_set_households(spark, d):
    return _set(B.units(spark, d), TB.HOUSEHOLDS, TB.households(), _UNIT)


@query(_sql(TB.PERSONS, TB.persons(), _PERSON, "persons"))
def table_set_persons(spark, d):
    return _set(B.persons(spark, d), TB.PERSONS, TB.persons(), _PERSON)
