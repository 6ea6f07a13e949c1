"""Histogram schemas: dimensions with labelled levels, named recodes, and queries by name.

A recode maps levels of one dimension to groups; a query name such as ``"status * urgent"`` crosses
dimensions and recodes of different dimensions. Both become plain tables (``dim_levels``, ``recode_map``)
or column expressions, so that any attribute is data and the operators stay the same.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import product
from math import prod

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UNMAPPED = "-1"


@dataclass(frozen=True)
class Dim:
    """A dimension: its levels' labels, and recodes as {name: {group label: level indices}}."""

    name: str
    labels: tuple[str, ...]
    recodes: dict[str, dict[str, tuple[int, ...]]] = field(default_factory=dict)

    @property
    def size(self) -> int:
        return len(self.labels)


@dataclass(frozen=True)
class Schema:
    dims: tuple[Dim, ...]

    @property
    def names(self) -> list[str]:
        return [d.name for d in self.dims]

    @property
    def shape(self) -> list[int]:
        return [d.size for d in self.dims]

    @property
    def size(self) -> int:
        return prod(self.shape)

    def find(self, term: str) -> tuple[Dim, dict[str, tuple[int, ...]] | None]:
        """The dimension behind a term, with the recode's groups if the term names a recode."""
        for d in self.dims:
            if term == d.name:
                return d, None
            if term in d.recodes:
                return d, d.recodes[term]
        raise KeyError(f"no dimension or recode named {term!r}")

    def parse(self, name: str) -> list[tuple[Dim, dict[str, tuple[int, ...]]]]:
        """(dimension, groups) of every term of a query name; dimensions must not overlap."""
        if name in ("total", ""):
            return []
        terms = self.names if name == "detailed" else [t.strip() for t in name.split("*")]
        out = []
        for t in terms:
            d, groups = self.find(t)
            if any(d is e for e, _ in out):
                raise ValueError(f"{name!r} uses dimension {d.name!r} twice")
            out.append((d, groups or {label: (i,) for i, label in enumerate(d.labels)}))
        return sorted(out, key=lambda x: self.names.index(x[0].name))

    def levels(self, name: str) -> list[str]:
        """All level labels of a query, in order."""
        return [" BY ".join(parts) or "total" for parts in product(*[groups for _, groups in self.parse(name)])]

    def level(self, name: str) -> Column | None:
        """Label of the row's level in the query's answer, null where a dimension is not mapped."""
        parts = [recode_column(F.col(d.name), {i: g for g, ix in groups.items() for i in ix}) for d, groups in self.parse(name)]
        if not parts:
            return F.lit("total")
        bad = parts[0] == UNMAPPED
        for p in parts[1:]:
            bad = bad | (p == UNMAPPED)
        return F.when(~bad, F.concat_ws(" BY ", *parts))


def recode_column(col: Column, mapping: dict, default: str | None = UNMAPPED) -> Column:
    """A small mapping as a CASE expression: stays inside generated code."""
    out = F
    groups: dict = {}
    for k, v in mapping.items():
        groups.setdefault(v, []).append(k)
    for v, ks in groups.items():
        test = col == ks[0] if len(ks) == 1 else col.isin(ks)
        out = out.when(test, F.lit(v))
    return out.otherwise(F.lit(default)) if groups else F.lit(default)


def dim_levels(spark: SparkSession, schema: Schema) -> DataFrame:
    """(dim, idx, label)"""
    return spark.createDataFrame([(d.name, i, label) for d in schema.dims for i, label in enumerate(d.labels)], "dim string, idx int, label string")


def recode_map(spark: SparkSession, schema: Schema, names: list[str]) -> DataFrame:
    """(query, dim, idx, group_idx, label) of the named queries."""
    rows = [(q, d.name, i, g, label) for q in names for d, groups in schema.parse(q) for g, (label, ix) in enumerate(groups.items()) for i in ix]
    return spark.createDataFrame(rows, "query string, dim string, idx int, group_idx int, label string")


def query_levels(spark: SparkSession, name: str, schema: Schema) -> DataFrame:
    """Every level label of a query, crossed with " BY "."""
    out = spark.range(1).select(F.array().cast("array<string>").alias("parts"))
    for _, groups in schema.parse(name):
        out = out.select(F.explode(F.transform(F.lit(list(groups)), lambda g: F.array_append("parts", g))).alias("parts"))
    return out.select(F.when(F.size("parts") == 0, "total").otherwise(F.array_join("parts", " BY ")).alias("level"))
