"""Hundreds of queries from a lattice of marginals.

A marginal groups the levels of every dimension; it follows from any marginal with finer groups. `plan` looks, for each
query, for the smallest marginal that it follows from, and adds common refinements of queries as steps in between where they save more
rows than they cost. `answer` sums the steps layer by layer: a row is spread over the few marginals that follow from its own, not
over all queries, so the spread is bounded by the lattice. Steps, groups and labels are small tables beside the data (a
row per query), joined by number, so no expression grows with the number of queries.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from itertools import combinations, product
from math import prod

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dims import Schema
from ..sources.files import written

#: A further step must save this share of all rows that are spread; marginals of so many rows are as good as smaller ones.
WORTH, SMALL = 0.005, 512
Groups = tuple[int, ...]  # of every level of a dimension its group, -1: left out


@dataclass
class Plan:
    """nodes: groups of every dimension; the first is the histogram itself. parent: of every node. queries: (node, name, labels by dimension)."""

    nodes: list[tuple[Groups, ...]]
    parent: list[int] = field(default_factory=list)
    queries: list[tuple[int, str, list[list[str] | None]]] = field(default_factory=list)

    def size(self, node: int) -> int:
        return prod(max(g) + 1 for g in self.nodes[node])

    def depth(self, node: int) -> int:
        return 0 if node == 0 else 1 + self.depth(self.parent[node])

    def spread(self) -> int:
        """Rows that one full histogram is spread into, over all steps."""
        return sum(self.size(p) for p in self.parent[1:])


def _queries(schema: Schema, names: list[str]) -> list[tuple[tuple[Groups, ...], str, list[list[str] | None]]]:
    """Groups and labels of every query; groups that overlap become several queries under the same name."""
    out = []
    for name in names:
        terms = {d.name: g for d, g in schema.parse(name)}
        options = []
        for d in schema.dims:
            groups = list(terms.get(d.name, {}).items())
            if d.name not in terms:
                options.append([((0,) * d.size, None)])
                continue
            parts: list[list[tuple[str, tuple[int, ...]]]] = []  # groups that overlap go to the first part where they do not
            for g in groups:
                free = next((p for p in parts if not any(set(ix) & set(g[1]) for _, ix in p)), None)
                if free is None:
                    parts.append([g])
                else:
                    free.append(g)
            options.append([(tuple(next((k for k, (_, ix) in enumerate(p) if i in ix), -1) for i in range(d.size)), [label for label, _ in p]) for p in parts])
        for pick in product(*options):
            out.append((tuple(g for g, _ in pick), name, [labels for _, labels in pick]))
    return out


def _step(fine: Groups, coarse: Groups) -> list[int] | None:
    """Coarse group of every fine group, or None if the coarse groups do not follow."""
    to = [-2] * (max(fine) + 1)
    for f, c in zip(fine, coarse, strict=True):
        if f < 0:
            if c >= 0:
                return None
        elif to[f] not in (-2, c):
            return None
        else:
            to[f] = c
    return to


def _meet(a: Groups, b: Groups) -> Groups:
    """Coarsest groups that both follow from; levels that neither needs are left out."""
    known: dict[tuple[int, int], int] = {}
    return tuple(-1 if x < 0 and y < 0 else known.setdefault((x, y), len(known)) for x, y in zip(a, b, strict=True))


def plan(schema: Schema, names: list[str]) -> Plan:
    wanted = _queries(schema, names)
    nodes = list(dict.fromkeys([tuple(tuple(range(d.size)) for d in schema.dims), *[g for g, _, _ in wanted]]))
    fixed = len(nodes)
    every = list(dict.fromkeys([*nodes, *[tuple(map(_meet, a, b)) for a, b in combinations(nodes[1:], 2)]]))
    follows = np.ones((len(every), len(every)), bool)
    for d in range(len(schema.dims)):
        kinds = {g: k for k, g in enumerate(dict.fromkeys(n[d] for n in every))}
        of = np.array([kinds[n[d]] for n in every])
        follows &= np.array([[_step(a, b) is not None for b in kinds] for a in kinds])[np.ix_(of, of)]
    size = np.array([float(prod(max(g) + 1 for g in n)) for n in every])
    place = np.arange(len(every))
    follows &= (size[:, None] > size[None, :]) | ((size[:, None] == size[None, :]) & (place[:, None] < place[None, :]))
    use = place < fixed
    cost = np.where(follows[:fixed], size[:fixed, None], np.inf).min(0)  # of the best step there is so far
    cost[0] = 0
    while True:
        gain = np.array([(np.maximum(cost[use] - size[c], 0) * follows[c, use]).sum() - cost[c] if not use[c] else 0.0 for c in place])
        best = int(gain.argmax())
        if gain[best] <= WORTH * cost[use].sum():
            break
        use[best] = True
        cost = np.where(follows[best], np.minimum(cost, size[best]), cost)
    kept = [0, *sorted(np.flatnonzero(use)[1:].tolist(), key=lambda k: (-size[k], k))]
    out, depth = Plan([every[k] for k in kept], [0]), [0]
    for i, k in enumerate(kept[1:], 1):
        ups = [j for j in range(i) if follows[kept[j], k]]
        enough = max(2 * min(size[kept[j]] for j in ups), SMALL)  # about as small will do where it comes sooner
        out.parent.append(min((j for j in ups if size[kept[j]] <= enough), key=lambda j: (depth[j], size[kept[j]])))
        depth.append(depth[out.parent[-1]] + 1)
    number = {n: i for i, n in enumerate(out.nodes)}
    out.queries = [(number[g], name, labels) for g, name, labels in wanted]
    return out


def answer(df: DataFrame, names: list[str], schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv"), steps: Plan | None = None) -> DataFrame:
    """(keys, query, level, counts) of all named queries, as `query_answer_many` has them, by the steps of a plan."""
    steps, spark = steps or plan(schema, names), df.sparkSession
    sums = [F.sum(c).alias(c) for c in counts]
    edges = [(steps.parent[k], k, [_step(a, b) for a, b in zip(steps.nodes[steps.parent[k]], steps.nodes[k], strict=True)], steps.depth(k)) for k in range(1, len(steps.nodes))]
    table = spark.createDataFrame(edges, "node int, child int, step array<array<int>>, depth int")
    rows = df.groupBy(*keys, *schema.names).agg(*sums).select(*keys, F.lit(0).alias("node"), F.array(*[F.col(n).cast("int") for n in schema.names]).alias("at"), *counts)
    rows = written(rows)  # the steps from it and its own queries read it
    layers = [rows]  # asked for itself where a query is the histogram
    for depth in range(1, max((e[3] for e in edges), default=0) + 1):
        to = F.zip_with("at", "step", lambda a, s: F.get(s, a))
        spread = rows.join(F.broadcast(table.filter(F.col("depth") == depth)), "node").select(*keys, F.col("child").alias("node"), to.alias("at"), *counts)  # a row per query
        rows = written(spread.filter(F.forall("at", lambda a: a >= 0)).groupBy(*keys, "node", "at").agg(*sums))
        layers.append(rows)
    asked = spark.createDataFrame(steps.queries, "node int, query string, labels array<array<string>>")
    all_ = layers[0]
    for layer in layers[1:]:
        all_ = all_.unionByName(layer)
    named = all_.join(F.broadcast(asked), "node")  # a row per query
    parts = F.array_compact(F.zip_with("at", "labels", lambda a, x: F.get(x, a)))
    return named.select(*keys, "query", F.when(F.size(parts) == 0, "total").otherwise(F.array_join(parts, " BY ")).alias("level"), *counts)


def table_set(df: DataFrame, tables: dict[str, list[str]], schema: Schema, keys: list[str], counts: tuple[str, ...] = ("orig", "priv")) -> DataFrame:
    """A whole set of published tables: (table_name, keys, query, level, counts); what tables share is summed once."""
    names = list(dict.fromkeys(q for queries in tables.values() for q in queries))
    of = df.sparkSession.createDataFrame([(t, q) for t, queries in tables.items() for q in dict.fromkeys(queries)], "table_name string, query string")
    return answer(df, names, schema, keys, counts).join(F.broadcast(of), "query").select("table_name", *keys, "query", "level", *counts)  # a row per table and query
