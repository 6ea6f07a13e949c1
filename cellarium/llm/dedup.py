"""MinHash near-duplicates with sequential Bayesian verification.

1. One pass numbers the rows and gives each its distinct five-word shingles' digest and HASHES minima. Rows
   with equal sets form a class; only its first row goes on, so copies cost nothing further.
2. Bands of minima make buckets. Their length is the greatest for which two sets at the threshold share no
   bucket with a chance of at most MISS: 32 bands of 6 at 0.85 (3e-7), 38 of 5 at 0.80 (3e-7).
3. A bucket is not expanded into its pairs. Each member is compared with the bucket's centre, the member with
   most company over all buckets: BATCH minima at a time, and a pair is dropped as soon as the posterior
   probability that its similarity reaches the threshold, given the matches so far and a uniform prior, is
   below MISS. Survivors are confirmed on their full sets, and links join components.
4. Buckets that still hold several components (without their centre, whose pairs are known) are settled by
   elimination. Every member A is compared with one hub B, the most typical document of the centre's
   component. Two sets of n and m shingles are similar if they share o(n, m) of them. If A is not similar to B,
   it shares fewer than o(n, |B|) with B, so fewer than o(n, m) with B and any A' of m >= |B| shingles
   together: a similar A' must have a shingle in common with A that B lacks, and one among the first
   n - o + 1 of A's and of A' own (the prefix filter, here in the order of the hashes). So the shingles that B lacks
   are the keys of new, much smaller buckets. Pairs in which a member smaller than B takes part are not
   covered by this; they are kept with the bound that, unless they share such a shingle, they have no more in
   common than either has with B. No similar pair of a bucket is lost by any of it.
5. New buckets of up to SMALL members give their pairs across components, larger ones are eliminated again
   with a member of theirs as hub, and what is left after ROUNDS rounds gives its pairs across components.
   These pairs are verified as in step 3. Components come from minimum labels with pointer jumping.

Edge cases: a row is a document, and rows that share a doc_id are not linked by that; documents without words
link with nothing; in near_duplicates a null doc_id stays alone (its component_id is null), in ``stage`` such
rows are documents like others; repeated rows are equal documents; null texts are empty; texts of any length
are hashed in strips; other columns, whatever their names, do not matter and pass through ``stage``; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table
from .shingles import mixed, shingles

PERCENT = 85
#: The corpus pipeline's threshold.
STAGE_PERCENT = 80
HASHES = 192
BATCH, MISS = 32, 1e-6
#: Buckets of elimination up to this size give their pairs; larger ones go on, for so many rounds.
SMALL, ROUNDS = 32, 2
#: Pairs of one document that meet in one task.
CROWD = 1024
_odd = mixed(np.arange(11, HASHES + 11, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def signature(sets: np.ndarray) -> np.ndarray:
    """Lower 16 bits of the minima of HASHES permutations of the shingles' upper 32 bits.

    Equal minima stay equal; others agree by chance once in 65,536, which only lets a pair through to the next check.
    """
    low = (sets >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, dtype=np.uint32)
    for at in range(0, len(low), 2048):
        np.minimum(out, (_odd[:, None] * low[None, at : at + 2048]).min(axis=1), out=out)
    return out.astype(np.uint16)


def fingerprints(docs: DataFrame, text: str) -> DataFrame:
    """(rid, row, n_shingles, digest, sig): every row of docs as a struct, with a number and its marks."""
    at = docs.columns.index(text)
    marks = T.StructType([T.StructField("n_shingles", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("sig", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                row = batch.slice(k, 256).column(0)
                n, digest, sig = [], [], []
                for g in map(np.unique, shingles(row.field(at).cast(pa.string()).to_pylist())[1]):
                    n.append(len(g))
                    digest.append(hashlib.blake2b(g.tobytes(), digest_size=16).digest() if len(g) else None)
                    sig.append(signature(g).tobytes() if len(g) else None)
                yield pa.record_batch([row, pa.array(n, pa.int64()), pa.array(digest, pa.binary()), pa.array(sig, pa.binary())], names=["row", *marks.names])

    rows = docs.select(F.struct(*docs.columns).alias("row"))
    return rows.mapInArrow(run, T.StructType([*rows.schema, *marks])).withColumn("rid", F.monotonically_increasing_id())


def shingle_sets(texts: DataFrame) -> DataFrame:
    """(id, sig, set): with a text's distinct shingles, ascending, as bytes. texts: (id, sig, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                sets = [np.unique(g).tobytes() for g in shingles(part.column(2).to_pylist())[1]]
                yield pa.record_batch([part.column(0), part.column(1), pa.array(sets, pa.binary())], names=["id", "sig", "set"])

    return texts.mapInArrow(run, "id bigint, sig binary, set binary")


def layout(percent: int) -> tuple[int, int]:
    """(bands, minima in a band): the longest bands that miss a pair at the threshold with a chance of at most MISS."""
    t = percent / 100
    return next((HASHES // r, r) for r in range(HASHES, 0, -1) if r == 1 or (1 - t**r) ** (HASHES // r) <= MISS)


def bands(sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, id): every band of every signature as a 64-bit key."""
    n, size = layout(percent)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), 4096):
                part = f.iloc[at : at + 4096]
                m = np.frombuffer(b"".join(part["sig"]), np.uint16).reshape(len(part), HASHES)[:, : n * size].reshape(len(part), n, size).astype(np.uint64)
                key = np.broadcast_to(np.arange(1, n + 1, dtype=np.uint64), (len(part), n)).copy()
                for j in range(size):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + m[:, :, j])
                yield pd.DataFrame({"key": key.astype(np.int64).ravel(), "id": np.repeat(part["id"].to_numpy(), n)})

    return sigs.mapInPandas(run, "key bigint, id bigint")


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For 0, BATCH, 2 BATCH, ... compared minima: the fewest matches with which a pair goes on.

    The posterior of the similarity after m matches of n is Beta(m + 1, n - m + 1); it exceeds the
    threshold t with the probability that a Binomial(n + 1, t) is at most m.
    """
    out = [0]
    for n in range(BATCH, HASHES + 1, BATCH):
        cum, m = 0.0, 0
        for m in range(n + 1):  # noqa: B007
            cum += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if cum >= miss:
                break
        out.append(m)
    return out


def beside(pairs: DataFrame, values: DataFrame, value: str) -> DataFrame:
    """(a, b, x, y): both documents' values next to each pair. values: (id, value).

    A document that many pairs have as b is dealt to as many tasks as it has CROWDs of pairs.
    """
    crowd = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / CROWD).alias("parts")).filter("parts > 1")
    left = pairs.join(crowd, "b", "left").select("a", "b", F.coalesce(F.pmod(F.xxhash64("a"), "parts"), F.lit(0)).alias("part"))
    right = values.select(F.col("id").alias("b"), F.col(value).alias("y")).join(crowd, "b", "left")
    right = right.select("b", "y", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
    return left.join(values.select(F.col("id").alias("a"), F.col(value).alias("x")), "a").join(right, ["b", "part"]).select("a", "b", "x", "y")


def likely(pairs: DataFrame, sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (a, b) that sequential Bayesian pruning keeps. sigs: (id, sig)."""
    least = least_matches(percent / 100)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            x, y = (np.frombuffer(b"".join(f[c]), np.uint16).reshape(len(f), HASHES) for c in ("x", "y"))
            alive, matches = np.arange(len(f)), np.zeros(len(f), np.int64)
            for k, at in enumerate(range(0, HASHES, BATCH), 1):
                matches = matches + (x[alive, at : at + BATCH] == y[alive, at : at + BATCH]).sum(axis=1)
                go = matches >= least[k]
                alive, matches = alive[go], matches[go]
            yield f.iloc[alive][["a", "b"]]

    return beside(pairs, sigs, "sig").mapInPandas(run, "a bigint, b bigint")


def compared(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(a, b, n, m, c, linked, keys): sizes of both sets and of their intersection, whether they are similar, and
    the keys of elimination, a's first shingles that b lacks, each mixed with b. sets: (id, set)."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()), ("m", pa.int64()), ("c", pa.int64()), ("linked", pa.bool_()), ("keys", pa.list_(pa.int64()))])

    def need(n: int, m: int) -> int:
        return -(-percent * (n + m) // (100 + percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys, ends = [], [np.zeros(0, np.int64)], [0]
            for b, x, y in zip(batch.column(1).to_pylist(), batch.column(2), batch.column(3), strict=True):
                p, q = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                n, m = len(p), len(q)
                own = p[q[np.minimum(np.searchsorted(q, p), m - 1)] != p]
                first = need(n, -(-percent * n // 100)) if n >= m else need(n, m)
                k = mixed(own[: n - first + 1] ^ mixed(np.full(1, b, np.int64).view(np.uint64)))
                rows.append((n, m, n - len(own), n - len(own) >= need(n, m)))
                keys.append(k.view(np.int64))
                ends.append(ends[-1] + len(k))
            n, m, c, linked = zip(*rows, strict=True) if rows else ((),) * 4
            found = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(keys)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(m, pa.int64()), pa.array(c, pa.int64()), pa.array(linked, pa.bool_()), found], schema=out)

    return beside(pairs, sets, "set").mapInArrow(run, "a bigint, b bigint, n bigint, m bigint, c bigint, linked boolean, keys array<bigint>")


def components(edges: DataFrame) -> DataFrame:
    """(id, comp) for every id of the edges (a, b): comp is the smallest id it reaches."""
    both = stored(edges.select(F.col("a").alias("id"), F.col("b").alias("to")).union(edges.select("b", "a")).filter("id <> to").distinct())
    label = stored(both.groupBy("id").agg(F.min("to").alias("m")).select("id", F.least("id", "m").alias("comp")))
    while True:
        near = both.join(label.select(F.col("id").alias("to"), "comp"), "to").groupBy("id").agg(F.min("comp").alias("near"))
        step = label.join(near, "id").select("id", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        up = label.select(F.col("id").alias("comp"), F.col("comp").alias("top"))
        new = stored(step.join(up, "comp", "left").select("id", "was", F.least("comp", "top").alias("comp")))
        if new.filter("comp <> was").isEmpty():
            return new.select("id", "comp")
        label = new.select("id", "comp")


def buckets(sigs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(key, id, size, company, center) of the buckets with two members or more."""
    rows = bands(sigs, percent)
    heads = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    members = stored(rows.join(heads, "key"))
    ranked = stored(members.join(members.groupBy("id").agg(F.sum("size").alias("company")), "id"))
    return stored(ranked.join(_typical(ranked, "key", "center"), "key"))


def _typical(rows: DataFrame, group: str, name: str, *more: Column) -> DataFrame:
    """(group, name): a group's member with most company, the smallest of several."""
    best = F.max(F.struct("company", (-F.col("id")).alias("no"))).alias("best")
    return rows.groupBy(group).agg(best, *more).withColumn(name, -F.col("best.no")).drop("best")


def _placed(rows: DataFrame, groups: DataFrame) -> DataFrame:
    return rows.join(groups, "id", "left").withColumn("comp", F.coalesce("comp", "id"))


def _ends() -> tuple[Column, Column]:
    return F.min("comp").alias("c1"), F.max("comp").alias("c2")


def open_lists(members: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, id, company, b): what the centres left open, with the hub to compare it with."""
    rows = _placed(members.filter("size > 2 and id <> center"), groups)
    heads = rows.groupBy("key").agg(*_ends(), F.max("center").alias("center")).filter("c1 <> c2").select("key", "center")
    known = members.select("id", "company").distinct().join(groups, "id")
    hubs = groups.select(F.col("id").alias("center"), "comp").join(_typical(known, "comp", "hub"), "comp").select("center", "hub")
    heads = heads.join(hubs, "center", "left").select("key", F.coalesce("hub", "center").alias("b"))
    return rows.join(heads, "key").select("key", "id", "company", "b")


def smaller_pairs(lists: DataFrame, seen: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs across components with a member smaller than the list's hub, as far as their bound allows."""
    whole = 100 + percent
    rows = _placed(lists.join(seen.select(F.col("a").alias("id"), "b", "n", "m", "c"), ["id", "b"]), groups)
    of_hub = groups.select(F.col("id").alias("b"), F.col("comp").alias("of_hub"))
    rows = rows.join(of_hub, "b", "left").filter((F.col("n") < F.col("m")) | (F.col("comp") != F.coalesce("of_hub", "b")))
    least = rows.groupBy("key").agg(F.min("n").alias("least"))
    rows = rows.join(least, "key").filter((F.col("least") < F.col("m")) & (whole * F.col("c") >= percent * (F.col("n") + F.col("least"))))
    rows = stored(rows.select("key", "id", "comp", "n", "m", "c"))
    x, y = rows.alias("x"), rows.alias("y")
    bound = whole * F.least("x.c", "y.c") >= percent * (F.col("x.n") + F.col("y.n"))
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp")) & (F.least("x.n", "y.n") < F.col("x.m")) & bound).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def cross_pairs(rows: DataFrame) -> DataFrame:
    """(a, b): pairs across components of every list. rows: (key, id, comp)."""
    x, y = rows.alias("x"), rows.alias("y")
    return x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.comp") != F.col("y.comp"))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def linked_classes(ids: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(id, comp) of the texts of ids that are linked. texts: (id, sig, text), of more ids too.

    Both semi-joins of texts are merged whatever the sizes: near copies are too large a share of them to broadcast.
    """
    members = buckets(texts.select("id", "sig").join(ids.hint("merge"), "id", "left_semi"), percent)
    sets = stored(shingle_sets(texts.join(members.select("id").distinct().hint("merge"), "id", "left_semi").select("id", "sig", "text")))

    def linked(pairs: DataFrame) -> DataFrame:
        hopeful = stored(likely(pairs, sets.select("id", "sig"), percent))
        return stored(compared(hopeful, sets.select("id", "set"), percent).filter("linked").select("a", "b"))

    def joined(groups: DataFrame | None, links: DataFrame) -> DataFrame:
        return components(links if groups is None else groups.toDF("a", "b").unionByName(links))

    groups = joined(None, linked(members.filter("id <> center").select(F.col("id").alias("a"), F.col("center").alias("b")).distinct()))
    lists, pairs = stored(open_lists(members, groups)), []
    company = members.select("id", "company").distinct()
    for k in range(ROUNDS):
        if lists.isEmpty():
            break
        seen = stored(compared(lists.filter("id <> b").select(F.col("id").alias("a"), "b").distinct(), sets.select("id", "set"), percent))
        links = seen.filter("linked").select("a", "b")
        if not links.isEmpty():
            groups = joined(groups, links)
        pairs.append(smaller_pairs(lists, seen, groups, percent))
        rows = _placed(seen.select(F.explode("keys").alias("key"), F.col("a").alias("id")), groups)
        if k == ROUNDS - 1:
            several = rows.groupBy("key").agg(*_ends()).filter("c1 <> c2").select("key")
            pairs.append(cross_pairs(stored(rows.join(several, "key", "left_semi"))))
            break
        rows = stored(rows.join(company, "id"))
        heads = stored(_typical(rows, "key", "b", *_ends(), F.count(F.lit(1)).alias("size")).filter("c1 <> c2"))
        pairs.append(cross_pairs(rows.join(heads.filter(F.col("size") <= SMALL).select("key"), "key", "left_semi")))
        lists = stored(rows.join(heads.filter(F.col("size") > SMALL).select("key", "b"), "key").select("key", "id", "company", "b"))
    links = linked(stored(reduce(DataFrame.unionByName, pairs).distinct())) if pairs else None
    return groups if links is None or links.isEmpty() else joined(groups, links)


def classes_of(prints: DataFrame, percent: int, *more: Column) -> DataFrame:
    """(digest, comp, ...) of every class of equal sets, with further aggregates of its rows."""
    classes = stored(prints.filter("digest is not null").groupBy("digest").agg(F.min("rid").alias("id"), *more))
    groups = linked_classes(classes.select("id"), prints.select(F.col("rid").alias("id"), "sig", F.col("row.text").alias("text")), percent)
    return classes.join(groups, "id", "left").withColumn("comp", F.coalesce("comp", "id")).drop("id")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of docs."""
    prints = stored(fingerprints(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")), "text"))
    classes = classes_of(prints.filter("row.doc_id is not null"), percent, F.min("row.doc_id").alias("first"))
    smallest = classes.groupBy("comp").agg(F.min("first").alias("component"))
    of_digest = stored(classes.join(smallest, "comp").select("digest", "component"))
    out = prints.select("row.doc_id", "n_shingles", "digest").join(of_digest, "digest", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", comp.alias("component_id"), F.coalesce(comp == F.col("doc_id"), F.lit(True)).alias("kept"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component, that with the smallest doc_id (null last), and every row without words.

    The kept rows' numbers are merged with the rows whatever the sizes: most rows stay.
    """
    prints = stored(fingerprints(docs, "text"))
    order = F.struct(F.col("row.doc_id").isNull().alias("last"), F.col("row.doc_id").alias("doc_id"), F.col("rid"))
    classes = classes_of(prints, STAGE_PERCENT, F.min(order).alias("best"))
    chosen = classes.groupBy("comp").agg(F.min("best").alias("best")).select("best.rid")
    keep = stored(chosen.unionByName(prints.filter("digest is null").select("rid")))
    return prints.join(keep.hint("merge"), "rid", "left_semi").select("row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
