"""Benchmark decontamination by size-partitioned MinHash containment search.

Test items are partitioned by their number of five-word shingles: (8, 16], (16, 32], (32, 64], ... For a
partition of items up to u shingles, documents of any length are seen as windows of two neighbouring runs
of u shingles, so a window is never much larger than the items sought in it and the containment threshold
becomes a Jaccard threshold that does not fall with the document's length: an item of more than u / 2
shingles of which 80 % stand in a window has a Jaccard similarity of at least 0.19 with it. With HASHES
minima a window and such an item share none with a chance under (1 - 0.19) ** 96 = 2e-9. Minima of larger
windows are minima of smaller ones' minima, so one pass serves all partitions. A shared minimum makes a
candidate; candidates are verified by exact containment in the whole document's shingle set. Items of up to
EXACT shingles are too small for their windows: an index of all their shingles makes their candidates, without
a miss. Items of fewer than five words are one shingle of their own length and are looked up exactly.

Items are broadcast in blocks of at most BLOCK items and BLOCK_BYTES bytes; more items mean more passes
over the documents. An item longer than that is a block of its own.

Edge cases: texts of any length are searched whole; other columns are ignored by leaks and kept by the stage, whatever
their names; null or empty documents and items match nothing; repeated items and documents each count;
null ids stay; an empty benchmark or document table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .shingles import SIZE, grams, mixed, shingles

THRESHOLD = 0.8
HASHES = 96
SMALLEST = 16
EXACT = SMALLEST // 2
BLOCK, BLOCK_BYTES = 20_000, 32_000_000
#: Shingles that are hashed at once.
STRIP = 1 << 16
_BITS = 22
_odd = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)).astype(np.uint32) | np.uint32(1)


def _block_minima(h: np.ndarray, run: int) -> np.ndarray:
    """(HASHES, runs): minima over runs of ``run`` shingles; the last run may be shorter."""
    low = (h >> np.uint64(32)).astype(np.uint32)
    out = []
    for at in range(0, len(low), STRIP):
        part = low[at : at + STRIP]
        part = np.concatenate([part, np.repeat(part[-1:], -len(part) % run)])
        out.append((_odd[:, None] * part[None, :]).reshape(HASHES, -1, run).min(axis=2))
    return np.concatenate(out, axis=1)


def _halved(m: np.ndarray) -> np.ndarray:
    if m.shape[1] % 2:
        m = np.concatenate([m, m[:, -1:]], axis=1)
    return np.minimum(m[:, ::2], m[:, 1::2])


class Items:
    """A block of test items, ready to be sought."""

    def __init__(self, items: list[tuple[int | None, str | None]]):
        self.ids, self.sets, self.short = [], [], {}
        self.classes: dict[int, list[int]] = {}
        small = []
        for (item, _), ws, g in zip(items, *shingles([t for _, t in items]), strict=True):
            if not len(ws):
                continue
            g = np.unique(g)
            k = len(self.ids)
            self.ids.append(item)
            self.sets.append(g)
            if len(ws) < SIZE:
                self.short.setdefault(len(ws), []).append(k)
                continue
            if len(g) <= EXACT:
                small.append(k)
                continue
            c = 0
            while SMALLEST << c < len(g):
                c += 1
            self.classes.setdefault(c, []).append(k)
        self.exact = self._sorted(np.concatenate([self.sets[k] for k in small]), np.repeat(small, [len(self.sets[k]) for k in small])) if small else None
        self.index = {}
        mark = np.arange(HASHES, dtype=np.uint64) << np.uint64(32)
        for c, ks in self.classes.items():
            keys = np.concatenate([_block_minima(g, min(len(g), STRIP)).min(axis=1).astype(np.uint64) | mark for g in (self.sets[k] for k in ks)])
            self.index[c] = self._sorted(keys, np.repeat(np.array(ks), HASHES))

    @classmethod
    def _sorted(cls, keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        bloom = np.zeros(1 << _BITS, dtype=bool)
        bloom[cls.slot(keys)] = True
        return keys[order], owner[order], bloom

    @staticmethod
    def slot(keys: np.ndarray) -> np.ndarray:
        return ((keys ^ (keys >> np.uint64(32)) * np.uint64(0x9E3779B1)) & np.uint64((1 << _BITS) - 1)).astype(np.int64)

    def candidates(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first shingle of a window, its end, item) of the windows of h that share a minimum with an item, and of the shingles of small items."""
        spans, owners = [], []
        if self.exact and len(h):
            keys, owner, bloom = self.exact
            at = np.flatnonzero(bloom[self.slot(h)])
            lo, hi = np.searchsorted(keys, h[at], "left"), np.searchsorted(keys, h[at], "right")
            for a, b, w in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist(), at[hi > lo].tolist(), strict=True):
                spans += [(w, w + 1)] * (b - a)
                owners += owner[a:b].tolist()
        if not self.index or not len(h):
            return np.array(spans, np.int64).reshape(-1, 2), np.array(owners, np.int64)
        m, run = _block_minima(h, SMALLEST), SMALLEST
        mark = np.arange(HASHES, dtype=np.uint64)[:, None] << np.uint64(32)
        for c in range(max(self.index) + 1):
            if c:
                m, run = _halved(m), run * 2
            if c not in self.index:
                continue
            keys, owner, bloom = self.index[c]
            pair = np.minimum(m, np.concatenate([m[:, 1:], m[:, -1:]], axis=1)).astype(np.uint64) | mark
            flat = np.flatnonzero(bloom[self.slot(pair)].ravel())
            hit, at = pair.ravel()[flat], flat % pair.shape[1]
            lo, hi = np.searchsorted(keys, hit, "left"), np.searchsorted(keys, hit, "right")
            for a, b, w in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist(), at[hi > lo].tolist(), strict=True):
                spans += [(w * run, w * run + 2 * run)] * (b - a)
                owners += owner[a:b].tolist()
        return np.array(spans, np.int64).reshape(-1, 2), np.array(owners, np.int64)


    def found(self, texts: list[str | None], threshold: float) -> list[tuple[int, int, int]]:
        """(text, item, common shingles) of every item that meets the threshold, by exact containment."""
        hs, gs = shingles(texts)
        edge = np.concatenate([[0], np.cumsum([len(g) for g in gs])])
        spans, owners = self.candidates(np.concatenate(gs) if gs else np.zeros(0, np.uint64))
        first, last = np.searchsorted(edge, spans[:, 0], "right") - 1, np.searchsorted(edge, spans[:, 1], "left")
        wanted: dict[int, set[int]] = {}
        for a, b, k in zip(first.tolist(), last.tolist(), owners.tolist(), strict=True):
            for d in range(a, min(b, len(gs))):
                wanted.setdefault(d, set()).add(k)
        rows = []
        for d, ks in wanted.items():
            own = np.unique(gs[d])
            rows += [(d, k, n) for k in ks if (n := int(np.isin(self.sets[k], own, assume_unique=True).sum())) >= threshold * len(self.sets[k]) - 1e-9]
        for n, ks in self.short.items():
            want = np.concatenate([self.sets[k] for k in ks])
            for d, h in enumerate(hs):
                if len(h) >= n:
                    rows += [(d, k, 1) for k, hit in zip(ks, np.isin(want, grams(h, n)).tolist(), strict=True) if hit]
        return sorted(rows)


def _search(docs: DataFrame, items: list[tuple], threshold: float, doc_id: str, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(Items(items))  # at most BLOCK items or one item
    out = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()), ("n_common", pa.int64()), ("containment", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 128):
                ids, texts = (c.to_pylist() for c in batch.slice(start, 128).columns)
                rows = [(ids[d], q.ids[k], len(q.sets[k]), n, n / len(q.sets[k])) for d, k, n in q.found(texts, threshold)]
                if rows:
                    yield pa.record_batch([pa.array(v, f.type) for v, f in zip(zip(*rows, strict=True), out, strict=True)], schema=out)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, item_id bigint, n_shingles bigint, n_common bigint, containment double")


def _blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    block, held = [], 0
    for r in benchmark.select(F.col(item_id).cast("long"), F.col(text).cast("string")).toLocalIterator():
        if block and (len(block) >= BLOCK or held + len(r[1] or "") > BLOCK_BYTES):
            yield block
            block, held = [], 0
        block.append((r[0], r[1]))
        held += len(r[1] or "")
    yield block


def leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_common, containment) of every item that a document holds."""
    return reduce(DataFrame.unionByName, [_search(docs, b, threshold, doc_id, text) for b in _blocks(benchmark, item_id, item_text)])


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a test item, judged row by row, so that no text is shuffled."""
    items = table(spark, sf_dir, "benchmark")
    key = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("d"))
    kept = reduce(lambda d, b: _without(d, b, THRESHOLD), _blocks(items, "item_id", "text"), key)
    return kept.select("d.*")


def _without(rows: DataFrame, items: list[tuple], threshold: float) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(Items(items))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = shared.value
        for batch in batches:
            texts, keep = batch.column(0).field("text"), np.ones(batch.num_rows, dtype=bool)
            for start in range(0, batch.num_rows, 128):
                for d, _, _ in q.found(texts.slice(start, 128).to_pylist(), threshold):
                    keep[start + d] = False
            yield batch.filter(pa.array(keep))

    return rows.mapInArrow(clean, rows.schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
