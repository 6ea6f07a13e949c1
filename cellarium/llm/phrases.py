"""Removal of recurring passages with phrase automata.

A window is 35 consecutive words. A word goes if some window over it recurs: its word sequence also starts
anywhere else, in the same document or another.

* Candidates. Of the 16-word grams inside a window the one of the least hash is its anchor, so equal windows have
  equal anchors and an anchor that is selected at one place of the whole corpus refutes all its windows. Only
  anchors (one word in ten) are counted over the corpus, not windows.
* Confirmation. The windows of the other anchors are counted by 128-bit hashes over all documents. What is counted
  once is refuted; all other candidates recur.
* Automata. Documents are dealt evenly into blocks of about BLOCK bytes. Confirmed windows that overlap make
  passages; the distinct passages of a block are compiled into one Aho-Corasick automaton over word numbers, and
  every document of the block is streamed through it. Each occurrence covers its words. A passage covers recurring windows only and
  every recurring window lies in a passage of its own block, so the cover is exact. No automaton grows with the corpus.

Counts are plain sums, pre-aggregated before they are shuffled, and travel as the few refuted hashes; a passage
that stands in a third of all documents is one row a block. Nothing is kept per pair of documents. Two different windows are taken
for equal with a chance under 10^-12 in 10^13 words, and even then only where a block holds both does a wrong passage arise.

Edge cases: null and empty texts have no words and the hash of the empty text; texts under 35 words keep all;
texts of any length are read whole (a text over BLOCK bytes makes its block larger); words compare byte by
byte, letter case and control characters included; repeated rows are documents of their own, so they remove each other;
null ids stay; other columns are ignored, whatever their names; an empty table gives an empty result. docs
must be reproducible (a table, not a sample): it is read more than once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_of
from .shingles import mixed

SIZE = 35
#: Words of an anchor.
ANCHOR = 16
#: Bytes of text of a block, about.
BLOCK = 2 << 20
#: Bytes of text that are looked at together before there are blocks, about.
PART = 1 << 20
#: Words whose hashes a task keeps.
KNOWN = 1 << 18
_STEP = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD1B54A32D192ED03)]
RESULT = "doc_id {kind}, n_words long, n_removed long, kept_sha256 string"


class _Words:
    """Hashes of words, remembered from text to text."""

    def __init__(self) -> None:
        self.known: dict[bytes, int] = {}

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.known) > KNOWN:
            self.known.clear()
        get, known = self.known.get, self.known
        for w in set(words).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(get, words), np.uint64, len(words))


def _pair(x: np.ndarray, apart: int, step: np.uint64) -> np.ndarray:
    """Hash of x[i] followed by x[i + apart]."""
    y = x[:-apart] * step + x[apart:]
    y ^= y >> np.uint64(29)
    return y * step


def _runs(x: np.ndarray, step: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of 16 words and of all of 35, by doubling; two mixings give independent ones."""
    x = mixed(x + step)
    for apart in (1, 2, 4, 8):
        x = _pair(x, apart, step)
    return x, _pair(_pair(x, 16, step), 3, step)


def _slide(x: np.ndarray, size: int, best) -> np.ndarray:
    """best (minimum or maximum) over every run of size values."""
    done = 1
    while 2 * done <= size:
        x = best(x[:-done], x[done:])
        done *= 2
    return best(x[: len(x) - (size - done)], x[size - done :]) if done < size else x


class Anchored:
    """Windows and anchors of some texts, their words one after the other; edge: where each text begins."""

    def __init__(self, hashes: np.ndarray, edge: np.ndarray) -> None:
        n, self.edge = len(hashes), edge
        if n < SIZE:
            self.whole, self.anchor, self.start = (np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64))
            self.hashes, self.gram = hashes, self.anchor
            return
        self.hashes = hashes
        self.gram, self.whole = _runs(hashes, _STEP[0])
        self.anchor = _slide(self.gram, SIZE - ANCHOR + 1, np.minimum)
        inside = np.repeat(edge[1:], np.diff(edge))[: n - SIZE + 1] >= np.arange(n - SIZE + 1) + SIZE
        self.start = np.flatnonzero(inside)  # windows that lie in one text

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Places at which an anchor is selected, and the anchors; every place of equal windows counts."""
        if not len(self.start):
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        width = SIZE - ANCHOR + 1
        low = np.zeros(len(self.gram) + width - 1, np.uint64)
        low[self.start + width - 1] = self.anchor[self.start]
        at = np.flatnonzero((_slide(low, width, np.maximum) == self.gram) & (self.gram > 0))
        return at, self.gram[at]

    def candidates(self, refuted: np.ndarray) -> np.ndarray:
        """Starts of the windows whose anchor was not refuted."""
        return self.start[~np.isin(self.anchor[self.start], refuted)]

    def second(self) -> np.ndarray:
        return _runs(self.hashes, _STEP[1])[1]


def _split(texts: list[bytes | None]) -> tuple[list[list[bytes]], np.ndarray]:
    words = [(t or b"").split() for t in texts]
    return words, np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


def _anchored(texts: list[bytes | None], hashed: _Words) -> tuple[list[list[bytes]], np.ndarray, Anchored]:
    words, edge = _split(texts)
    h = np.concatenate([hashed(w) for w in words]) if words else np.zeros(0, np.uint64)
    return words, edge, Anchored(h, edge)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _count_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashed = _Words()
    for batch in batches:
        block = batch.column("block").to_numpy(zero_copy_only=False)
        step = max(1, batch.num_rows * PART // max(batch.nbytes, 1))
        for k in range(0, batch.num_rows, step):
            _, edge, at = _anchored(batch.column("text").slice(k, step).to_pylist(), hashed)
            place, h = at.anchors()
            yield pa.RecordBatch.from_arrays([pa.array(block[k + np.searchsorted(edge, place, "right") - 1]), _signed(h)], ["block", "h"])


def _listed(refuted: pa.Table, kind: int) -> np.ndarray:
    h = refuted.column("h").to_numpy().view(np.uint64)
    return h[refuted.column("kind").to_numpy() == kind]


def _count_windows(docs: pa.Table, refuted: pa.Table) -> pa.Table:
    """The distinct candidate windows of a block, and whether a window stands there more than once."""
    at = _anchored(docs.column("text").to_pylist(), _Words())[2]
    start = at.candidates(_listed(refuted, 0))
    both = np.zeros(len(start), [("a", np.uint64), ("b", np.uint64)])
    if len(start):
        both["a"], both["b"] = at.whole[start], at.second()[start]
    order = np.lexsort((both["b"], both["a"]))
    both = both[order]
    first = np.flatnonzero(np.concatenate([[True], both[1:] != both[:-1]])) if len(both) else np.zeros(0, np.int64)
    n = np.diff(np.append(first, len(both)))
    block = docs.column("block")[0].as_py() if docs.num_rows else 0
    return pa.table({"block": pa.array(np.full(len(first), block, np.int64)), "a": _signed(np.ascontiguousarray(both["a"][first])), "b": _signed(np.ascontiguousarray(both["b"][first])), "n": pa.array(np.minimum(n, 2).astype(np.int64))})


def _passages(start: np.ndarray, edge: np.ndarray) -> list[tuple[int, int]]:
    """Word ranges of confirmed windows that touch or overlap inside one text."""
    if not len(start):
        return []
    text = np.searchsorted(edge, start, "right")
    cut = np.flatnonzero((np.diff(start) > SIZE) | (np.diff(text) > 0)) + 1
    return list(zip(start[np.append(0, cut)].tolist(), (start[np.append(cut - 1, len(start) - 1)] + SIZE).tolist(), strict=True))


def automaton(passages: set[tuple[int, ...]]) -> ahocorasick.Automaton:
    """Over word numbers; the value of a passage is its length."""
    a = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for p in passages:
        a.add_word(p, len(p))
    a.make_automaton()
    return a


def covered(a: ahocorasick.Automaton, numbers: tuple[int, ...]) -> np.ndarray:
    """Which words of a text lie in an occurrence of a passage."""
    turn = np.zeros(len(numbers) + 1, np.int64)
    for last, length in a.iter(numbers):
        turn[last + 1 - length] += 1
        turn[last + 1] -= 1
    return np.cumsum(turn[:-1]) > 0


def _strip(docs: pa.Table, refuted: pa.Table) -> pa.Table:
    """The block's documents without the passages that its automaton finds."""
    words, edge, at = _anchored(docs.column("text").to_pylist(), _Words())
    start = at.candidates(_listed(refuted, 0))
    start = start[~np.isin(at.whole[start], _listed(refuted, 1))]
    number: dict[bytes, int] = {}
    flat = [number.setdefault(w, len(number)) for ws in words for w in ws] if len(start) else []
    found = {tuple(flat[a:b]) for a, b in _passages(start, edge)}
    machine = automaton(found) if found else None
    removed, digest = [], []
    for ws, a, b in zip(words, edge[:-1].tolist(), edge[1:].tolist(), strict=True):
        gone = covered(machine, tuple(flat[a:b])) if machine is not None and b - a >= SIZE else np.zeros(b - a, bool)
        removed.append(int(gone.sum()))
        kept = ws if not removed[-1] else [ws[k] for k in np.flatnonzero(~gone).tolist()]
        digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
    return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(np.diff(edge), pa.int64()), "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())})


def substring_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every document."""
    size = docs.agg(F.sum(F.octet_length(text_of(text)).cast("long"))).first()[0] or 0
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.encode(F.col(text).cast("string"), "UTF-8").alias("text"), F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(size // block + 1)).alias("block"))
    anchors = rows.mapInArrow(_count_anchors, "block long, h long")
    lone = anchors.groupBy("h").agg(F.min("block").alias("block"), F.count(F.lit(1)).alias("n")).filter("n = 1").select("block", F.lit(0).alias("kind"), "h")
    windows = rows.groupBy("block").cogroup(lone.groupBy("block")).applyInArrow(_count_windows, "block long, a long, b long, n long")
    single = windows.groupBy("a", "b").agg(F.min("block").alias("block"), F.sum("n").alias("n")).filter("n = 1").select("block", F.lit(1).alias("kind"), F.col("a").alias("h"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.groupBy("block").cogroup(lone.unionByName(single).groupBy("block")).applyInArrow(_strip, RESULT.format(kind=kind))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"))


SQL = r"""
with d as (select row_number() over () as k, doc_id, coalesce(text, '') as x from documents),
s as (select k, doc_id, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') as w from d),
p as (select k, unnest(range(1, len(w) + 1)) as i, unnest(w) as y from s),
g as (select k, i, sha256(string_agg(y, ' ') over (partition by k order by i rows between current row and 34 following)) as h,
    count(*) over (partition by k order by i rows between current row and 34 following) as n from p),
again as (select k, i, case when n = 35 and count(*) filter (n = 35) over (partition by h) > 1 then 1 else 0 end as hit from g),
cover as (select k, i, max(hit) over (partition by k order by i rows between 34 preceding and current row) as gone from again),
kept as (select k, count(*) as n_words, sum(gone)::bigint as n_removed, string_agg(y, ' ' order by i) filter (gone = 0) as t from cover join p using (k, i) group by k)
select doc_id, coalesce(n_words, 0)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256 from d left join kept using (k)
"""
