"""Best-fit packing of tokenised documents into sequences by a configuration linear program.

1. Documents are tokenised once; those over the capacity are cut. Only the histogram of piece lengths (at
   most ``capacity`` numbers, whatever the corpus) reaches the driver.
2. The covering program "fewest sequences whose configurations supply every length" is solved by
   multiplicative weights: each round a knapsack dynamic program over the exact lengths prices the
   configurations that are worth most under the lengths' weights, one for each of the heaviest lengths, takes a step of
   them and lowers the weights of what they supply. Where there are more than CLASSES lengths, neighbours
   share a class, the classes holding equal shares of the tokens; a class is priced at its longest.
3. Configurations are rounded to whole counts (down, to the nearest and up, as far as there are pieces) and
   filled with the longest lengths of their classes; what remains goes best-fit, longest first, into the room
   left and into new sequences. Rounds end at the lower bound, or when they bring nothing more. Best-fit
   alone is the safeguard: should it need fewer sequences, its plan is taken. All this counts runs of equal
   sequences, so its size depends on the histogram alone.
4. Every piece gets its rank among those of its length (salted by row, so a common length is many tasks) and
   looks up its sequence and offset.

Edge cases: a null or empty text is its end token alone; repeated rows and null ids are pieces of their own;
other columns are ignored, whatever their names; texts and words of any length are tokenised whole; an empty
table gives an empty result.
"""

from __future__ import annotations

import bisect
import collections
import json
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table

CAPACITY = 4096
END = 1
#: Classes of lengths in the program; lengths up to SMALL only fill room.
CLASSES, SMALL = 256, 128
#: Rounds at most, rounds between two roundings, configurations of a round, and the step.
ROUNDS, BATCH, SEEDS, EPSILON = 80, 20, 48, 0.25
SALTS = 256
_REMEMBERED = 400_000
_loaded: dict = {}


#: Chunks of letters with ASCII marks after them; apostrophes are left to the tokenizer's own rules.
_PLAIN = re.compile(r"([^\W\d_]*)([!-&(-/:-@\[-`{-~]*)")


class WordIds:
    """ids of white-space separated chunks, as little-endian bytes.

    The tokenizer drops white space and never joins across it, so a text's ids are its chunks' ids. Chunks met
    for the first time are merged many at once in numpy where they are letters and marks, and by the tokenizer
    itself otherwise; both give the same ids (tests/llm).
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            bpe = json.load(f)["model"]
        vocab, suffix = bpe["vocab"], bpe["end_of_word_suffix"]
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in printable)}
        self.inner = np.array([vocab[letters[b]] for b in range(256)], np.int64)
        self.last = np.array([vocab[letters[b] + suffix] for b in range(256)], np.int64)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in bpe["merges"]]
        self.wide = max(vocab.values()) + 1
        key = np.array([vocab[x] * self.wide + vocab[y] for x, y in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair, self.rank = key[order], order
        self.made = np.array([vocab[x + y] for x, y in pairs], np.int64)[order]
        self.bits = 19
        self.slot = np.zeros(1 << self.bits, np.int32)  # 1 + place of the pair
        for k, h in enumerate(self._hash(self.pair).tolist()):
            while self.slot[h]:
                h = (h + 1) & ((1 << self.bits) - 1)
            self.slot[h] = k + 1
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}

    def _hash(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Places of pairs among the merges, -1 for none."""
        key = left * self.wide + right
        h = self._hash(key)
        at = self.slot[h].astype(np.int64) - 1
        while len(miss := np.flatnonzero((at >= 0) & (self.pair[at] != key))):
            h[miss] = (h[miss] + 1) & ((1 << self.bits) - 1)
            at[miss] = self.slot[h[miss]].astype(np.int64) - 1
        return at

    def merged(self, parts: list[bytes]) -> list[bytes]:
        """ids of parts that the tokenizer would not split further: the lowest-ranked pair first, then from the left."""
        out: list[bytes] = [b""] * len(parts)
        by_length: dict[int, list[int]] = {}
        for k, w in enumerate(parts):
            by_length.setdefault(len(w), []).append(k)
        never = np.iinfo(np.int64).max
        for n, ks in by_length.items():
            if not n:
                continue
            raw = np.frombuffer(b"".join([parts[k] for k in ks]), np.uint8).reshape(len(ks), n)
            ids = self.inner[raw]
            ids[:, -1] = self.last[raw[:, -1]]
            who, size = np.arange(len(ks)), np.full(len(ks), n)
            place = self._place(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(ks), n - 1)
            rank = np.where(place >= 0, self.rank[place], never)
            final = np.zeros((len(ks), n), "<u4")
            length = np.zeros(len(ks), np.int64)
            while len(who):
                at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(who), np.int64)
                rows = np.arange(len(who))
                go = rank[rows, at] != never if rank.shape[1] else np.zeros(len(who), bool)
                done = np.flatnonzero(~go)
                final[who[done], : ids.shape[1]], length[who[done]] = ids[done], size[done]
                who, size, ids, rank, at = who[go], size[go], ids[go], rank[go], at[go]
                if not len(who):
                    break
                rows, m = np.arange(len(who)), ids.shape[1]
                ids[rows, at] = self.made[self._place(ids[rows, at], ids[rows, at + 1])]
                keep = np.arange(m - 1)[None, :] + (np.arange(m - 1)[None, :] > at[:, None])  # the pair's right side goes
                ids = np.take_along_axis(ids, keep, axis=1)
                size -= 1
                less = np.arange(m - 2)[None, :] + (np.arange(m - 2)[None, :] >= at[:, None])
                rank = np.take_along_axis(rank, np.minimum(less, m - 2), axis=1)
                for side in (at - 1, at):  # pairs on both sides of the merged one are new
                    ok = np.flatnonzero((side >= 0) & (side + 1 < size))
                    p = self._place(ids[ok, side[ok]], ids[ok, side[ok] + 1])
                    rank[ok, side[ok]] = np.where(p >= 0, self.rank[p], never)
            for k, row, m in zip(ks, final, length.tolist(), strict=True):
                out[k] = row[:m].tobytes()
        return out

    def learn(self, chunks: set[bytes]) -> None:
        known, before, new = self.known, self.before, []
        if len(known) > _REMEMBERED:
            self.before = before = known
            self.known = known = {}
        for c in chunks:
            if c not in known:
                if c in before:
                    known[c] = before[c]
                else:
                    new.append(c)
        parts: list[bytes] = []
        plain: list[tuple[bytes, bool, bool]] = []
        for c in new:
            s = c.decode("utf-8", "replace")
            m = _PLAIN.fullmatch(s)
            word = m[1] if m else ""
            if m and len(s) <= 64 and (not word or word.lower().isalpha() and word.isalpha() and (word.isascii() or "\u03a3" not in word and unicodedata.is_normalized("NFC", word))) and "<|" not in m[2]:
                if word:
                    parts.append(word.lower().encode())
                if m[2]:
                    parts.append(m[2].encode())
                plain.append((c, bool(word), bool(m[2])))
            else:
                known[c] = np.array(self.model.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        got = iter(self.merged(parts))
        for c, one, two in plain:
            known[c] = (next(got) if one else b"") + (next(got) if two else b"")

    def encode(self, chunks: list[bytes]) -> bytes:
        return b"".join(map(self.known.__getitem__, chunks))


def word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def _chunks(text: str | None) -> list[bytes]:
    """White-space separated chunks; the tokenizer lower-cases, but knows its special strings by their case."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return raw.split() if b"<|" in raw else raw.lower().split()


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and end id, cut at the capacity."""
    out = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])
    end = np.array([END], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = word_ids(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                split = [_chunks(t) for t in part.column(1).to_pylist()]
                need: set[bytes] = set()
                need.update(*split)
                w.learn(need)
                rows = []
                for i, chunks in zip(part.column(0).to_pylist(), split, strict=True):
                    ids = w.encode(chunks) + end
                    for k, a in enumerate(range(0, len(ids), 4 * capacity)):
                        cut = ids[a : a + 4 * capacity]
                        rows.append((i, k, a // 4, len(cut) // 4, zlib.crc32(cut)))
                cols = list(zip(*rows, strict=True)) or [[] for _ in out]
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(cols, out, strict=True)], schema=out)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


def knapsack(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[np.ndarray, np.ndarray]:
    """For every room the greatest worth of sizes that fit, and the last of them (-1: as with one less). sizes ascend."""
    best, pick = np.zeros(room + 1), np.full(room + 1, -1)
    upto = np.searchsorted(sizes, np.arange(room + 1), "right")
    for c in range(int(sizes[0]), room + 1):
        got = best[c - sizes[: upto[c]]] + value[: upto[c]]
        j = int(got.argmax())
        best[c] = best[c - 1]
        if got[j] > best[c]:
            best[c], pick[c] = got[j], j
    return best, pick


def price(sizes: np.ndarray, demand: np.ndarray, room: int, took: dict[tuple[int, ...], float], weight: np.ndarray) -> None:
    """BATCH rounds of multiplicative weights; took (configuration of classes -> share) and weight are brought forward."""
    n = len(sizes)
    for _ in range(BATCH):
        value = weight / demand
        best, pick = knapsack(value, sizes, room)
        worth = value + best[room - sizes]  # of the best configuration that has the class
        seeds = np.flatnonzero(worth >= (1 - EPSILON / 4) * best[room])
        seeds = seeds[np.argsort(-weight[seeds], kind="stable")][:SEEDS]
        gain, steps = np.zeros(n), {}
        for s in seeds.tolist():
            held, c = [s], room - int(sizes[s])
            while c > 0:
                if pick[c] < 0:
                    c -= 1
                else:
                    held.append(int(pick[c]))
                    c -= int(sizes[pick[c]])
            key = tuple(sorted(held, reverse=True))
            if key not in steps:
                use = np.bincount(held, minlength=n)
                steps[key] = float((demand[use > 0] / use[use > 0]).min())
                gain += steps[key] * use / demand
        scale = EPSILON / gain.max()
        for key, step in steps.items():
            took[key] = took.get(key, 0.0) + scale * step
        weight *= np.exp(-2 * scale * gain)
        weight /= weight.max()


Runs = list[tuple[int, list[int]]]


def rounded(took: dict[tuple[int, ...], float], lengths: list[list[int]], whole: np.ndarray, up: float) -> tuple[Runs, np.ndarray]:
    """Whole counts of the configurations, fullest first, as far as there are pieces; and the pieces left."""
    stock, runs = whole.copy(), []
    size = {config: sum(lengths[c][0] for c in config) for config in took}
    scale = sum(k * int(whole[k]) for ks in lengths for k in ks) / sum(x * size[config] for config, x in took.items())
    for config, x in sorted(took.items(), key=lambda kx: (-size[kx[0]], -kx[1], kx[0])):
        left = int(x * scale + up)
        while left > 0:
            need: collections.Counter[int] = collections.Counter()
            for c in config:  # the longest length of the class still there, for each place
                need[next((k for k in lengths[c] if stock[k] > need[k]), 0)] += 1
            if need[0]:
                break
            need += collections.Counter()
            times = min(left, *(int(stock[k]) // m for k, m in need.items()))
            for k, m in need.items():
                stock[k] -= times * m
            runs.append((times, sorted(need.elements(), reverse=True)))
            left -= times
    return runs, stock


def best_fit(runs: Runs, stock: np.ndarray, capacity: int) -> Runs:
    """Runs with the stock: longest first, each length into the sequences with the least room for it, or into new ones."""
    by_room: dict[int, Runs] = collections.defaultdict(list)
    for n, held in runs:
        by_room[capacity - sum(held)].append((n, held))
    rooms = sorted(by_room)
    for k in np.flatnonzero(stock)[::-1].tolist():
        left = int(stock[k])
        while left:
            at = bisect.bisect_left(rooms, k)
            n, held, room = left, [], capacity
            if at < len(rooms):
                room = rooms[at]
                n, held = by_room[room].pop()
                if not by_room[room]:
                    del by_room[room], rooms[at]
            m = min(room // k, left)
            times = min(n, left // m)
            left -= times * m
            for c, h in ((times, [*held, *[k] * m]), (n - times if held else 0, held)):
                if c:
                    r = capacity - sum(h)
                    if r not in by_room:
                        bisect.insort(rooms, r)
                    by_room[r].append((c, h))
    return [x for v in by_room.values() for x in v]


def sequences(runs: Runs) -> int:
    return sum(n for n, _ in runs)


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """Runs (sequences, [(length, copies)]) that place every length as often as the histogram has it."""
    whole = np.zeros(capacity + 1, np.int64)
    for k, v in histogram.items():
        whole[k] = v
    least = max(-(-sum(k * v for k, v in histogram.items()) // capacity), int(whole[capacity // 2 + 1 :].sum()))
    chosen: Runs | None = None
    large = [k for k in sorted(histogram) if k > min(SMALL, capacity // 8)]
    if large:
        share = np.cumsum([float(k * histogram[k]) for k in large])
        of = np.arange(len(large)) if len(large) <= CLASSES else np.minimum(CLASSES - 1, (share / share[-1] * CLASSES).astype(int))
        lengths = [[k for k, c in zip(large, of, strict=True) if c == x][::-1] for x in np.unique(of)]
        sizes, demand = np.array([ks[0] for ks in lengths]), np.array([float(sum(histogram[k] for k in ks)) for ks in lengths])
        took: dict[tuple[int, ...], float] = {}
        weight = np.ones(len(sizes))
        for _ in range(ROUNDS // BATCH):
            price(sizes, demand, capacity, took, weight)
            plans = [best_fit(*rounded(took, lengths, whole, up), capacity) for up in (0.0, 0.5, 0.999)]
            now = min(plans, key=sequences)
            if chosen is not None and sequences(now) >= sequences(chosen):
                break
            chosen = now
            if sequences(chosen) == least:
                break
    plain = best_fit([], whole, capacity)
    if chosen is None or sequences(plain) < sequences(chosen):
        chosen = plain
    merged: dict[tuple[int, ...], int] = {}
    for times, held in chosen:
        key = tuple(sorted(held, reverse=True))
        merged[key] = merged.get(key, 0) + times
    return [(n, [(k, key.count(k)) for k in sorted(set(key), reverse=True)]) for key, n in merged.items()]


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, **columns) -> DataFrame:
    """One row per piece with its sequence and its offset there."""
    rows = stored(pieces(docs, path, capacity, **columns).withColumn("rid", F.monotonically_increasing_id())).withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    cells = stored(rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")))
    histogram = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    slots: dict[int, list[tuple[int, int, int, int]]] = {}  # length -> (first rank, first sequence, copies, offset)
    used: dict[int, int] = {}
    base = 0
    for n, held in plan(histogram, capacity):
        offset = 0
        for k, m in held:
            slots.setdefault(k, []).append((used.get(k, 0), base, m, offset))
            used[k] = used.get(k, 0) + n * m
            offset += k * m
        base += n
    shared = docs.sparkSession.sparkContext.broadcast({k: np.array(v, dtype=np.int64) for k, v in slots.items()})  # bounded by the histogram
    cells = cells.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).drop("n")
    k = F.row_number().over(Window.partitionBy("length", "salt").orderBy("rid")) - 1
    ranked = rows.join(cells, ["length", "salt"]).withColumn("rank", F.col("before") + k)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, off = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))  # never null
            for n in np.unique(length):
                here = np.flatnonzero(length == n)
                t = shared.value[int(n)]
                at = np.searchsorted(t[:, 0], rank[here], "right") - 1
                k = rank[here] - t[at, 0]
                seq[here], off[here] = t[at, 1] + k // t[at, 2], t[at, 3] + k % t[at, 2] * n
            yield pa.record_batch([*batch.columns[:-1], pa.array(seq), pa.array(off)], names=[*batch.schema.names[:-1], "sequence_id", "offset"])

    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    return ranked.select(*cols, "rank").mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(spark, table(spark, sf_dir, "documents"), sf_dir)
