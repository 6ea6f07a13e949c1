"""Marginal document probability under a subword lattice.

A word is spelled by every path through the lattice of an existing vocabulary's pieces that covers it (bytes
spell characters that have no piece). The vocabulary's order gives first scores; ROUNDS expectation steps
over all distinct training words turn them into unigram log-probabilities; every type counts once, for what
q has to tell is how likely words are that were seen seldom or never. A log-space
forward recursion sums all segmentations of a word to q(w), and q sums to 1 over all words. The word as a
whole is one more arc of its lattice, weighted by its training count under absolute discounting:

    p(w) = (1 - e) * (max(c - d, 0) / C + d * V / C * q(w)),   p(end) = e = (documents + 1) / (N + 2)

with C the training words, V their types and d = n1 / (n1 + 2 n2). A document's score is the sum of log10 p
over its words and its end: the log of the product of the words' lattice sums, that is of the sum over all
segmentations of the document. ``lattice_score`` is the same without anything learnt from words: the lattice under
the vocabulary's first scores alone, p(w) = (1 - e) * q0(w).

Words with at least 1 / HEAD of all tokens (HEAD of them at most) are broadcast; all others meet their scores
in a join, so no table that grows with the corpus is held by a task or the driver.

Edge cases: words of any length are summed whole; other columns are ignored, whatever their names; a null or empty text is its end alone; a null id trains; repeated rows count and are scored each
on their own; without training documents q alone scores; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

ROUNDS = 2
HEAD = 500_000
#: Words that a task sums up at once, and counts that it holds before it passes them on.
BATCH, HELD = 150_000, 400_000
_BYTE = [f"<0x{b:02X}>" for b in range(256)]
_loaded: dict = {}


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


class Pieces:
    """The vocabulary as a trie in flat arrays, for lookups of many words at once."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        found, self.byte = [], np.zeros(256, np.int64)
        for i in range(model.get_piece_size()):
            p = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[_BYTE.index(p)] = i
            elif not (model.is_control(i) or model.is_unknown(i)) and "▁" not in p[1:]:
                found.append((p, i))
        self.size = model.get_piece_size()
        chars = sorted({c for p, _ in found for c in p})
        self.char = np.zeros(0x110000, np.int32)
        self.char[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.wide = len(chars) + 1
        self.longest = max(len(p) for p, _ in found)
        ends = [-1]
        edges: dict[int, int] = {}
        for p, i in found:
            at = 0
            for c in p:
                key = at * self.wide + int(self.char[ord(c)]) + 1
                if key not in edges:
                    edges[key] = len(ends)
                    ends.append(-1)
                at = edges[key]
            ends[at] = i
        self.end = np.array(ends, np.int64)
        self.bits = max(16, (4 * len(edges)).bit_length())
        self.key, self.to = np.zeros(1 << self.bits, np.int64), np.zeros(1 << self.bits, np.int32)
        for key, to in edges.items():
            h = self._slot(np.array([key]))[0]
            while self.key[h]:
                h = (h + 1) & ((1 << self.bits) - 1)
            self.key[h], self.to[h] = key, to

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def first_scores(self) -> np.ndarray:
        """Log-probabilities by the vocabulary's order."""
        p = 1.0 / (np.arange(self.size) + 100.0)
        return np.log(p / p.sum())

    def arcs(self, ch: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) for character codes ch of shape (length, words)."""
        length, out = ch.shape[0], []
        for i in range(length):
            rows, node = np.arange(ch.shape[1]), np.zeros(ch.shape[1], np.int64)
            for j in range(i, min(length, i + self.longest)):
                key = node * self.wide + ch[j, rows] + 1
                h = self._slot(key)
                got = self.key[h]
                while len(miss := np.flatnonzero((got != key) & (got != 0))):
                    h[miss] = (h[miss] + 1) & ((1 << self.bits) - 1)
                    got[miss] = self.key[h[miss]]
                on = got == key
                rows, node = rows[on], self.to[h[on]].astype(np.int64)
                if not len(rows):
                    break
                p = self.end[node]
                is_end = p >= 0
                if is_end.any():
                    out.append((i, j + 1, rows[is_end], p[is_end]))
        return out


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def _fallback(v: Pieces, codes: np.ndarray) -> list[tuple[int, np.ndarray, list[int]]]:
    """(position, rows, byte pieces) of characters without a piece of their own; codes: (length, words)."""
    single = v.char[codes]
    lone = single == 0
    known = np.flatnonzero(~lone.ravel())
    if len(known):  # a character may stand in longer pieces only
        key = single.ravel()[known].astype(np.int64) + 1
        h = v._slot(key)
        got = v.key[h]
        while len(miss := np.flatnonzero((got != key) & (got != 0))):
            h[miss] = (h[miss] + 1) & ((1 << v.bits) - 1)
            got[miss] = v.key[h[miss]]
        bad = (got != key) | (v.end[v.to[h]] < 0)
        lone.ravel()[known[bad]] = True
    out = []
    for i in np.flatnonzero(lone.any(axis=1)).tolist():
        rows = np.flatnonzero(lone[i])
        for c in np.unique(codes[i, rows]).tolist():
            out.append((i, rows[codes[i, rows] == c], [int(v.byte[b]) for b in chr(c).encode("utf-8", "surrogatepass")]))
    return out


def lattice(v: Pieces, words: list[str], logp: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """log q of every word; with weights also the pieces' expected counts over all of them."""
    total = np.zeros(len(words))
    counts = None if weight is None else np.zeros(v.size)
    by_length: dict[int, list[int]] = {}
    for k, w in enumerate(words):
        by_length.setdefault(len(w) + 1, []).append(k)
    for n, ks in by_length.items():
        width = max(1, min(len(ks), 4_000_000 // n))
        for at in range(0, len(ks), width):
            part = ks[at : at + width]
            text = "".join("▁" + words[k] for k in part)
            codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), n).T.astype(np.int64)
            arcs = v.arcs(v.char[codes].astype(np.int64))
            spelled = _fallback(v, codes)
            into: list[list] = [[] for _ in range(n + 1)]
            for i, j, rows, p in arcs:
                into[j].append((i, rows, logp[p]))
            for i, rows, bs in spelled:
                into[i + 1].append((i, rows, np.full(len(rows), logp[bs].sum())))
            a = np.full((n + 1, len(part)), -np.inf)
            a[0] = 0
            for j in range(1, n + 1):
                for i, rows, lp in into[j]:
                    a[j, rows] = np.logaddexp(a[j, rows], a[i, rows] + lp)
            total[part] = a[n]
            if counts is None:
                continue
            b = np.full((n + 1, len(part)), -np.inf)
            b[n] = 0
            for j in range(n, 0, -1):
                for i, rows, lp in into[j]:
                    b[i, rows] = np.logaddexp(b[i, rows], b[j, rows] + lp)
            c = weight[part]
            for i, j, rows, p in arcs:
                counts += np.bincount(p, np.exp(a[i, rows] + logp[p] + b[j, rows] - a[n, rows]) * c[rows], v.size)
            for i, rows, bs in spelled:
                x = float((np.exp(a[i, rows] + logp[bs].sum() + b[i + 1, rows] - a[n, rows]) * c[rows]).sum())
                for p in bs:
                    counts[p] += x
    return total, counts


def word_counts(docs: DataFrame) -> DataFrame:
    """(w, c): every distinct word of (doc_id, text) with its count in training documents."""
    out = pa.schema([("w", pa.binary()), ("c", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train: Counter = Counter()
        other: set[bytes] = set()

        def flush() -> pa.RecordBatch:
            ws = [*train, *(other - train.keys())]
            cs = [*train.values(), *[0] * (len(ws) - len(train))]
            train.clear(), other.clear()
            return pa.record_batch([pa.array(ws, pa.binary()), pa.array(cs, pa.int64())], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    if t:
                        (other if held_out(i) else train).update(t.encode("utf-8", "surrogatepass").lower().split())
                if len(train) + len(other) > HELD:
                    yield flush()
        yield flush()

    return docs.mapInArrow(run, "w binary, c bigint").groupBy("w").agg(F.sum("c").alias("c"))


def expected_counts(table_: DataFrame, path: str, logp: np.ndarray) -> np.ndarray:
    """One expectation step over the training words."""
    shared = table_.sparkSession.sparkContext.broadcast(logp)  # the vocabulary's size
    out = pa.schema([("piece", pa.int32()), ("n", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, sums, ws = pieces(path), None, []

        def add() -> None:
            nonlocal sums
            _, n = lattice(v, ws, shared.value, np.ones(len(ws)))
            sums = n if sums is None else sums + n
            ws.clear()

        for batch in batches:
            ws += [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            if len(ws) >= BATCH:
                add()
        if ws:
            add()
        if sums is not None:
            k = np.flatnonzero(sums)
            yield pa.record_batch([pa.array(k, pa.int32()), pa.array(sums[k])], schema=out)

    rows = table_.filter("c > 0").select("w").mapInArrow(run, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    found = np.zeros(len(logp))
    for r in rows:
        found[r["piece"]] = r["n"]
    return found


def fit(table_: DataFrame, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Log-probabilities of the pieces."""
    logp = pieces(path).first_scores()
    for _ in range(rounds):
        p = expected_counts(table_, path, logp) + 0.01
        logp = np.log(p / p.sum())
    return logp


def score(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, head: int = HEAD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, lattice_score) for every document."""
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    seen = stored(word_counts(docs))
    t = seen.agg(F.sum("c").alias("c"), F.sum((F.col("c") > 0).cast("long")).alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("n1"), F.sum((F.col("c") == 2).cast("long")).alias("n2")).first()
    ends = docs.filter(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2, F.lit(True))).count()
    words, types = t["c"] or 0, t["v"] or 0
    tokens = words + ends
    cut = t["n1"] / (t["n1"] + 2 * t["n2"]) if t["n1"] and t["n2"] else 0.5
    log_all = math.log10(tokens + types + (1 if ends else 0) + 1)
    p_end = (ends + 1) / (tokens + 2)
    logp = spark.sparkContext.broadcast(fit(seen, path, rounds) if words else pieces(path).first_scores())
    scored = pa.schema([("w", pa.binary()), ("c", pa.int64()), ("lp", pa.float64()), ("lq", pa.float64())])

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v, ws, cs = pieces(path), [], []

        def done() -> pa.RecordBatch:
            spelled = [w.decode("utf-8", "replace") for w in ws]
            q, _ = lattice(v, spelled, logp.value)
            pure, _ = lattice(v, spelled, v.first_scores())
            c = np.array(cs, dtype=float)
            low = math.log(cut * types / words) + q if words else q
            with np.errstate(divide="ignore"):
                p = np.logaddexp(low, np.log(np.maximum(c - cut, 0) / words)) if words else low
            out = pa.record_batch([pa.array(ws, pa.binary()), pa.array(cs, pa.int64()), *(pa.array((x + math.log1p(-p_end)) / math.log(10)) for x in (p, pure))], schema=scored)
            ws.clear(), cs.clear()
            return out

        for batch in batches:
            ws += batch.column(0).to_pylist()
            cs += batch.column(1).to_pylist()
            if len(ws) >= BATCH:
                yield done()
        if ws:
            yield done()

    known = stored(seen.mapInArrow(spell, "w binary, c bigint, lp double, lq double"))
    common = known.filter(F.col("c") >= max(2, math.ceil(tokens / head))).collect() if tokens else []  # at most ``head`` rows
    top = spark.sparkContext.broadcast({bytes(r["w"]): (math.log10(r["c"] + 1), r["lp"], r["lq"]) for r in common})
    rows = pa.schema([("rid", pa.int64()), ("w", pa.binary()), ("n", pa.int32()), ("p", pa.struct([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()), ("score", pa.float64()), ("pure", pa.float64())]))])
    at_end = (math.log10(ends + 1), math.log10(p_end), math.log10(p_end))

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each rarer word of a document, and one with the sums of its common ones."""
        get = top.value.get
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                rid, w, n, p = [], [], [], []
                for r, i, t in zip(*(part.column(k).to_pylist() for k in range(3)), strict=True):
                    ws = t.encode("utf-8", "surrogatepass").lower().split() if t else []
                    known_here, base, full, pure = int(ends > 0), *at_end
                    for x, k in Counter(ws).items():
                        found = get(x)
                        if found is None:
                            rid.append(r), w.append(x), n.append(k), p.append(None)
                        else:
                            known_here += k
                            base += k * found[0]
                            full += k * found[1]
                            pure += k * found[2]
                    # no word has a space, so this key joins with nothing and spreads evenly
                    rid.append(r), w.append(b" %d" % r), n.append(0)
                    p.append({"doc_id": i, "n_tokens": len(ws) + 1, "n_known": known_here, "base": base, "score": full, "pure": pure})
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip((rid, w, n, p), rows, strict=True)], schema=rows)

    kind = "rid bigint, w binary, n int, p struct<doc_id:bigint,n_tokens:bigint,n_known:bigint,base:double,score:double,pure:double>"
    all_parts = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text").mapInArrow(parts, kind)
    met = all_parts.join(known, "w", "left")
    k = F.col("n")
    out = met.groupBy("rid").agg(
        F.max("p.doc_id").alias("doc_id"), F.max("p.n_tokens").alias("n_tokens"),
        F.sum(F.coalesce("p.n_known", F.when(F.col("c") > 0, k), F.lit(0))).alias("n_known"),
        F.sum(F.coalesce("p.base", k * F.log10(F.col("c") + 1))).alias("base"), F.sum(F.coalesce("p.score", k * F.col("lp"))).alias("score"), F.sum(F.coalesce("p.pure", k * F.col("lq"))).alias("lattice_score"),
    )
    out_held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2, F.lit(False))
    return out.select("doc_id", out_held.alias("held_out"), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), (F.col("base") - F.col("n_tokens") * log_all).alias("base_score"), "score", "lattice_score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
