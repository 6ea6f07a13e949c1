"""Exact token counts by prefix dynamic programming.

Byte-pair merges have this property: the pieces of a prefix are the pieces of a shorter prefix and one more,
and of all pieces that end there only one stays apart from the last piece of what it leaves (``fits``). So one
pass over a text, from prefix to prefix, gives the last piece and the exact count of every prefix; nothing is
encoded again (``inner``). The table is kept in two levels. The vocabulary joins no pieces across the start of
a run of spaces or before a line feed (``_check``), so a text is cut there into chunks: the counts at the chunks'
ends are sums of whole chunks' counts, which the library gives for many distinct chunks at once, and the counts
at the prefixes inside a chunk come from the pass over that chunk. Truncation and budget questions are lookups
in this table (``count``, ``longest``).

Edge cases: a null or empty text has no tokens; repeated rows and null ids stay; other columns are ignored,
whatever their names; a text of any length, with or without spaces, takes time in proportion to it, and long chunks
are not remembered; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

LIMIT = 4096
_CHUNK = re.compile("\n[^ ▁\n]*|[ ▁]*[^ ▁\n]+|[ ▁]+")
#: Chunks and pairs of pieces that a worker remembers, and the longest of such chunks.
_REMEMBERED, _LONGEST = 400_000, 64
_loaded: dict = {}


class PieceCounter:
    """Counts of chunks and of their prefixes; a chunk starts with a space, a line feed or the text's own start."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = m = sentencepiece.SentencePieceProcessor(model_file=path)
        usable = [i for i in range(m.get_piece_size()) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i) or m.is_unused(i))]
        self.rank = {m.id_to_piece(i): -m.get_score(i) for i in usable}
        self._check()
        self.spaces = max(len(p) for p in self.rank if not p.strip("▁"))  # a run of spaces is cut into the longest such pieces and a rest
        self.rests = [0] + [len(m.encode(" " * k + "\n")) - 1 for k in range(self.spaces)]
        self.rank = {p: r for p, r in self.rank.items() if p.strip("▁") or p == "▁"}
        self.widest = max(map(len, self.rank))
        self.known: dict[str, int] = {}
        self._parts: dict[str, tuple[str, str]] = {}
        self._fits: dict[tuple[str, str], bool] = {}

    def _check(self) -> None:
        for piece in self.rank:
            rest = piece.lstrip("▁")
            if "▁" in rest or "\n" in rest[1:] or rest and len(piece) - len(rest) > 1:
                raise ValueError(f"piece {piece!r} crosses a chunk's edge: this vocabulary needs whole-text encoding")

    @staticmethod
    def chunks(text: str) -> list[str]:
        return _CHUNK.findall(" " + text)  # the model itself puts a space before every text

    def learn(self, chunks: set[str]) -> dict[str, int]:
        """Counts of all chunks. New ones are encoded at once; short ones are remembered."""
        new = [c for c in chunks if c not in self.known]
        if len(self.known) + len(new) > _REMEMBERED:
            self.known = {}
            new = list(chunks)
        ask, less = [], []
        for c in new:
            if c[0] == "\n":  # the space before it stays a piece of its own
                ask.append(c), less.append(1)
            elif c.strip(" ▁"):
                ask.append(c[1:]), less.append(0)
            else:
                ask.append(c[1:] + "\n"), less.append(1)
        got = {c: len(ids) - k for c, ids, k in zip(new, self.model.encode(ask, num_threads=1), less, strict=True)}
        self.known.update((c, n) for c, n in got.items() if len(c) <= _LONGEST)
        return got if len(got) == len(chunks) else {c: got[c] if c in got else self.known[c] for c in chunks}

    def prefixes(self, text: str, chunks: list[str] | None = None, counts: dict[str, int] | None = None) -> tuple[list[int], list[int]]:
        """Ends (code points of the text) and token counts of the prefixes at chunk ends."""
        if not text:
            return [0], [0]
        chunks = self.chunks(text) if chunks is None else chunks
        counts = self.learn(set(chunks)) if counts is None else counts
        return [e - 1 for e in accumulate(map(len, chunks))], list(accumulate(map(counts.__getitem__, chunks)))

    def _halves(self, piece: str) -> tuple[str, str]:
        """The two pieces whose merge makes the piece last."""
        if piece not in self._parts:
            parts = list(piece)
            while len(parts) > 2:
                best = min((self.rank[x + y], k) for k, (x, y) in enumerate(zip(parts, parts[1:], strict=False)) if x + y in self.rank)[1]
                parts[best : best + 2] = [parts[best] + parts[best + 1]]
            self._parts[piece] = (parts[0], parts[1])
        return self._parts[piece]

    def fits(self, left: str, right: str) -> bool:
        """Do two neighbouring pieces stay apart? Their merges are undone from the last; no pair on the way may merge earlier."""
        if (left, right) in self._fits:
            return self._fits[left, right]
        p, q, limit = left, right, float("inf")
        while True:
            if self.rank.get(p + q, limit) < limit:
                out = False
                break
            made_p, made_q = (self.rank[x] if len(x) > 1 else -1 for x in (p, q))
            if made_p < 0 and made_q < 0:
                out = True
                break
            if made_p > made_q:
                limit, p = made_p, self._halves(p)[1]
            else:  # of equal merges the left one comes first
                limit, q = made_q + 0.5, self._halves(q)[0]
        if len(self._fits) > _REMEMBERED:
            self._fits = {}
        self._fits[left, right] = out
        return out

    def inner(self, chunk: str, budget: int | None = None) -> list[int]:
        """Token counts of the chunk's prefixes of 0, 1, 2, ... characters; with a budget, only as far as any can keep it."""
        run = len(chunk) - len(chunk.lstrip(" ▁"))
        out = [k // self.spaces + self.rests[k % self.spaces] for k in range(run + 1)]
        before = out[run - 1] if run else 0  # the last space belongs to the word, unless it stays apart
        word = ("▁" if run else "") + chunk[run:]
        last, count, apart = [""], [0], [False]
        for i in range(1, len(word) + 1):
            for size in range(min(self.widest, i), 0, -1):
                piece, j = word[i - size : i], i - size
                if (size == 1 or piece in self.rank) and (not j or self.fits(last[j], piece)):
                    break
            last.append(piece)
            count.append(count[j] + (1 if piece in self.rank else len(piece.encode("utf-8", "surrogatepass"))))
            apart.append(apart[j] if j else piece == "▁")
            if i > (run > 0):
                out.append(out[run] + count[i] - 1 if apart[i] and run else before + count[i])
            if budget is not None and i > self.widest and min(count[-self.widest :]) + before > budget:
                break
        return out

    def count(self, text: str, ends: list[int], counts: list[int], at: int) -> int:
        """Tokens of the prefix of ``at`` code points."""
        if at <= 0:
            return 0
        k = bisect_right(ends, at)
        done, base = (ends[k - 1], counts[k - 1]) if k else (-1, 0)
        if done == at:
            return base
        part = text[max(done, 0) : at] if k else " " + text[:at]
        return base + self.inner(part)[-1]

    def longest(self, text: str, ends: list[int], counts: list[int], budget: int) -> int:
        """Code points of the longest prefix of at most ``budget`` tokens."""
        if counts[-1] <= budget:
            return len(text)
        k = bisect_right(counts, budget)
        done, base = (ends[k - 1], counts[k - 1]) if k else (-1, 0)
        part = text[done : ends[k]] if k else " " + text[: ends[0]]
        inside = self.inner(part, budget - base)
        return max(0, done + max(j for j, n in enumerate(inside) if n <= budget - base))

    def table(self, text: str) -> list[int]:
        """Token counts of the prefixes of 0, 1, 2, ... code points."""
        if not text:
            return [0]
        out, base = [], 0
        for chunk in self.chunks(text):
            out += [base + n for n in self.inner(chunk)[1:]]
            base = out[-1]
        return [0, *out[1:]]  # the first is the model's own space


def counter(path: str) -> PieceCounter:
    if path not in _loaded:
        _loaded[path] = PieceCounter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, doc_id: str = "doc_id", text: str = "text", tables: bool = False, ends: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fit_chars[, prefix_ends, prefix_tokens][, counts]) for every document.

    fit_chars: code points of the longest prefix within the limit. ends=True stores the table: code points and tokens at every chunk's
    end, from which `count` and `longest` answer for any prefix without encoding it; n_tokens is its last entry. tables=True adds the counts of all prefixes.
    """
    whole = pa.list_(pa.int32())
    out = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_()), ("fit_chars", pa.int64())] + [("prefix_ends", whole), ("prefix_tokens", whole)] * ends + [("counts", whole)] * tables)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                texts = [t or "" for t in part.column(1).to_pylist()]
                split = [c.chunks(t) for t in texts]
                need: set[str] = set()
                need.update(*split)
                known = c.learn(need)
                for i, t, ch in zip(part.column(0).to_pylist(), texts, split, strict=True):
                    stops, counts = c.prefixes(t, ch, known)
                    rows.append((i, len(t.encode("utf-8", "surrogatepass")), counts[-1], counts[-1] > limit, c.longest(t, stops, counts, limit), *((stops, counts) if ends else ()), *((c.table(t),) if tables else ())))
                cols = list(zip(*rows, strict=True)) or [[] for _ in out]
                yield pa.record_batch([pa.array(v, f.type) for v, f in zip(cols, out, strict=True)], schema=out)

    kinds = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean, fit_chars bigint" + ", prefix_ends array<int>, prefix_tokens array<int>" * ends + ", counts array<int>" * tables
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, kinds)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), ends=True)
