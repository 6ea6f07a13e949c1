"""Conversation structure repair: the cheapest edits that bring a dialogue's roles into ``(s?(ua)+)?``.

Edits of a row: Keep 0, Rerole (to user or assistant) 3, Delete 4 (required for blank rows and duplicates); Insert an
empty user or assistant row anywhere 3; a truncated row that stays adds 3. ``audit`` has the initials of the cheapest edits, of
equally cheap ones the ASCII-least.

* A node is (row, state), the state being what the roles so far allow (nothing yet, after system, after user, after
  assistant). A cost DP from the end gives every node the cost that is left; arcs that keep to it are optimal.
* Prefix doubling ranks the nodes by the least audits of 1, 2, 4, ... letters: the rank of twice the length is
  the pair of the node's rank and that of the node its pointer leads to, and pointers double along. From a node at
  most one optimal arc carries a letter, so the arc of the least (letter, rank of its target) begins the least
  audit, and the path's j-th node is read off the doubled pointers by the bits of j.

Scale: rows are sorted over (conversation, turn) into even parts, so a dialogue of a third of all rows spans many
parts and one part holds many dialogues. Inside a part all dialogues are worked at once in numpy. A dialogue that spans parts is
a chain of pieces: each gives the least costs from any state to any state (16 numbers), the chain is solved over
the pieces' numbers, and then each piece is repaired on its own. What one task must see of such a dialogue is what the
result asks for: its audit, and its repaired text once, streamed piece by piece through the hash.

Edge cases: null role or text is one space, as null conv_id or turn is in the damage key; rows with a null conv_id make one
dialogue; null turns come first; rows of one turn stand by role, then by the text's SHA-256, then in table order, so ties and repeats
have one order and a repeated row follows its original; a role whose first character is not s, u or a (an empty
role too) cannot be kept; texts of any length count whole; other columns are ignored, whatever their names; dialogues that lose all rows keep
a row of zeros; an empty table gives an empty result. turns must be reproducible (a table, not a sample).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

#: Rows and bytes of text of a part, about.
ROWS, BYTES = 8000, 4 << 20
SPACES = " \t\n\x0b\x0c\r"
NONE, SYSTEM, USER, ASSISTANT = range(4)  # states, and kinds of role
KINDS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 40
#: State after the only row of user or assistant that may follow.
NEXT = np.array([USER, USER, ASSISTANT, USER])
#: State after keeping a row, by its kind and the state before; -1: not allowed.
KEEP = np.array([[-1, -1, -1, -1], [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
LETTERS = "DIKR"
COSTS = {"D": 4, "I": 3, "K": 0, "R": 3}
CUT = 3


def damaged(turns: DataFrame) -> DataFrame:
    """(uid, conv_id, turn, role, text, digest, blank, cut): rows after the damage, each with what its text shows."""
    or_space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.encode(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn")), "UTF-8")) % 20
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), or_space("role").alias("role"), or_space("text").alias("text"), code.alias("code")).filter("code <> 0")
    text = F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    times = F.when(F.col("code") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = rows.select("conv_id", "turn", F.when(F.col("code") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(times).alias("copy")).drop("copy")
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    return rows.select(F.monotonically_increasing_id().alias("uid"), "*", F.unhex(F.sha2(F.encode("text", "UTF-8"), 256)).alias("digest"), (last == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))


def placed(rows: DataFrame, size: int, weight: int) -> DataFrame:
    """(pos, part, conv_id, turn, role, text, fault): rows in order, dealt into parts of some size rows and weight bytes."""
    at = F.struct(F.col("turn").isNotNull(), "turn", "uid")
    first = rows.groupBy("conv_id", "role", "digest").agg(F.min(at).alias("x")).select(F.col("x.uid").alias("uid"), F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated")
    n, b = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    rows = rows.join(first, "uid", "left").withColumn("fault", fault)
    order = ["conv_id", "turn", "role", "digest", "uid"]
    sort = rows.repartitionByRange(max(1, -(-n // size), -(-b // weight)), *order).sortWithinPartitions(*order)
    out = stored(sort.select(F.monotonically_increasing_id().alias("pos"), "conv_id", "turn", "role", "text", "fault"))
    return out.withColumn("part", F.shiftright("pos", 33))


class Part:
    """The dialogues (or pieces of them) of one part, one after the other: rows, nodes and their costs."""

    def __init__(self, rows: pa.Table) -> None:
        rows = rows.sort_by("pos")
        self.rows, conv = rows, rows.column("conv_id").to_pylist()
        cuts = [k for k in range(len(conv)) if k == 0 or conv[k] != conv[k - 1]]
        self.conv, self.start = [conv[k] for k in cuts], np.array(cuts, np.int64)
        self.size = np.diff(np.append(self.start, len(conv)))
        self.role, self.fault = rows.column("role").to_pylist(), rows.column("fault").to_pylist()
        self.kind = np.array([KINDS.get(r[:1], NONE) for r in self.role], np.int64)
        self.must = np.array([f in ("blank", "duplicate") for f in self.fault], bool)
        self.extra = np.array([CUT if f == "truncated" else 0 for f in self.fault], np.int64)
        self.head = self.start + np.arange(len(cuts))  # a dialogue of n rows has n + 1 nodes, times four states
        self.tail = self.head + self.size

    def costs(self, end: np.ndarray) -> np.ndarray:
        """Cost that is left at every node; end: at the last node of each dialogue, (dialogues, columns, 4)."""
        left = np.full((len(self.kind) + len(self.start), end.shape[1], 4), FAR, np.int64)
        left[self.tail] = end
        by_size = np.argsort(-self.size, kind="stable")
        for back in range(1, int(self.size.max(initial=0)) + 1):
            run = by_size[: np.searchsorted(-self.size[by_size], -back, "right")]
            row, node = self.start[run] + self.size[run] - back, self.tail[run] - back
            left[node] = _with_inserts(np.minimum(self._stay(row, left[node + 1]), COSTS["D"] + left[node + 1]))
        return np.minimum(left, FAR)

    def _stay(self, row: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Least cost of the rows if they are kept or reroled."""
        keep, rerole = self._kept(row, after), COSTS["R"] + self.extra[row][:, None, None] + after[:, :, NEXT]
        return np.where(self.must[row][:, None, None], FAR, np.minimum(keep, rerole))

    def _kept(self, row: np.ndarray, after: np.ndarray) -> np.ndarray:
        to = KEEP[self.kind[row]][:, None, :]
        cost = np.take_along_axis(after, np.broadcast_to(np.maximum(to, 0), after.shape), 2) + self.extra[row][:, None, None]
        return np.where(to < 0, FAR, cost)

    def paths(self, end: np.ndarray, last: np.ndarray) -> Paths:
        """Least optimal paths from every node; last: which dialogues end here and take no further rows."""
        left = self.costs(end[:, None, :])[:, 0]
        n = len(left)
        row = np.arange(n) - np.repeat(np.arange(len(self.start)), self.size + 1)
        inner = np.ones(n, bool)
        inner[self.tail] = False
        row[~inner] = 0
        state = np.arange(4)
        target, good = np.zeros((n, 4, 4), np.int64), np.zeros((n, 4, 4), bool)  # by node, state and letter
        node = np.arange(n)[:, None]
        if len(self.kind):
            below = np.minimum(node + 1, n - 1)
            after = left[below[:, 0]]
            extra, stays, kept = self.extra[row][:, None], (inner & ~self.must[row])[:, None], KEEP[self.kind[row]]
            for letter, to, cost, may in (
                ("D", np.broadcast_to(state, (n, 4)), np.int64(COSTS["D"]), inner[:, None]),
                ("K", np.maximum(kept, 0), extra, stays & (kept >= 0)),
                ("R", np.broadcast_to(NEXT, (n, 4)), extra + COSTS["R"], stays),
            ):
                k = LETTERS.index(letter)
                target[:, :, k] = 4 * below + to
                good[:, :, k] = may & (left == cost + np.take_along_axis(after, to, 1)) & (left < FAR)
        k, may = LETTERS.index("I"), inner.copy()
        may[self.tail] = last
        target[:, :, k] = 4 * node + NEXT
        good[:, :, k] = may[:, None] & (left == COSTS["I"] + left[:, NEXT]) & (left < FAR)
        return Paths(self, row, left, target.reshape(-1, 4), good.reshape(-1, 4))


def _with_inserts(left: np.ndarray) -> np.ndarray:
    once = left[..., NEXT]
    return np.minimum(left, np.minimum(COSTS["I"] + once, 2 * COSTS["I"] + once[..., NEXT]))


END = _with_inserts(np.array([0, FAR, FAR, 0]))


class Paths:
    """Ranks and doubled pointers over the optimal arcs of one part. A node's number is 4 * node + state."""

    def __init__(self, part: Part, row: np.ndarray, left: np.ndarray, target: np.ndarray, good: np.ndarray) -> None:
        self.part, self.row, self.left = part, row, left
        here = np.arange(len(target))
        letter, pointer = self._pick(here, target, good, np.zeros(len(target), np.int64))
        rank = letter
        while len(rank) and (letter[pointer] < len(LETTERS)).any():
            rank = np.unique(rank * (rank.max() + 1) + rank[pointer], return_inverse=True)[1]
            pointer = pointer[pointer]
        self.letter, pointer = self._pick(here, target, good, rank)
        self.jumps, self.length = [pointer], (self.letter < len(LETTERS)).astype(np.int64)
        while len(rank) and (self.letter[self.jumps[-1]] < len(LETTERS)).any():
            self.length = self.length + self.length[self.jumps[-1]]
            self.jumps.append(self.jumps[-1][self.jumps[-1]])

    @staticmethod
    def _pick(here: np.ndarray, target: np.ndarray, good: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The arc of the least (letter, rank of its target) of each node; ends have none and point at themselves."""
        if not len(here):
            return here, here
        key = np.where(good, np.arange(len(LETTERS)) * (rank.max() + 1) + rank[target], np.iinfo(np.int64).max)
        best = key.argmin(1)
        some = good.any(1)
        return np.where(some, best, len(LETTERS)), np.where(some, target[here, best], here)

    def exits(self, node: np.ndarray) -> np.ndarray:
        """State in which the least path from each node leaves the part."""
        return self.jumps[-1][node] % 4

    def nodes(self, node: int) -> np.ndarray:
        """All nodes of the least path from one node, but for its end."""
        step = np.arange(self.length[node])
        at = np.full(len(step), node)
        for k, jump in enumerate(self.jumps):
            at = np.where(step >> k & 1, jump[at], at)
        return at

    def repaired(self, run: int, state: int, text: list[str]) -> tuple[str, int, list[str]]:
        """Audit, its cost and the repaired rows of one dialogue from the given state on."""
        audit, cost, lines = [], 0, []
        for at in self.nodes(4 * int(self.part.head[run]) + state).tolist():
            letter, k, q = LETTERS[self.letter[at]], int(self.row[at // 4]), at % 4
            audit.append(letter)
            cost += COSTS[letter] + (int(self.part.extra[k]) if letter in "KR" else 0)
            if letter == "I":
                lines.append(f"{ROLE[int(NEXT[q])]}:")
            elif letter in "KR":
                lines.append(f"{self.part.role[k] if letter == 'K' else ROLE[int(NEXT[q])]}:{text[k]}")
        return "".join(audit), cost, lines


def _piece_costs(kind: str):
    def piece_costs(rows: pa.Table) -> pa.Table:
        """Of every piece: least costs from state to state, and the kinds of its last row."""
        part = Part(rows)
        unit = np.where(np.eye(4, dtype=bool), 0, FAR)[None].repeat(len(part.start), 0)
        cost = part.costs(unit)[part.head]
        return pa.table({
            "conv_id": pa.array(part.conv, rows.schema.field("conv_id").type), "part": pa.array([rows.column("part")[0].as_py()] * len(part.conv), pa.int64()),
            "cost": pa.array(cost.reshape(-1, 16).tolist(), pa.list_(pa.int64())), "final": pa.array(part.kind[part.start + part.size - 1], pa.int64()),
        })

    return piece_costs, f"conv_id {kind}, part long, cost array<long>, final long"


def _ends(pieces: pd.DataFrame) -> pd.DataFrame:
    """Cost that is left at the end of every piece of one dialogue, and the kind of the row before the piece."""
    pieces, left, out = pieces.sort_values("part"), END, []
    for cost in reversed(pieces["cost"].tolist()):
        out.append(left.tolist())
        left = np.minimum((np.array(cost).reshape(4, 4) + left[:, None]).min(0), FAR)  # cost by (state after, state before)
    pieces["left"] = out[::-1]
    pieces["before"] = [-1, *pieces["final"].tolist()[:-1]]
    pieces["last"] = [False] * (len(pieces) - 1) + [True]
    return pieces[["conv_id", "part", "left", "before", "last"]]


def _ended(part: Part, known: pa.Table) -> tuple[dict, np.ndarray, np.ndarray]:
    """What is known of the part's pieces by their dialogue, costs left at the ends, and which dialogues end here."""
    told = {r["conv_id"]: r for r in known.to_pylist()}
    end = np.array([told[c]["left"] if c in told else END for c in part.conv], np.int64).reshape(-1, 4)
    return told, end, np.array([c not in told or told[c]["last"] for c in part.conv], bool)


def _piece_exits(rows: pa.Table, known: pa.Table) -> pa.Table:
    part = Part(rows)
    told, end, last = _ended(part, known)
    leave = part.paths(end, last).exits(4 * part.head[:, None] + np.arange(4))
    keep = [told[c] for c in part.conv]
    return pa.Table.from_pylist([r | {"leave": x} for r, x in zip(keep, leave.tolist(), strict=True)], schema=known.schema.append(pa.field("leave", pa.list_(pa.int64()))))


def _entries(pieces: pd.DataFrame) -> pd.DataFrame:
    """State in which every piece of one dialogue begins."""
    pieces, state, out = pieces.sort_values("part"), NONE, []
    for leave in pieces["leave"]:
        out.append(state)
        state = int(leave[state])
    pieces["state"] = out
    return pieces[["conv_id", "part", "left", "before", "last", "state"]]


def _repair(rows: pa.Table, known: pa.Table) -> pa.Table:
    """Audit, cost, illegal neighbours and hash of every dialogue of a part; of pieces, the repaired text instead of the hash."""
    part, out = Part(rows), []
    told, end, last = _ended(part, known)
    paths, text = part.paths(end, last), part.rows.column("text").to_pylist()
    fine = np.isin(part.kind[:-1] * 4 + part.kind[1:], [SYSTEM * 4 + USER, USER * 4 + ASSISTANT, ASSISTANT * 4 + USER])
    bad = np.concatenate([[0], np.cumsum(~fine)])
    for run, conv in enumerate(part.conv):
        piece, a = told.get(conv), int(part.start[run])
        audit, cost, lines = paths.repaired(run, piece["state"] if piece else NONE, text)
        illegal = int(bad[a + part.size[run] - 1] - bad[a])
        if piece and piece["before"] >= 0:
            illegal += (piece["before"], int(part.kind[a])) not in ((SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER))
        whole = "\n".join(lines).encode()
        out.append((conv, rows.column("part")[0].as_py(), audit, cost, illegal, None if piece else hashlib.sha256(whole).hexdigest(), whole if piece and lines else None))
    names = ["conv_id", "part", "audit", "cost", "illegal", "repaired_sha256", "chunk"]
    types = [rows.schema.field("conv_id").type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    return pa.table([pa.array(list(c), t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=names)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces of dialogues in order: one row a dialogue, its text never in memory as a whole."""
    now, kind = None, None

    def row():
        conv, audit, cost, illegal, hashed, _ = now
        return pa.RecordBatch.from_arrays(
            [pa.array([conv], kind), pa.array(["".join(audit)], pa.string()), pa.array([cost], pa.int64()), pa.array([illegal], pa.int64()), pa.array([hashed.hexdigest()], pa.string())],
            ["conv_id", "audit", "cost", "illegal", "repaired_sha256"],
        )

    for batch in batches:
        kind = batch.schema.field("conv_id").type
        for k in range(batch.num_rows):
            conv, audit, cost, illegal, chunk = (batch.column(c)[k].as_py() for c in ("conv_id", "audit", "cost", "illegal", "chunk"))
            if now is None or now[0] != conv:
                if now is not None:
                    yield row()
                now = [conv, [], 0, 0, hashlib.sha256(), False]
            now[1].append(audit)
            now[2] += cost
            now[3] += illegal
            if chunk is not None:
                now[4].update(b"\n" if now[5] else b"")
                now[4].update(chunk)
                now[5] = True
    if now is not None:
        yield row()


def repair(turns: DataFrame, rows: int = ROWS, weight: int = BYTES) -> DataFrame:
    """A row for every conversation of turns: (conv_id, turn, role, text), after the damage of `damaged`."""
    kind = dict(turns.dtypes)["conv_id"]
    all_ = placed(stored(damaged(turns)), rows, weight)
    count = lambda c: F.sum((F.col("fault") == c).cast("long")).alias(c)
    spans = all_.groupBy("conv_id").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi"), (F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"), count("blank"), count("duplicate"), count("truncated")
    )
    spans = stored(spans)
    broken = spans.filter("lo < hi").select(F.col("conv_id").alias("_conv"))
    light = all_.drop("text", "turn").join(broken, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv")
    costs, shape = _piece_costs(kind)
    ends = light.groupBy("part").applyInArrow(costs, shape).groupBy("conv_id").applyInPandas(_ends, known := f"conv_id {kind}, part long, left array<long>, before long, last boolean")
    ends = stored(ends)
    exits = light.groupBy("part").cogroup(ends.groupBy("part")).applyInArrow(_piece_exits, f"{known}, leave array<long>")
    entries = exits.groupBy("conv_id").applyInPandas(_entries, f"{known}, state long")
    done = stored(all_.groupBy("part").cogroup(entries.groupBy("part")).applyInArrow(_repair, f"conv_id {kind}, part long, audit string, cost long, illegal long, repaired_sha256 string, chunk binary"))
    result = ["conv_id", "audit", "cost", "illegal", "repaired_sha256"]
    pieces = done.filter("repaired_sha256 is null").repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(_joined, done.select(*result).schema)
    fixed = done.filter("repaired_sha256 is not null").select(*result).unionByName(pieces)
    sums = ["gaps", "blank", "duplicate", "truncated"]
    both = turns.select("conv_id").distinct().unionByName(spans.select("conv_id", *sums), allowMissingColumns=True).unionByName(fixed, allowMissingColumns=True)
    value = lambda c, other: F.coalesce(F.max(c), F.lit(other)).alias(c)
    return both.groupBy("conv_id").agg(*[value(c, 0) for c in (*sums, "illegal", "cost")], value("audit", ""), value("repaired_sha256", hashlib.sha256(b"").hexdigest()))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
