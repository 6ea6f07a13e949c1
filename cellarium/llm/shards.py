"""Minimax contiguous partition of documents into shards.

Documents with equal texts form an atomic group. Groups stand in the order of their text's digest, and
the smallest capacity is sought for which a greedy cut needs no more than the given number of shards.
The driver never holds the groups: it starts from the sums of 65,536 digest ranges and refines, a digit
at a time, only the ranges in which some cut can fall; every other range stays one number. The binary
search and the greedy checks run on these bounded sums and give the same capacity as on all groups.

Law: ``bytes``. Within the smallest capacity each cut goes as near to its even place as it can.

Edge cases: texts of any length count whole; other columns are ignored, whatever their names; a null text has no bytes and counts as the empty text; repeated rows each get a slot; null
ids stay; an empty table gives an empty result; with fewer groups than shards some shards stay empty.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored, table, text_of

SHARDS = 40
SALTS = 256
#: Most ranges that the driver refines at once.
DRIVER_ROWS = 100_000


def _greedy(prefix: np.ndarray, capacity: int, shards: int) -> list[int] | None:
    """Cuts (indices into prefix) of the greedy fill, or None if it needs more shards."""
    cuts, last = [0], len(prefix) - 1
    for _ in range(shards):
        nxt = int(np.searchsorted(prefix, prefix[cuts[-1]] + capacity, "right")) - 1
        if nxt == cuts[-1] and nxt < last:
            return None
        cuts.append(nxt)
        if nxt == last:
            return cuts + [last] * (shards + 1 - len(cuts))
    return None


def smallest_capacity(sizes: np.ndarray, shards: int, low: int = 0) -> int:
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    lo, hi = max(low, -(-int(prefix[-1]) // shards), 0), int(prefix[-1])
    while lo < hi:
        mid = (lo + hi) // 2
        lo, hi = (lo, mid) if _greedy(prefix, mid, shards) is not None else (mid + 1, hi)
    return lo


def even_cuts(sizes: np.ndarray, capacity: int, shards: int) -> list[int]:
    """Cuts that keep the capacity and lie as near to even places as it allows."""
    prefix = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
    last, total = len(prefix) - 1, int(prefix[-1])
    early = [last]
    for _ in range(shards):  # the earliest place of each cut from which the rest still fits
        early.append(int(np.searchsorted(prefix, prefix[early[-1]] - capacity, "left")))
    early = early[::-1]
    cuts = [0]
    for j in range(1, shards):
        far = int(np.searchsorted(prefix, prefix[cuts[-1]] + capacity, "right")) - 1
        near = max(early[j], cuts[-1])
        goal = total * j / shards
        k = int(np.searchsorted(prefix, goal))
        k = k - 1 if k and goal - prefix[k - 1] < (prefix[min(k, last)] - goal) else k
        cuts.append(min(max(k, near), far))
    return [*cuts, last]


def _ranges(ranges: list[tuple[str, int]], shards: int, low: int) -> set[int]:
    """Indices of the ranges in which a cut can fall."""
    sizes = np.array([s for _, s in ranges], dtype=np.int64)
    prefix = np.concatenate([[0], np.cumsum(sizes)])
    high = smallest_capacity(sizes, shards, low)
    first = last = 0
    need: set[int] = set()
    for _ in range(shards):
        first = max(int(np.searchsorted(prefix, prefix[first] + low, "right")) - 1, first)
        last = min(int(np.searchsorted(prefix, prefix[last] + high, "left")), len(sizes))
        need.update(range(first, min(last + 1, len(sizes))))
    return need


def boundaries(groups: DataFrame, shards: int = SHARDS) -> list[str]:
    """First digest of every shard. groups: (g: hex digest, bytes)."""
    at = lambda k: F.substring("g", 1, k)
    rows = groups.groupBy(at(4).alias("k")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n"), F.max("bytes").alias("most")).collect()  # 65,536 at most
    if not rows:
        return [""] * shards
    low = max(max(r["most"] for r in rows), -(-sum(r["b"] for r in rows) // shards))
    ranges, count = sorted((r["k"], r["b"]) for r in rows), {r["k"]: r["n"] for r in rows}
    while need := {ranges[i][0] for i in _ranges(ranges, shards, low) if len(ranges[i][0]) < 64}:
        whole = sum(count.get(k, 1) for k in need) <= DRIVER_ROWS
        by_length: dict[int, list[str]] = {}
        for k in need:
            by_length.setdefault(len(k), []).append(k)
        finer: dict[str, int] = {}
        for k, keys in by_length.items():
            part = groups.join(F.broadcast(groups.sparkSession.createDataFrame([(x,) for x in keys], "k string")), at(k) == F.col("k"), "left_semi")
            for r in part.groupBy(at(64 if whole else k + 1).alias("k")).agg(F.sum("bytes").alias("b"), F.count(F.lit(1)).alias("n")).collect():  # DRIVER_ROWS groups at most, else 16 parts of each of the few ranges in which a cut can fall
                finer[r["k"]], count[r["k"]] = r["b"], r["n"]
        ranges = sorted([(k, b) for k, b in ranges if k not in need] + list(finer.items()))
    sizes = np.array([b for _, b in ranges], dtype=np.int64)
    cuts = even_cuts(sizes, smallest_capacity(sizes, shards, low), shards)
    return [ranges[c][0] if c < len(ranges) else "g" for c in cuts[:-1]]  # "g" is beyond every digest


def shard(docs: DataFrame, shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for every document."""
    t = F.encode(text_of(text), "UTF-8")
    rows = stored(docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(t) + 16).cast("long").alias("size"), F.crc32(t).alias("text_crc32"), F.sha2(t, 256).alias("g"), F.monotonically_increasing_id().alias("rid")))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)))
    starts = boundaries(stored(rows.groupBy("g").agg(F.sum("size").alias("bytes"))), shards)
    place = F.size(F.filter(F.lit(starts), lambda s: s <= F.col("g"))) - 1
    cells = rows.groupBy("g", "salt").agg(F.count(F.lit(1)).alias("n")).withColumn("range", F.substring("g", 1, 4)).withColumn("shard", place)
    cells = stored(cells)
    heads = cells.groupBy("shard", "range").agg(F.sum("n").alias("m"))  # 65,536 + shards at most
    heads = heads.withColumn("off", F.sum("m").over(Window.partitionBy("shard").orderBy("range")) - F.col("m")).drop("m")
    run = F.sum("n").over(Window.partitionBy("shard", "range").orderBy("g", "salt")) - F.col("n")
    cells = cells.withColumn("run", run).join(F.broadcast(heads), ["shard", "range"]).select("g", "salt", "shard", (F.col("off") + F.col("run")).alias("off"))
    k = F.row_number().over(Window.partitionBy("g", "salt").orderBy("doc_id", "rid")) - 1
    return rows.join(cells, ["g", "salt"]).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("off") + k).alias("slot"), F.lit(None).cast("int").alias("grown_shard")
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))
