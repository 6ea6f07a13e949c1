"""Conversation repair, filter audit and recurring passages against brute force."""

import collections
import functools
import hashlib
import itertools
import re
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cellarium.llm import audit, chat, phrases, quality, repair

SF = "/root/testdata/sf0.001"
TURNS = "conv_id bigint, turn bigint, role string, text string, part string, uid int"


def words(t):
    return (t or "").encode().split()


# --- conversation repair ---


def damage(rows):
    out = []
    for k, (conv, turn, role, text) in enumerate(rows):
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text, k)] * (0 if code == 0 else 2 if code == 3 else 1)
    return out


def cheapest(rows):
    """rows: (initial, must be deleted, extra). Least (cost, audit, roles), over all edits with up to three inserts a gap."""
    sys.setrecursionlimit(20_000)
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}

    @functools.cache
    def best(i, q, inserts):
        found = [(0, "", ())] if i == len(rows) and q in ("", "a") else []
        for r in "ua":
            if (q, r) in step and inserts < 3 and (tail := best(i, step[q, r], inserts + 1)):
                found.append((3 + tail[0], "I" + tail[1], ((None, r), *tail[2])))
        if i < len(rows):
            ini, must, extra = rows[i]
            if tail := best(i + 1, q, 0):
                found.append((4 + tail[0], "D" + tail[1], tail[2]))
            for letter, r, cost in (("K", ini, 0), ("R", "u", 3), ("R", "a", 3)):
                if not must and (q, r) in step and (tail := best(i + 1, step[q, r], 0)):
                    found.append((cost + extra + tail[0], letter + tail[1], ((i, None if letter == "K" else r), *tail[2])))
        return min(found, default=None, key=lambda x: x[:2])

    return best(0, "", 0)


def expected(rows):
    by = collections.defaultdict(list)
    for r in damage(rows):
        by[r[0]].append(r)
    out = {}
    for conv in {r[0] for r in rows}:
        at = sorted(by[conv], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest(), r[4]))
        seen, faults = set(), []
        for r in at:
            body = r[3].strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not body else "duplicate" if r[2:4] in seen else "truncated" if body[-1] not in ".!?" else None)
            seen.add(r[2:4])
        cost, edits, roles = cheapest(tuple((r[2][:1] or "-", f in ("blank", "duplicate"), 3 if f == "truncated" else 0) for r, f in zip(at, faults, strict=True)))
        name = {"u": "user", "a": "assistant"}
        lines = [f"{name[role]}:" if i is None else f"{name.get(role, at[i][2])}:{at[i][3]}" for i, role in roles]
        ini = "".join(line[0] for line in lines)
        assert re.fullmatch("(s?(ua)+)?", ini)
        turns = [r[1] for r in at if r[1] is not None]
        illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(at))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def talk():
    rng = np.random.default_rng(5)
    rows = []
    for conv in range(40):
        for turn in range(int(rng.integers(1, 15))):
            role = str(rng.choice(["user", "assistant", "system", "tool", "", "usher", None], p=[0.35, 0.35, 0.1, 0.05, 0.05, 0.05, 0.05])) if rng.random() > 0.03 else None
            rows.append((conv, None if rng.random() < 0.05 else int(turn + 2 * (rng.random() < 0.1)), role, [f"text {rng.integers(4)}.", "No end", "", " \t", None, "Yes! ", "hm\x1c.\n"][rng.integers(7)]))
    rows += [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (None, 2, "assistant", "b."), (77, None, None, None)]
    return rows


@pytest.mark.parametrize("size", [repair.ROWS, 4])
def test_repair(spark, size):
    """With parts of four rows most dialogues are chains of pieces."""
    rows = talk()
    got = repair.repair(spark.createDataFrame([(*r, "clash", 1) for r in rows], TURNS), rows=size).collect()
    want = expected(rows)
    cols = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert len(got) == len(want)
    for r in got:
        assert tuple(r[c] for c in cols) == want[r.conv_id], r.conv_id


def test_repair_of_whole_table(spark):
    turns = spark.read.parquet(f"{SF}/conversations.parquet")
    want = expected([tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()])
    got = {r.conv_id: (r.cost, r.audit, r.repaired_sha256, r.illegal) for r in repair.query(spark, SF).collect()}
    assert got == {k: (v[5], v[6], v[7], v[4]) for k, v in want.items()}


def test_repair_of_one_long_dialogue(spark):
    """One conversation of a third of all rows, a long text in it, and repeated rows that all stand in one turn."""
    rows = [(1, k, ("user", "assistant", "user")[k % 3], f"turn {k % 50}." + "x" * (200_000 * (k == 7))) for k in range(300)]
    rows += [(2, 5, "user", "same.")] * 40 + [(3 + k // 4, k % 4, ("user", "assistant")[k % 2], f"t{k}.") for k in range(400)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in repair.repair(df, rows=30).collect()}
    assert got == expected(rows)
    empty = repair.repair(df.filter("false"))
    assert empty.collect() == [] and {"conv_id", "gaps", "audit", "repaired_sha256"} <= set(empty.columns)


# --- filter audit ---

DOCS = "doc_id bigint, text string, lang string, part string, q int, mask int"
LABELS = "doc_id bigint, quality int, toxic int, lang string"


def failures(rows):
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = words(t)
        caps = sum("A" <= c <= "Z" for c in t)
        copy = any(j is not None and i is not None and j < i and (u or "") == t for j, u, _ in rows)
        out.append((len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * caps > 3 * len(t), any(c in "#$%&*|" for c in t), copy))
    return out


def test_filter_audit(spark):
    long = " ".join(f"w{k}" for k in range(250))
    texts = [None, "", "A b", long, long.upper(), long + " #", "x " * 300, "x " * 300 + "#", long, long, "É \x1c|", "w " * 200_000]
    rows = [(k, t, ("en", None, "", "de")[k % 4]) for k, t in enumerate(texts * 2)] + [(None, long, "en"), (None, None, "en"), (3, long, "de"), (3, long, "de")]
    marks = [(k, k % 2, (k % 3 == 0) * 1) for k in range(0, 20)] + [(3, 1, None), (None, 1, 1), (4, None, None)]
    best = collections.defaultdict(lambda: [0, 0])
    for i, q, t in marks:
        if i is not None:
            best[i] = [max(best[i][0], q or 0), max(best[i][1], t or 0)]
    fails, want = failures(rows), {}
    for part in {r[2] or "" for r in rows}:
        here = [(f, best[r[0]] if r[0] is not None else [0, 0]) for r, f in zip(rows, fails, strict=True) if (r[2] or "") == part]
        shapley = collections.Counter()
        for order in itertools.permutations(range(5)):
            live = here
            for step, f in enumerate(order, 1):
                gone = [x for x in live if x[0][f]]
                live = [x for x in live if not x[0][f]]
                shapley[f] += len(gone)
                want[part, "".join("ABCDE"[k] for k in order), step] = [len(live), len(gone), sum(x[0][f] for x in here) - len(gone), sum(x[0][f] and sum(x[0]) == 1 for x in here), sum(x[1][0] == 1 for x in gone), sum(x[1][1] == 1 for x in gone), f]
        for k, v in want.items():
            if k[0] == part:
                v[-1] = shapley[v[-1]]
    docs = spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], DOCS).repartition(3)
    labels = spark.createDataFrame([(*m, "xx") for m in marks], LABELS)
    got = {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley] for r in audit.filter_audit(docs, labels).collect()}
    assert got == want and len(want) == 600 * 3
    assert audit.filter_audit(docs.filter("false"), labels).count() == 0
    assert audit.filter_audit(docs, labels.filter("false")).agg(F.sum("good_lost")).first()[0] == 0


def test_walk_toggles_give_all_states():
    masks = list(range(32))
    counts = [(m * m + 1, m, 1) for m in masks]
    assert audit.states(masks, counts) == [tuple(sum(c[k] for m, c in zip(masks, counts, strict=True) if not m & s) for k in range(3)) for s in range(32)]


# --- recurring passages ---


def stripped(rows):
    seen = collections.Counter()
    for _, t in rows:
        w = words(t)
        seen.update(tuple(w[k : k + 35]) for k in range(len(w) - 34))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone.update(range(k, k + 35))
        out.append((i, len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest()))
    return collections.Counter(out)


def passages():
    rng = np.random.default_rng(11)
    pick = lambda n, of=400: [f"v{x}" for x in rng.integers(0, of, n)]
    shared = [pick(n) for n in (34, 35, 36, 60, 200)]
    rows = []
    for k in range(120):
        body = pick(int(rng.integers(0, 120)))
        for _ in range(int(rng.integers(0, 3))):
            s = shared[rng.integers(len(shared))]
            a = int(rng.integers(0, 8))
            at = int(rng.integers(0, len(body) + 1))
            body[at:at] = s[a : len(s) - int(rng.integers(0, 8))]
        rows.append((k, " ".join(body)))
    near = pick(300)
    for k in range(30):
        w = list(near)
        w[int(rng.integers(300))] = f"odd{k}"
        rows.append((200 + k, "\t".join(w) + "\n"))
    rows += [(300, "a " * 100), (301, "a " * 35), (302, "a b " * 40), (303, None), (304, ""), (305, " \n "), (306, "A " * 34), (307, "ünï\x1c " * 36), (308, " ".join(pick(30_000, 10**6)))]
    return rows + [(None, rows[3][1]), (309, rows[7][1]), (309, rows[7][1])]


@pytest.mark.parametrize("block", [phrases.BLOCK, 3000])
def test_recurring_passages(spark, block):
    rows = passages()
    docs = spark.createDataFrame([(i, t, 5, "x") for i, t in rows], "doc_id bigint, text string, block int, h string").repartition(3).cache()
    got = collections.Counter(tuple(r) for r in phrases.substring_dedup(docs, block=block).collect())
    assert got == stripped(rows)
    assert phrases.substring_dedup(docs.filter("false")).count() == 0


def test_automaton_finds_overlapping_occurrences():
    a = phrases.automaton({(1, 2, 3), (3, 1), (2,)})
    assert phrases.covered(a, (1, 2, 3, 1, 5, 2, 3)).tolist() == [True, True, True, True, False, True, False]


# --- edge cases of earlier operators ---


def test_quality_of_a_very_long_text_and_ties_at_a_fence(spark):
    """Equal documents lie on both quartiles, so the fences follow from the least spread; a value at a fence stays, one beyond goes."""
    assert quality.SIGNALS["symbol_rate"][2:] == (1000, 25) and quality.FENCE == 3
    words = [f"w{k:03d}" for k in range(199)]
    text = lambda symbols: " ".join(["#" * symbols, *words])
    rows = [(k, " ".join(["w", *words]), "en", "s") for k in range(60)] + [(100, text(15), "en", "s"), (101, text(16), "en", "s"), (102, " ".join(f"x{k}" for k in range(300_000)), "en", "s")]
    got = {r.doc_id: r for r in quality.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert got[102].n_words == 300_000 and got[102].n_repeat_words == 0 and got[0].kept
    assert (got[100].n_symbols, got[100].n_words, got[100].kept) == (15, 200, True) and not got[101].kept


def test_dialogue_of_many_participants(spark):
    rows = [(1, k, f"speaker{k % 60}", f"t{k}") for k in range(120)]
    got = chat.rotate(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 60 and all(r.n_turns == 120 and r.n_own == 2 and r.text.count("<|im_start|>assistant") == 2 for r in got)


def test_repair_of_a_long_dialogue_without_id_and_of_named_ones(spark):
    """A null conv_id over many parts; ids that are texts, or too large for a double."""
    rows = [(None, k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(40)] + [(2**60 + 1, k, "user", f"t{k}.") for k in range(20)] + [(2**60 + 2, 1, "user", "t.")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: (r.cost, r.audit, r.repaired_sha256) for r in repair.repair(df, rows=4).collect()}
    assert got == {k: v[5:] for k, v in expected(rows).items()}
    named = [(None if c is None else f"c{c}", *r) for c, *r in rows]
    got = {r.conv_id: (r.cost, r.audit, r.repaired_sha256) for r in repair.repair(spark.createDataFrame(named, "conv_id string, turn bigint, role string, text string"), rows=4).collect()}
    assert got == {k: v[5:] for k, v in expected(named).items()}
