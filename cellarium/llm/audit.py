"""Filter interaction audit: what each of five filters removes, in every order of applying them.

A document's failures are a mask of five bits, so a part (language) of any size is 32 cells of counts. A
Gray-code walk over the 32 sets of filters toggles one filter at a time: every cell keeps the number of its
active failures, and a cell enters or leaves the running survivors when that number leaves or reaches
zero. The 32 states are stored; every step of all 120 orders is a difference of two of them.

Only sums travel: equal texts meet as one row for each (text, part, labels), and a filter that looks at the
whole table (E) needs no join back to the documents, so a text that a third of all rows hold costs one row a
task.

Edge cases: a null text is empty, and so may equal other empty texts; a null language is the part ``""``; a
row with a null doc_id has no smaller doc_id and is smaller than none; rows that share doc_id and text are
no copies of each other (no id is smaller); several label rows of one doc_id count as their largest values,
null labels as 0; texts of any length count whole; other columns are ignored, whatever their names; a table without rows has
no parts and gives no rows; filters that nothing fails give zeros.
"""

from __future__ import annotations

from itertools import permutations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import GAP, bind, table, text_of

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
#: Least words; least percentage of distinct words; most percentage of capitals.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
COUNTS = ["n", "good", "toxic"]
RESULT = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_mask(text: Column) -> Column:
    """The bits of the filters that look at the text alone (A to D)."""
    words = F.filter(F.split(text, GAP), lambda w: w != "")
    sizes = bind(words, lambda w: F.struct(F.size(w).cast("long").alias("n"), F.size(F.array_distinct(w)).cast("long").alias("d")))
    capitals = F.octet_length(F.regexp_replace(text, "[^A-Z]+", ""))

    def bits(s: Column) -> Column:
        fails = [s["n"] < LEAST_WORDS, 100 * s["d"] < LEAST_DISTINCT * s["n"], 100 * capitals.cast("long") > MOST_CAPITALS * F.length(text), text.rlike(r"[#$%&*|]")]
        return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(fails)), F.lit(0))

    return bind(sizes, bits)


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents of every part by what they fail."""
    t = text_of("text")
    marks = labels.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("q"), F.max("toxic").alias("t"))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), own_mask(t).alias("mask"), F.unhex(F.sha2(F.encode(t, "UTF-8"), 256)).alias("digest"))
    rows = rows.join(marks, "doc_id", "left").withColumns({"q": (F.coalesce("q", F.lit(0)) == 1), "t": (F.coalesce("t", F.lit(0)) == 1)})
    kind = ["digest", "mask", "part", "q", "t"]
    ids = rows.groupBy(*kind, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("first")
    same = ids.groupBy(*kind).agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("loose"), first)
    least = same.groupBy("digest", "mask").agg(F.min("first.doc_id").alias("least"), F.collect_list(F.struct("part", "q", "t", "n", "loose", "first")).alias("x"))  # a row a part and label, not a document
    each = least.select("mask", "least", F.inline("x"))
    alone = F.col("loose") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
    split = F.inline(F.array(F.struct(F.col("mask").alias("m"), alone.alias("k")), F.struct((F.col("mask") + 16).alias("m"), (F.col("n") - alone).alias("k"))))
    flat = each.select("part", "q", "t", "mask", "n", "loose", "first", "least").select("part", "q", "t", split)
    share = lambda c: F.sum(F.when(F.col(c), F.col("k")).otherwise(0))
    return flat.groupBy("part", F.col("m").alias("mask")).agg(F.sum("k").alias("n"), share("q").alias("good"), share("t").alias("toxic"))


def states(masks: list[int], counts: list[tuple[int, ...]]) -> list[tuple[int, ...]]:
    """Survivors of every set of filters, by a walk that toggles one filter at a time."""
    active = [0] * len(masks)
    live = [sum(c) for c in zip(*counts, strict=True)]
    out = [tuple(live)] * SETS
    for k in range(1, SETS):
        now, bit = k ^ (k >> 1), k & -k
        on = 1 if now & bit else -1
        for c, mask in enumerate(masks):
            if mask & bit:
                was = active[c]
                active[c] += on
                if not was or not active[c]:  # it drops out, or comes back
                    live = [x - on * y for x, y in zip(live, counts[c], strict=True)]
        out[now] = tuple(live)
    return out


def audit_part(cell: pd.DataFrame) -> pd.DataFrame:
    """All steps of all orders of one part; cell: its 32 cells at most."""
    state = states(cell["mask"].tolist(), [tuple(map(int, r)) for r in cell[COUNTS].itertuples(index=False)])
    part, full, rows = cell["part"].iloc[0], SETS - 1, []
    total = [0] * len(FILTERS)
    for order in permutations(range(len(FILTERS))):
        done = 0
        for step, f in enumerate(order, 1):
            before, after = state[done], state[done | 1 << f]
            lost = [b - a for b, a in zip(before, after, strict=True)]
            fails = state[0][0] - state[1 << f][0]
            unique = state[full ^ 1 << f][0] - state[full][0]
            rows.append([part, "".join(FILTERS[k] for k in order), step, after[0], lost[0], fails - lost[0], unique, lost[1], lost[2], f])
            total[f] += lost[0]
            done |= 1 << f
    return pd.DataFrame([[*r[:-1], total[r[-1]]] for r in rows], columns=[c.split()[0] for c in RESULT.split(", ")])


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for every part, order and step. docs: (doc_id, text, lang); labels: (doc_id, quality, toxic)."""
    return cells(docs, labels).groupBy("part").applyInPandas(audit_part, RESULT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


SQL = r"""
with d as (select doc_id, coalesce(lang, '') as part, coalesce(text, '') as x from documents),
f as (select *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') as w from d),
least as (select x, min(doc_id) as lo from d group by x),
m as (select f.doc_id, part, (case when len(w) < 200 then 1 else 0 end) + (case when 100 * len(list_distinct(w)) < 50 * len(w) then 2 else 0 end)
    + (case when 100 * length(regexp_replace(x, '[^A-Z]+', '', 'g')) > 3 * length(x) then 4 else 0 end) + (case when regexp_matches(x, '[#$%&*|]') then 8 else 0 end)
    + (case when f.doc_id > lo then 16 else 0 end) as mask from f join least using (x)),
g as (select doc_id, max(quality) as q, max(toxic) as t from labels group by doc_id),
c as (select part, mask, count(*) as n, count(*) filter (q = 1) as good, count(*) filter (t = 1) as toxic from m left join g using (doc_id) group by part, mask),
one as (select unnest(range(5)) as f),
o as (select a.f as a, b.f as b, c.f as c, d.f as d, e.f as e from one a, one b, one c, one d, one e
      where (1 << a.f) | (1 << b.f) | (1 << c.f) | (1 << d.f) | (1 << e.f) = 31),
s as (select [a, b, c, d, e] as seq, unnest(range(1, 6)) as step from o),
p as (select *, seq[step] as f, list_sum([0] || list_transform(seq[1:step - 1], lambda y: 1 << y))::int as done, array_to_string(list_transform(seq, lambda y: 'ABCDE'[y + 1]), '') as filter_order from s),
r as (select part, filter_order, step, f, coalesce(sum(n) filter (mask & (done | (1 << f)) = 0), 0) as kept, coalesce(sum(n) filter (mask & done = 0 and mask & (1 << f) > 0), 0) as removed,
    coalesce(sum(n) filter (mask & done > 0 and mask & (1 << f) > 0), 0) as redundant, coalesce(sum(n) filter (mask = 1 << f), 0) as unique_fails,
    coalesce(sum(good) filter (mask & done = 0 and mask & (1 << f) > 0), 0) as good_lost, coalesce(sum(toxic) filter (mask & done = 0 and mask & (1 << f) > 0), 0) as toxic_lost
    from c, p group by part, filter_order, step, f)
select part, filter_order, step::int as step, kept::bigint as kept, removed::bigint as removed, redundant::bigint as redundant, unique_fails::bigint as unique_fails,
  good_lost::bigint as good_lost, toxic_lost::bigint as toxic_lost, (sum(removed) over (partition by part, f))::bigint as shapley from r
"""
