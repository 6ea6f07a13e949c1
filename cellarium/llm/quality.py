"""Quality rules with adaptive thresholds from mergeable quantile sketches.

A sketch of a signal is a table (group, signal, bucket, count) over log-linear buckets: values under 64
have buckets of their own, larger ones share 32 buckets for each power of two (at most 3.2 % relative
error). Two sketches merge by adding counts, so the sketches of a language and of the whole corpus are
sums of those of (language, source) and cost no second pass. The fences that follow from the quartiles
replace fixed cutoffs; groups of fewer than ``min_group`` documents use their language's fences, and
small languages the corpus's.

Edge cases: a null text is an empty text; null language or source is a group of its own; repeated rows
count and are judged each on their own; a value at a fence is within it, and of equal quartile ranks the smaller bucket
counts; texts of any length are measured whole, their words being arrays of one row; an empty table gives an empty result; other columns are carried
untouched whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import GAP, bind, stored, table, text_of

SYMBOLS = "#*$%&|<>"
#: signal -> (numerator, denominator, scale, least spread): values are scale * numerator // denominator.
SIGNALS = {
    "word_length": ("word_chars", "n_words", 100, 60),
    "symbol_rate": ("n_symbols", "n_words", 1000, 25),
    "dup_line_rate": ("n_dup_lines", "n_lines", 1000, 200),
    "repeat_rate": ("n_repeat_words", "n_words", 1000, 120),
}
FENCE = 3
MIN_GROUP = 40
#: Fences are broadcast up to this many groups; beyond it the join is salted.
BROADCAST_GROUPS = 100_000
SALTS = 16


def _repeat_words(words: Column) -> Column:
    """Words that stand in a three-word window occurring twice or more in the text."""

    def spread(s: Column) -> Column:
        twin = F.filter(s, lambda x, k: F.coalesce(F.get(s, k - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["g"] == x["g"], F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(twin, lambda x: F.array(x["i"], x["i"] + 1, x["i"] + 2)))))

    def count(g: Column) -> Column:
        return F.when(F.size(F.array_distinct(g)) == F.size(g), 0).otherwise(
            bind(F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i")))), spread)
        )

    def grams(w: Column) -> Column:
        return F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.concat_ws(" ", x, F.get(w, i + 1), F.get(w, i + 2)))

    return bind(words, lambda w: bind(grams(w), count))


def signals(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source", carry: bool = False) -> DataFrame:
    """One row per document with its base counts; carry=True keeps the input row in the struct ``_doc``."""
    t = text_of(text)
    cols = [F.col(doc_id).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source"), t.alias("t")]
    if carry:
        cols.append(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_doc"))
    out = docs.select(*cols)
    out = out.withColumn("w", F.filter(F.split("t", GAP, -1), lambda x: x != ""))
    out = out.withColumn("l", F.filter(F.split("t", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")))
    return out.select(
        "doc_id", "lang", "source", *(["_doc"] if carry else []),
        F.size("w").cast("long").alias("n_words"),
        F.length(F.regexp_replace("t", GAP, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size("l").cast("long").alias("n_lines"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("w")).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def bucket(value: Column) -> Column:
    """Lower end of the log-linear bucket of a non-negative integer."""
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(F.call_function("shiftleft", F.call_function("shiftright", value, shift), shift))


def sketches(measured: DataFrame) -> DataFrame:
    """(lang, source, signal, bucket, n): the sketch of every signal in every (language, source)."""
    pairs = F.array(*[F.struct(F.lit(s).alias("signal"), F.floor(k * F.col(a) / F.greatest(F.col(b), F.lit(1))).cast("long").alias("v")) for s, (a, b, k, _) in SIGNALS.items()])
    one = measured.filter(~F.col("base_failed")).select("lang", "source", F.explode(pairs).alias("x"))
    return one.groupBy("lang", "source", F.col("x.signal").alias("signal"), bucket(F.col("x.v")).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


def fences(sketch: DataFrame, fence: int = FENCE, min_group: int = MIN_GROUP) -> DataFrame:
    """(lang, source, signal, lo, hi) for every group, from the narrowest sketch with enough documents."""
    merged = sketch.select("lang", "source", "signal", "bucket", "n", F.explode(F.array(*[F.lit(x) for x in (0, 1, 2)])).alias("level")).select(
        "level", F.when(F.col("level") < 2, F.col("lang")).alias("kl"), F.when(F.col("level") < 1, F.col("source")).alias("ks"), "signal", "bucket", "n"
    ).groupBy("level", "kl", "ks", "signal", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy("level", "kl", "ks", "signal")
    run = merged.withColumn("cum", F.sum("n").over(group.orderBy("bucket"))).withColumn("total", F.sum("n").over(group))
    at = lambda q: F.min(F.when(4 * F.col("cum") >= q * F.col("total"), F.col("bucket")))
    quart = run.groupBy("level", "kl", "ks", "signal").agg(at(1).alias("q1"), at(3).alias("q3"), F.max("total").alias("total"))
    least = F.create_map(*[x for s, (_, _, _, m) in SIGNALS.items() for x in (F.lit(s), F.lit(m))])
    spread = F.greatest(F.col("q3") - F.col("q1"), least[F.col("signal")])
    quart = quart.select("level", "kl", "ks", "signal", "total", (F.col("q1") - fence * spread).alias("lo"), (F.col("q3") + fence * spread).alias("hi"))
    a, b, c = (quart.filter(F.col("level") == k).alias(n) for k, n in ((0, "a"), (1, "b"), (2, "c")))
    same = F.col("a.signal") == F.col("b.signal")
    both = a.join(b, same & F.col("a.kl").eqNullSafe(F.col("b.kl"))).join(c, F.col("a.signal") == F.col("c.signal"))
    pick = lambda x: F.when(F.col("a.total") >= min_group, F.col(f"a.{x}")).when(F.col("b.total") >= min_group, F.col(f"b.{x}")).otherwise(F.col(f"c.{x}"))
    return both.select(F.col("a.kl").alias("f_lang"), F.col("a.ks").alias("f_source"), F.col("a.signal").alias("signal"), pick("lo").alias("lo"), pick("hi").alias("hi"))


def judge(measured: DataFrame, fence: int = FENCE, min_group: int = MIN_GROUP) -> DataFrame:
    """measured with ``kept``: false where the base rule failed or a signal lies beyond its group's fences."""
    f = stored(fences(sketches(measured), fence, min_group).groupBy("f_lang", "f_source").agg(
        F.map_from_entries(F.collect_list(F.struct("signal", F.struct("lo", "hi")))).alias("limits")))  # four entries a group
    d = measured.alias("d")
    on = F.col("d.lang").eqNullSafe(F.col("f.f_lang")) & F.col("d.source").eqNullSafe(F.col("f.f_source"))
    if f.count() <= BROADCAST_GROUPS:
        joined = d.join(F.broadcast(f.alias("f")), on, "left")
    else:
        d = measured.withColumn("_salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))).alias("d")
        f = f.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<long>"))).alias("f")
        joined = d.join(f, on & (F.col("d._salt") == F.col("f._salt")), "left")
    out = F.lit(False)
    for s, (a, b, k, _) in SIGNALS.items():
        v, lim = F.floor(k * F.col(f"d.{a}") / F.greatest(F.col(f"d.{b}"), F.lit(1))), F.col("f.limits")[s]
        out = out | F.coalesce((v < lim["lo"]) | (v > lim["hi"]), F.lit(False))
    return joined.select(*[F.col(f"d.{c}") for c in measured.columns], (~F.col("d.base_failed") & ~out).alias("kept"))


def quality_rules(docs: DataFrame, carry: bool = False, **columns) -> DataFrame:
    """Base counts, ``base_failed`` and ``kept`` for every document.

    The signals are computed once and written to the shared folder; with carry=True the whole input row
    comes back in the struct ``_doc``.
    """
    return judge(stored(signals(docs, carry=carry, **columns)))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with their own columns."""
    return quality_rules(docs, carry=True).filter("kept").select("_doc.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_GAP = r"[ \t\n\x0B\f\r]+"
_LEAST = " ".join(f"when '{s}' then {m}" for s, (_, _, _, m) in SIGNALS.items())
SQL = rf"""
with d as (select row_number() over () rid, doc_id, lang, source, coalesce(text, '') t from documents),
w as (select rid, list_filter(regexp_split_to_array(t, '{_GAP}'), lambda x: x <> '') w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) l from d),
g as (select rid, unnest(range(1, len(w) - 1)) i, w from w where len(w) >= 3),
gg as (select rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] gram from g),
gd as (select rid, i, count(*) over (partition by rid, gram) c from gg),
gp as (select rid, count(distinct p) n_repeat_words from (select rid, unnest([i, i + 1, i + 2]) p from gd where c > 1) group by rid),
m as (select d.rid, doc_id, lang, source, len(w)::BIGINT n_words,
             length(regexp_replace(t, '{_GAP}', '', 'g'))::BIGINT word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT n_symbols,
             len(l)::BIGINT n_lines, (len(l) - len(list_distinct(l)))::BIGINT n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT n_repeat_words
      from d join w using (rid) left join gp using (rid)),
b as (select *, (n_words < 50 or 100 * n_repeat_words > 50 * n_words) base_failed from m),
s as (select rid, lang, source, base_failed, p.signal, p.v from (select *, unnest([{{signal_list}}]) p from b)),
k as (select lang, source, signal, case when v < 64 then v else (v >> (length(bin(v)) - 6)::INT) << (length(bin(v)) - 6)::INT end bucket, count(*) n
      from s where not base_failed group by all),
lv as (select level, case when level < 2 then lang end kl, case when level < 1 then source end ks, signal, bucket, sum(n) n
       from k, (select unnest([0, 1, 2]) level) group by all),
c as (select *, sum(n) over (partition by level, kl, ks, signal order by bucket) cum, sum(n) over (partition by level, kl, ks, signal) total from lv),
q as (select level, kl, ks, signal, max(total) total, min(case when 4 * cum >= total then bucket end) q1, min(case when 4 * cum >= 3 * total then bucket end) q3
      from c group by all),
f as (select level, kl, ks, signal, total, q1 - {FENCE} * greatest(q3 - q1, least_) lo, q3 + {FENCE} * greatest(q3 - q1, least_) hi
      from (select *, case signal {_LEAST} end least_ from q)),
ff as (select x.kl, x.ks, x.signal,
              case when x.total >= {MIN_GROUP} then x.lo when y.total >= {MIN_GROUP} then y.lo else z.lo end lo,
              case when x.total >= {MIN_GROUP} then x.hi when y.total >= {MIN_GROUP} then y.hi else z.hi end hi
       from f x join f y on x.level = 0 and y.level = 1 and x.signal = y.signal and x.kl is not distinct from y.kl
       join f z on z.level = 2 and z.signal = x.signal),
o as (select s.rid, bool_or(s.v < ff.lo or s.v > ff.hi) outlier from s join ff on s.lang is not distinct from ff.kl and s.source is not distinct from ff.ks and s.signal = ff.signal group by s.rid)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       (not base_failed and not coalesce(outlier, false)) kept
from b left join o using (rid)
"""
SQL = SQL.replace("{signal_list}", ", ".join(f"{{'signal': '{s}', 'v': (({k} * {a}) // greatest({b}, 1))::BIGINT}}" for s, (a, b, k, _) in SIGNALS.items()))
