"""License scan: base phrases, and an exact set-similarity join of text blocks with notice templates.

A template is a notice's set of words T; a block is any run of ``span`` words of a text, over line breaks, where span is the
notice's own length and a tenth more. So words scattered over a long line make no notice, and a notice wrapped
at any column makes one. The join finds every (block, template) with |T & B| >= THRESHOLD * |T|. The templates'
words are ordered by the number of documents that have them, rarest first; alpha = ceil(THRESHOLD * |T|).

* A text meets a template only if it has one of the first |T| - alpha + 1 words (prefix filter) and alpha of its words
  (length filter).
* The places of the template's words in such a text fall into stretches, where no two neighbours are a block apart. A
  stretch goes on if it has alpha words and if its first word in the order leaves alpha to match: with pos words of T
  before that one, no more than |T| - pos can (prefix, length and positional filter again, closer by).
* What remains is counted exactly for all blocks at once. A place i whose word comes next at n counts once in the blocks
  that begin from i - span + 1 to min(i, n - span); a running sum over these ends gives the distinct words of every block.

Work and memory are linear in the text: each place of a template's word is one row and nothing of its neighbourhood is copied.

Edge cases: a null text is empty; repeated rows are scanned each on their own; null ids stay; other columns are ignored,
whatever their names; texts of any length are scanned whole, its words being one array of a row; texts without words give zero counts; an empty
table gives an empty result; words that stand in equally many documents are ordered by spelling.
"""

from __future__ import annotations

from math import ceil
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import bind, stored, table, text_of

GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Base phrases and their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
THRESHOLD = 0.9
#: Notices in common use, as (label, words).
TEMPLATES = [
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("apache-2.0", "you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("reserved", "all rights reserved"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
]


def templates(items: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> list[tuple[int, str, list[str], int]]:
    """(id, label, distinct words, words needed)"""
    sets = [(label, sorted(set(words.split()))) for label, words in items]
    return [(i, label, words, ceil(threshold * len(words) - 1e-9)) for i, (label, words) in enumerate(sets)]


def span(text: str) -> int:
    """Words of a window for a template."""
    return ceil(len(text.split()) / THRESHOLD)


def ordered(counts: dict[str, int]) -> list[tuple[int, str, list[str], int, int]]:
    """(id, label, words in global order, words needed, words of a block), given in how many documents words stand."""
    return [(i, label, sorted(words, key=lambda w: (counts.get(w, 0), w)), alpha, span(TEMPLATES[i][1])) for i, label, words, alpha in templates()]


def _met(own: Column, sought: list) -> Column:
    """Ids of the templates whose prefix and length filter the text's distinct words pass."""
    pass_ = lambda words, alpha: F.arrays_overlap(own, F.lit(words[: len(words) - alpha + 1])) & (F.size(F.array_intersect(own, F.lit(words))) >= alpha)
    return F.array_compact(F.array(*[F.when(pass_(words, alpha), F.lit(i)) for i, _, words, alpha, _ in sought]))


def _blocks(places: DataFrame, sought: list) -> DataFrame:
    """(rid, label, containment): the best block of every text and template that meets the threshold. places: (rid, met, i, word)."""
    words = [(w, i, label, rank, len(ws), alpha, size) for i, label, ws, alpha, size in sought for rank, w in enumerate(ws)]
    if max(w[4] for w in words) > 63:
        raise ValueError("a template has more than 63 distinct words")
    small = F.broadcast(places.sparkSession.createDataFrame(words, "word string, tpl int, label string, rank int, size int, alpha int, span int"))  # a fixed table
    at = places.join(small, "word").filter(F.array_contains("met", F.col("tpl")))
    run = Window.partitionBy("rid", "tpl").orderBy("i")
    at = at.withColumn("far", F.coalesce(F.col("i") - F.lag("i").over(run) >= F.col("span"), F.lit(True)).cast("int")).withColumn("stretch", F.sum("far").over(run))
    near = Window.partitionBy("rid", "tpl", "stretch")
    most = F.least(F.bit_count(F.bit_or(F.expr("shiftleft(1L, rank)")).over(near)), F.col("size") - F.min("rank").over(near))
    at = at.withColumn("most", most).filter("most >= alpha")
    at = at.withColumn("next", F.lead("i").over(Window.partitionBy("rid", "tpl", "rank").orderBy("i")))
    last = F.coalesce(F.least(F.col("i"), F.col("next") - F.col("span")), F.col("i"))
    ends = at.select("rid", "tpl", "label", "size", "alpha", F.inline(F.array(F.struct((F.col("i") - F.col("span") + 1).alias("s"), F.lit(1).alias("d")), F.struct((last + 1).alias("s"), F.lit(-1).alias("d")))))
    ends = ends.withColumn("now", F.sum("d").over(Window.partitionBy("rid", "tpl").orderBy("s")))  # peers count together
    best = ends.groupBy("rid", "tpl", "label", "size", "alpha").agg(F.max("now").alias("best")).filter("best >= alpha")
    return best.select("rid", "label", (F.col("best") / F.col("size")).alias("containment"))


def _starts(w: Column) -> Column:
    """(place, label) of every base phrase in the words w."""
    hit = None
    for phrase, label in PHRASES.items():
        here = lambda i, ws=phrase.split(), label=label: (F.coalesce(F.array_join(F.slice(w, i + 1, len(ws)), " ") == " ".join(ws), F.lit(False)), label)
        hit = (*(hit or ()), here)

    def at(x: Column, i: Column) -> Column:
        out = F.lit(None).cast("string")
        for f in reversed(hit):
            first, (ok, label) = f.__defaults__[0][0], f(i)
            out = F.when((x == first) & ok, F.lit(label)).otherwise(out)
        return F.struct(i.cast("long").alias("i"), out.alias("label"))

    return F.filter(F.transform(w, at), lambda x: x["label"].isNotNull())


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and places of base phrases, labels of phrases and templates, best containment."""
    vocabulary = sorted({w for _, _, words, _ in templates() for w in words})
    low = F.translate(text_of(text), ascii_uppercase, ascii_lowercase)
    w = F.filter(F.split("t", GAP, -1), lambda x: x != "")
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), F.col(doc_id).alias("doc_id"), low.alias("t")).withColumn("w", w)
    counted = texts.select(F.explode(F.array_distinct(F.filter("w", lambda x: x.isin(vocabulary)))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    sought = ordered({r["word"]: r["n"] for r in counted.collect()})  # at most the templates' words
    phrase = "(?:" + "|".join(GAP.join(p.split()) for p in PHRASES) + ")"
    own = F.array_distinct(F.filter("w", lambda x: x.isin(vocabulary)))
    place = F.transform("w", lambda x, i: F.when(x.isin(vocabulary), F.struct(i.alias("i"), x.alias("word"))))
    rows = stored(texts.withColumn("met", bind(own, lambda o: _met(o, sought))).select(
        "rid", "doc_id", F.size("w").cast("long").alias("n_words"), "met",
        F.when(F.col("t").rlike(phrase), _starts(F.col("w"))).otherwise(F.array().cast("array<struct<i:bigint,label:string>>")).alias("hits"),
        F.when(F.size("met") > 0, F.array_compact(place)).alias("places"),
    ))
    labels = _blocks(rows.filter("size(met) > 0").select("rid", "met", F.inline("places")), sought).groupBy("rid").agg(F.collect_set("label").alias("found"), F.max("containment").alias("score"))
    found = rows.drop("places", "met").join(labels, "rid", "left")
    base = F.array_sort(F.array_distinct("hits.label"))
    return found.select(
        "doc_id", "n_words", F.size("hits").cast("long").alias("n_base"), F.array_min("hits.i").alias("first_word"), F.array_max("hits.i").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(F.array_sort(F.array_union(base, F.coalesce("found", F.array().cast("array<string>")))), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))


_T = ", ".join(f"({i}, '{label}', {words!r}, {alpha}, {span(TEMPLATES[i][1])})" for i, label, words, alpha in templates())
_GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SQL = rf"""
with d as (select row_number() over () rid, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') t from documents),
w as (select rid, doc_id, t, list_filter(regexp_split_to_array(t, '{_GAP}'), lambda x: x <> '') w from d),
p as (select rid, unnest(range(1, len(w) + 1)) i, w from w where contains(t, 'cc') or contains(t, 'general') or contains(t, 'reserved')),
h as (select rid, i - 1 i, case when w[i] = 'cc' and w[i + 1] = 'by' then 'cc-by'
        when w[i] = 'general' and w[i + 1] = 'public' and w[i + 2] = 'license' then 'gpl'
        when w[i] = 'all' and w[i + 1] = 'rights' and w[i + 2] = 'reserved' then 'reserved' end label from p),
hb as (select rid, count(*) n_base, min(i) first_word, max(i) last_word, list(distinct label) bl from h where label is not null group by rid),
tpl(id, label, words, alpha, span) as (values {_T}),
cand as (select rid, w, label, words, alpha, span from (select rid, w, list_distinct(w) b from w), tpl where len(list_intersect(b, words)) >= alpha),
win as (select rid, label, words, alpha, list_slice(w, k, k + span - 1) part from (select *, unnest(range(1, len(w) + 1)) k from cand)),
m as (select rid, label, len(list_intersect(list_distinct(part), words)) / len(words) c from win where len(list_intersect(list_distinct(part), words)) >= alpha),
ml as (select rid, list(distinct label) found, max(c) score from m group by rid)
select doc_id, len(w)::BIGINT n_words, coalesce(n_base, 0)::BIGINT n_base, first_word::BIGINT first_word, last_word::BIGINT last_word,
       array_to_string(list_sort(coalesce(bl, [])), ',') base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(bl, []), coalesce(found, [])))), ',') labels, coalesce(score, 0.0)::DOUBLE score
from w left join hb using (rid) left join ml using (rid)
"""
