"""Multi-party perspective rotation of dialogues.

For every participant (role other than system) of a dialogue one training text is rendered: that speaker's
turns stand as ``assistant``, all others' as ``user`` turns that carry the speaker's name, system turns
stay. ``mask`` holds the spans (start:end, code points of ``text``) of the speaker's own words with their
end marks, which alone count in training.

Edge cases: turns are ordered by turn, role, text (nulls last), so ties have one order; repeated rows stay;
a null role is the speaker ``unknown``, control characters and line ends in a role are spaces (roles that then
are equal are one speaker), other columns are ignored, whatever their names, a null text is empty; a row with null conv_id belongs to no
dialogue and is rendered alone; dialogues of system turns only have no perspective; the marks are
neutralised where a turn's own text holds them. A dialogue's text must fit in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import table

#: What a name must not hold: it would end the turn's head.
CONTROL = r"[\x00-\x1F\x7F\x{85}\x{2028}\x{2029}]"
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def _head(role: Column, speaker: Column) -> Column:
    return (
        F.when(role == "system", F.lit(f"{BEGIN}system\n"))
        .when(role == speaker, F.lit(f"{BEGIN}assistant\n"))
        .otherwise(F.concat(F.lit(f"{BEGIN}user name="), role, F.lit("\n")))
    )


def rotate(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, speaker, n_turns, n_own, text, mask) for every participant of every dialogue."""
    clean = F.replace(F.coalesce(F.col(text).cast("string"), F.lit("")), F.lit("<|im_"), F.lit("<| im_"))
    base = turns.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), F.replace(F.regexp_replace(F.coalesce(F.col(role), F.lit("unknown")), CONTROL, " "), F.lit("<|im_"), F.lit("<| im_")).alias("role"), clean.alias("body"))
    dialogue = Window.partitionBy("conv_id")
    named = base.filter(F.col("conv_id").isNotNull()).withColumn("who", F.collect_set(F.when(F.col("role") != "system", F.col("role"))).over(dialogue))
    alone = base.filter(F.col("conv_id").isNull()).withColumn("who", F.array_compact(F.array(F.when(F.col("role") != "system", F.col("role")))))

    def parts(df: DataFrame) -> DataFrame:
        df = df.withColumn("speaker", F.explode("who"))
        head = _head(F.col("role"), F.col("speaker"))
        return df.select(
            "conv_id", "speaker", "turn", "role", (F.col("role") == F.col("speaker")).cast("int").alias("own"),
            F.concat(head, "body", F.lit(END)).alias("seg"), F.length(head).alias("skip"),
        )

    at = Window.partitionBy("conv_id", "speaker").orderBy(F.col("turn").asc_nulls_last(), "role", "seg")
    run = parts(named).withColumn("k", F.row_number().over(at))
    run = run.withColumn("before", F.sum(F.length("seg")).over(at.rowsBetween(Window.unboundedPreceding, -1)))
    start, end = F.coalesce("before", F.lit(0)) + F.col("skip"), F.coalesce("before", F.lit(0)) + F.length("seg")
    run = run.withColumn("span", F.when(F.col("own") == 1, F.concat_ws(":", start, end)))
    whole = run.groupBy("conv_id", "speaker").agg(F.sort_array(F.collect_list(F.struct("k", "seg", "span"))).alias("x"), F.count(F.lit(1)).alias("n_turns"), F.sum("own").cast("long").alias("n_own"))
    whole = whole.select("conv_id", "speaker", "n_turns", "n_own", F.array_join("x.seg", "").alias("text"), F.array_join("x.span", ",").alias("mask"))
    single = parts(alone).select("conv_id", "speaker", F.lit(1).cast("long").alias("n_turns"), F.col("own").cast("long").alias("n_own"), F.col("seg").alias("text"), F.concat_ws(":", "skip", F.length("seg")).alias("mask"))
    return whole.unionByName(single)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rotate(table(spark, sf_dir, "conversations"))


SQL = rf"""
with b as (select conv_id, turn, replace(regexp_replace(coalesce(role, 'unknown'), '{CONTROL}', ' ', 'g'), '<|im_', '<| im_') role, replace(coalesce(text, ''), '<|im_', '<| im_') body from conversations),
p as (select distinct conv_id, role speaker from b where role <> 'system'),
s as (select b.conv_id, speaker, turn, role, role = speaker own, body,
             case when role = 'system' then '<|im_start|>system' || chr(10) when role = speaker then '<|im_start|>assistant' || chr(10)
                  else '<|im_start|>user name=' || role || chr(10) end head
      from b join p on b.conv_id = p.conv_id),
r as (select *, head || body || '<|im_end|>' || chr(10) seg from s),
o as (select *, row_number() over w k, coalesce(sum(length(seg)) over (w rows between unbounded preceding and 1 preceding), 0) bef
      from r window w as (partition by conv_id, speaker order by turn nulls last, role, seg))
select conv_id, speaker, count(*) n_turns, count(*) filter (own) n_own, string_agg(seg, '' order by k) as text,
       string_agg((bef + length(head))::BIGINT || ':' || (bef + length(seg))::BIGINT, ',' order by k) filter (own) mask
from o group by conv_id, speaker
"""
