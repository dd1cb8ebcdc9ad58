"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant, everyone else as a named user and system turns as they
are. A rendering stays in long form, one row per turn: the segment's text, where
it stands in the rendered dialogue (code points), and the span of it that is
trained on (the assistant's words and the closing mark); the segments side by
side, in order of ``start``, are the whole rendering. No conversation is ever
gathered in one row or task: turns are dealt in chunks of ``CHUNK`` turn numbers,
where a chunk begins follows from sums of lengths, and texts are shuffled once.

DataFrame operations only.

Defined cases: a null role speaks as "unknown"; null text counts as empty; null
turns come first; equal turn numbers are ordered by role, then text; repeated
rows are rendered each; rows of a null conv_id are one conversation; a
conversation of system turns only has no participant and no rendering; control
marks inside texts and names are broken up, so that they can't open or close a
segment; other columns are ignored.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import prepare, whole_text

CHUNK = 64
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _safe(c: Column) -> Column:
    return F.replace(c, F.lit("<|im_"), F.lit("<| im_"))


def _turns(conversations: DataFrame) -> DataFrame:
    role = _safe(F.coalesce(F.col("role").cast("string"), F.lit("unknown")))
    turn = F.col("turn").cast("long")
    return (conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn"), role.alias("speaker"),
        _safe(whole_text()).alias("body"), F.floor(turn / CHUNK).alias("chunk")))


def _header(chat_role: Column, name: Column) -> Column:
    return F.concat(F.lit(OPEN), chat_role, F.when(chat_role == "user", F.concat(F.lit(" name="), name)).otherwise(""),
                    F.lit("\n"))


def rotate(conversations: DataFrame) -> DataFrame:
    """conv_id, perspective, turn, speaker, chat_role, segment, start, end, trained, mask_start, mask_end."""
    prepare(conversations.sparkSession)
    turns = _turns(conversations)
    closing = len(CLOSE) + 1
    system = F.col("speaker") == "system"
    as_other = F.char_length(_header(F.when(system, "system").otherwise("user"), F.col("speaker")))
    as_self = F.char_length(_header(F.lit("assistant"), F.col("speaker")))
    per_role = (turns.groupBy("conv_id", "chunk", "speaker")
                .agg(F.sum(as_other + F.char_length("body") + closing).alias("other"),
                     F.sum(F.when(system, 0).otherwise(as_self - as_other)).alias("less")))
    totals = per_role.groupBy("conv_id", "chunk").agg(F.sum("other").alias("other"))
    people = (turns.where(~system).select(F.col("conv_id").alias("pc"), F.col("speaker").alias("perspective")).distinct())
    grid = totals.join(people, F.col("conv_id").eqNullSafe(F.col("pc"))).drop("pc")
    own = per_role.select(F.col("conv_id").alias("oc"), F.col("chunk").alias("ok"),
                          F.col("speaker").alias("perspective"), "less")
    grid = (grid.join(own, F.col("conv_id").eqNullSafe(F.col("oc")) & F.col("chunk").eqNullSafe(F.col("ok"))
                      & (grid["perspective"] == own["perspective"]), "left")
            .select("conv_id", "chunk", grid["perspective"].alias("perspective"),
                    (F.col("other") + F.coalesce("less", F.lit(0))).alias("length")))
    earlier = (Window.partitionBy("conv_id", "perspective").orderBy(F.col("chunk").asc_nulls_first())
               .rowsBetween(Window.unboundedPreceding, -1))
    begins = grid.select(F.col("conv_id").alias("gc"), F.col("chunk").alias("gk"), "perspective",
                         F.coalesce(F.sum("length").over(earlier), F.lit(0)).alias("chunk_start"))
    rows = turns.join(begins, F.col("conv_id").eqNullSafe(F.col("gc")) & F.col("chunk").eqNullSafe(F.col("gk")))
    trained = ~system & (F.col("speaker") == F.col("perspective"))
    chat_role = F.when(system, "system").when(trained, "assistant").otherwise("user")
    rows = rows.withColumn("chat_role", chat_role).withColumn("header", _header(F.col("chat_role"), F.col("speaker")))
    length = F.char_length("header") + F.char_length("body") + closing
    inside = (Window.partitionBy("conv_id", "chunk", "perspective")
              .orderBy(F.col("turn").asc_nulls_first(), "speaker", "body").rowsBetween(Window.unboundedPreceding, 0))
    rows = rows.withColumn("end", F.col("chunk_start") + F.sum(length).over(inside))
    start = F.col("end") - length
    mask = F.col("chat_role") == "assistant"
    return rows.select(
        "conv_id", "perspective", "turn", "speaker", "chat_role",
        F.concat("header", "body", F.lit(CLOSE + "\n")).alias("segment"), start.alias("start"), "end",
        mask.alias("trained"), F.when(mask, start + F.char_length("header")).alias("mask_start"),
        F.when(mask, F.col("end") - 1).alias("mask_end"))


def oracle() -> str:
    """The same rendering as DuckDB SQL over ``conversations``."""
    safe = lambda c: f"replace({c}, '<|im_', '<| im_')"
    return f"""
WITH t AS (SELECT conv_id, turn, {safe("coalesce(role, 'unknown')")} AS speaker, {safe("coalesce(text, '')")} AS body
           FROM conversations),
p AS (SELECT DISTINCT conv_id AS pc, speaker AS perspective FROM t WHERE speaker <> 'system'),
r AS (SELECT t.*, perspective, CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
                                ELSE 'user' END AS chat_role
      FROM t JOIN p ON conv_id IS NOT DISTINCT FROM pc),
h AS (SELECT *, '{OPEN}' || chat_role || CASE WHEN chat_role = 'user' THEN ' name=' || speaker ELSE '' END || chr(10)
                AS header FROM r),
l AS (SELECT *, header || body || '{CLOSE}' || chr(10) AS segment FROM h),
e AS (SELECT *, sum(length(segment)) OVER (PARTITION BY conv_id, perspective
             ORDER BY turn NULLS FIRST, speaker, body ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS "end" FROM l)
SELECT conv_id, perspective, turn, speaker, chat_role, segment, "end" - length(segment) AS start, "end",
       chat_role = 'assistant' AS trained,
       CASE WHEN chat_role = 'assistant' THEN "end" - length(segment) + length(header) END AS mask_start,
       CASE WHEN chat_role = 'assistant' THEN "end" - 1 END AS mask_end
FROM e"""
