"""Chat formatting with rotated perspectives.

Every participant of a conversation gets a rendering of its own: that speaker's turns are the
assistant's, the turns of all others are user turns that carry the speaker's name, and turns of
``system`` stay system turns (``system`` is nobody's perspective). A rendering is the concatenation of its segments,

    <|im_start|>assistant\\n{text}<|im_end|>\\n
    <|im_start|>user name={speaker}\\n{text}<|im_end|>\\n
    <|im_start|>system\\n{text}<|im_end|>\\n

and the result has one row per segment with its place in the rendering and the span that is learnt: the text and end
mark of the assistant's turns. So no conversation, however long, is gathered in one value.

Turns are taken in the order of turn (NULL first), role, text. Places are sums over all earlier
segments, in two levels: within blocks of ``block`` turn numbers, and over the blocks' totals. A task holds a
block, and a hot conversation is many blocks.

A NULL role is the speaker "unknown", a NULL text is empty, and rows with a NULL conv_id form one conversation.
Repeated rows are turns of their own, numbered one after another. A conversation of system turns only has
no perspective and no rows; an empty table gives an empty one; other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ledgerlark.llm.common import read
from ledgerlark.llm.registry import query

BLOCK = 64
SYSTEM = "system"
_HEAD, _TAIL = "<|im_start|>", "<|im_end|>\n"


def _header(speaker: Column, perspective: Column | None) -> Column:
    named = F.concat(F.lit(_HEAD + "user name="), speaker, F.lit("\n"))
    if perspective is not None:
        named = F.when(speaker == perspective, F.lit(_HEAD + "assistant\n")).otherwise(named)
    return F.when(speaker == SYSTEM, F.lit(_HEAD + "system\n")).otherwise(named)


def rotate(
    turns: DataFrame, block: int = BLOCK, conv_col: str = "conv_id", turn_col: str = "turn",
    role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Per conversation, perspective and turn: the segment, its place, and the learnt span in it.

    ``place`` numbers the segments of a rendering from 0; all offsets are code points from its start.
    """
    # A key that is never NULL, so that joins and windows agree on how rows are dealt out.
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    # NULL turns come first: a block number below all others.
    rows = rows.withColumn("block", F.coalesce(F.floor(F.col("turn") / block), F.lit(-(1 << 62))).cast("long"))
    body = F.length("text") + len(_TAIL)
    as_user = F.length(_header(F.col("speaker"), None)) + body
    shorter = F.length(F.lit(_HEAD + "assistant\n")) - F.length(_header(F.col("speaker"), None))

    # Totals of a block: rows and length with everybody as user, and what a perspective changes.
    per_speaker = rows.groupBy("key", "block", "speaker").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(as_user).alias("size"),
        F.sum(F.when(F.col("speaker") == SYSTEM, 0).otherwise(shorter)).alias("change"),
    )
    per_block = per_speaker.groupBy("key", "block").agg(F.sum("n").alias("n"), F.sum("size").alias("size"))
    people = per_speaker.where(F.col("speaker") != SYSTEM).select("key", F.col("speaker").alias("perspective")).distinct()
    change = per_speaker.select("key", "block", F.col("speaker").alias("perspective"), "change")
    grid = per_block.join(people, "key").join(change, ["key", "block", "perspective"], "left")
    earlier = W.partitionBy("key", "perspective").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    sized = F.col("size") + F.coalesce("change", F.lit(0))
    starts = grid.select(
        "key",
        "block",
        "perspective",
        F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("places"),
        F.coalesce(F.sum(sized).over(earlier), F.lit(0)).alias("offset"),
    )
    out = rows.join(starts, ["key", "block"])
    out = out.withColumn("header", _header(F.col("speaker"), F.col("perspective")))
    length = F.length("header") + body
    inside = W.partitionBy("key", "block", "perspective").orderBy(
        F.col("turn").asc_nulls_first(), "speaker", "text"
    )
    start = F.col("offset") + F.sum(length).over(inside.rowsBetween(W.unboundedPreceding, 0)) - length
    learnt = F.col("speaker") == F.col("perspective")
    out = out.withColumn("start", start).withColumn("place", F.col("places") + F.row_number().over(inside) - 1)
    return out.select(
        "conv_id",
        "perspective",
        "place",
        "turn",
        "speaker",
        F.when(F.col("speaker") == SYSTEM, SYSTEM).when(learnt, "assistant").otherwise("user").alias("role"),
        F.concat("header", "text", F.lit(_TAIL)).alias("segment"),
        "start",
        (F.col("start") + length).alias("end"),
        F.when(learnt, F.col("start") + F.length("header")).alias("mask_start"),
        F.when(learnt, F.col("start") + length - 1).alias("mask_end"),
    )


def _oracle() -> str:
    head, tail = f"'{_HEAD}'", "'<|im_end|>' || chr(10)"
    return f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, coalesce(text, '') AS text,
    row_number() OVER () AS r FROM conversations),
p AS (SELECT DISTINCT conv_id, speaker AS perspective FROM t WHERE speaker <> '{SYSTEM}'),
s AS (
  SELECT t.conv_id, perspective, turn, speaker, text, r,
    CASE WHEN speaker = '{SYSTEM}' THEN {head} || 'system' || chr(10)
      WHEN speaker = perspective THEN {head} || 'assistant' || chr(10)
      ELSE {head} || 'user name=' || speaker || chr(10) END AS header
  FROM t JOIN p ON t.conv_id IS NOT DISTINCT FROM p.conv_id),
o AS (
  SELECT *, row_number() OVER w - 1 AS place,
    sum(length(header || text || {tail})) OVER (w ROWS UNBOUNDED PRECEDING) AS stop
  FROM s WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text, r))
SELECT conv_id, perspective, place::BIGINT AS place, turn, speaker,
  CASE WHEN speaker = '{SYSTEM}' THEN '{SYSTEM}' WHEN speaker = perspective THEN 'assistant' ELSE 'user' END AS role,
  header || text || {tail} AS segment,
  (stop - length(header || text || {tail}))::BIGINT AS start, stop::BIGINT AS "end",
  CASE WHEN speaker = perspective THEN (stop - length(text || {tail}))::BIGINT END AS mask_start,
  CASE WHEN speaker = perspective THEN (stop - 1)::BIGINT END AS mask_end
FROM o"""


@query(_oracle())
def op4_chat(spark, sf_dir):
    return rotate(read(spark, sf_dir, "conversations"))
