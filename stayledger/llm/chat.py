"""Multi-party chat formatting: every participant's view of a dialogue, with training masks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import col, file_stage, table

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
UNNAMED = "% \t\n\x0b\f\r<>|"  # characters of a name that are written as their codes, so names stay apart
BLOCK_TURNS = 256  # turns whose places are counted together
PART_SEGMENTS = 512  # segments of one rendered part


def _block(turn: Column) -> Column:
    return F.coalesce(F.floor(turn / BLOCK_TURNS), F.lit(-(2**62))).cast("long")


def _running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str) -> DataFrame:
    """`df` with the sum of `value` over earlier rows of its keys, in two steps.

    Rows are summed inside blocks of turns, and blocks (one row each) inside the keys, so that no
    task sorts all rows of a very long dialogue.
    """
    on = [*keys, "block"]
    blocks = df.groupBy(*on).agg(F.sum(value).alias("_held"))
    before = Window.partitionBy(*keys).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = file_stage(
        blocks.select(*on, F.coalesce(F.sum("_held").over(before), F.lit(0)).alias("_start")), "blocks"
    )
    inner = Window.partitionBy(*on).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        df.withColumn("_inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
        .join(starts, on)
        .withColumn(out, F.col("_start") + F.col("_inner"))
        .drop("_start", "_inner")
    )


def segments(
    messages: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
    system: Sequence[str] = ("system",),
) -> DataFrame:
    """One row per message and perspective.

    Every speaker of a dialogue but the system ones is a perspective. The speaker of the perspective
    becomes `assistant`, others become named users (white space, `%` and `<>|` in a name are written as
    `%` and their code), system messages stay. Columns: conversation,
    perspective, place (from 0), role, segment (rendered text), offset (code points before it in
    the whole rendering), mask_start and mask_end (the assistant's words and end mark, in code
    points of the whole rendering; null for all others).

    A null conversation id is one conversation of its own; null speakers are the speaker `unknown`;
    a null text is empty. Messages are ordered by turn (null first), then speaker and text; repeated
    messages stay, equal ones are interchangeable. A dialogue of system messages only has no
    perspective and no rows. Other columns are not carried along.
    """
    said = messages.select(
        F.when(col(conv_col).isNull(), "null")
        .otherwise(F.concat(F.lit("id "), col(conv_col).cast("string")))
        .alias("conv"),
        col(conv_col).alias("conversation"),
        col(turn_col).cast("long").alias("turn"),
        F.coalesce(col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("block", _block(F.col("turn")))
    order = ["turn", "speaker", "text"]
    placed = file_stage(
        _running(said.withColumn("one", F.lit(1).cast("long")), ["conv"], order, "one", "place"),
        "messages",
    )
    views = file_stage(
        placed.where(~F.col("speaker").isin(list(system)))
        .select("conv", F.col("speaker").alias("perspective"))
        .distinct(),
        "perspectives",
    )
    seen = placed.join(views, "conv")
    name = reduce(lambda c, x: F.replace(c, F.lit(x), F.lit(f"%{ord(x):02X}")), UNNAMED, F.col("speaker"))
    role = (
        F.when(F.col("speaker").isin(list(system)), "system")
        .when(F.col("speaker") == F.col("perspective"), "assistant")
        .otherwise("user")
    )
    head = F.concat(
        F.lit(OPEN),
        F.col("role"),
        F.when(F.col("role") == "user", F.concat(F.lit(" name="), name)).otherwise(""),
        F.lit("\n"),
    )
    body = F.regexp_replace("text", "<\\|", "< |")
    drawn = (
        seen.withColumn("role", role)
        .withColumn("head", head)
        .withColumn("segment", F.concat("head", body, F.lit(CLOSE)))
        .withColumn("length", F.length("segment").cast("long"))
    )
    at = _running(drawn, ["conv", "perspective"], ["place"], "length", "offset")
    spoken = F.col("role") == "assistant"
    return at.select(
        "conversation",
        "perspective",
        "place",
        "role",
        "segment",
        "offset",
        F.when(spoken, F.col("offset") + F.length("head")).alias("mask_start"),
        F.when(spoken, F.col("offset") + F.col("length")).alias("mask_end"),
    )


def rendered(parts_of: DataFrame, part_segments: int = PART_SEGMENTS) -> DataFrame:
    """Dialogues put together from `segments`: one row per conversation, perspective and part.

    A part holds `part_segments` segments at most, so one endless dialogue is many rows and not one;
    offset and masks count from the start of the dialogue, so parts join without gaps.
    """
    row = F.struct("place", "segment", "offset", "mask_start", "mask_end")
    grouped = (
        parts_of.withColumn("part", F.floor(F.col("place") / part_segments).cast("int"))
        .groupBy("conversation", "perspective", "part")
        .agg(F.sort_array(F.collect_list(row)).alias("rows"))
    )
    masked = F.filter("rows", lambda r: r["mask_start"].isNotNull())
    return grouped.select(
        "conversation",
        "perspective",
        "part",
        F.size("rows").alias("segments"),
        F.get(F.col("rows"), F.lit(0))["offset"].alias("offset"),
        F.array_join(F.transform("rows", lambda r: r["segment"]), "").alias("text"),
        F.transform(masked, lambda r: F.struct(r["mask_start"], r["mask_end"])).alias("masks"),
    )


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every participant's rendering of every conversation; masks as start:end joined by commas."""
    views = rendered(segments(table(spark, sf_dir, "conversations")))
    mask = F.transform(
        "masks",
        lambda m: F.concat_ws(":", m["mask_start"].cast("string"), m["mask_end"].cast("string")),
    )
    return views.select(
        F.col("conversation").alias("conv_id"),
        "perspective",
        "part",
        "segments",
        "offset",
        "text",
        F.array_join(mask, ",").alias("masks"),
    )


ORACLE = f"""
WITH placed AS (SELECT conv_id, role AS speaker, coalesce(text, '') AS text,
  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place
  FROM conversations),
views AS (SELECT DISTINCT conv_id, speaker AS perspective FROM placed WHERE speaker <> 'system'),
drawn AS (SELECT conv_id, perspective, place, speaker = perspective AS spoken,
  '{OPEN}' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
    ELSE 'user name=' || speaker END || chr(10) AS head,
  replace(text, '<|', '< |') || '<|im_end|>' || chr(10) AS tail
  FROM placed JOIN views USING (conv_id)),
offsets AS (SELECT *, CAST(coalesce(sum(length(head || tail)) OVER (PARTITION BY conv_id, perspective
  ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start FROM drawn)
SELECT conv_id, perspective, CAST(place // {PART_SEGMENTS} AS INTEGER) AS part,
  CAST(count(*) AS INTEGER) AS segments, min(start) AS "offset",
  string_agg(head || tail, '' ORDER BY place) AS text,
  coalesce(string_agg(CASE WHEN spoken THEN (start + length(head)) || ':'
    || (start + length(head) + length(tail)) END, ',' ORDER BY place), '') AS masks
FROM offsets GROUP BY ALL"""
