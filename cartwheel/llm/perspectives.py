"""Multi-party perspective rotation of dialogues, in DataFrame operations.

For every participant of a conversation the dialogue is rendered once with that
speaker as the assistant and all others as named users; the mask holds the
stretches to learn, the assistant's own turns.  System turns belong to nobody:
they are in every rendering and never learnt.

A conversation is rendered in parts of ``part_turns`` turn numbers, so one that
holds a third of all rows is many parts on many tasks; the parts of a
perspective, joined in order, are the whole dialogue.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwheel.llm._common import running_sum

# The chat template.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
SYSTEM, UNKNOWN = "system", "unknown"


def _safe(text: Column) -> Column:
    """Text in which the template's marks cannot occur."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role",
           text_col: str = "text", part_turns: int = 64) -> DataFrame:
    """(conv_id, perspective, part, n_turns, n_own, rendered, mask array<struct<start, end>>).

    One row for each participant and part of a conversation.  ``mask`` counts
    code points of ``rendered``, end exclusive, and covers the text of the own
    turns with their closing mark.  Turns are ordered by number (null first),
    then speaker and text, so repeated numbers and rows have one order and all
    are kept.  A null or empty speaker is ``unknown``; a null text is empty; null
    conversation ids form one conversation, null turn numbers a part of its own
    (part null).  A conversation of system turns only has no row.  Names are
    cleaned to letters, digits, _ . - in the rendering.  Extra columns are
    ignored.  Empty in, empty out.
    """
    speaker = F.coalesce(F.when(F.trim(F.col(speaker_col)) != "", F.trim(F.col(speaker_col))), F.lit(UNKNOWN))
    said = turns.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
                        speaker.alias("speaker"), _safe(F.col(text_col)).alias("text"))
    parts = said.groupBy("conv_id", F.floor(F.col("turn") / part_turns).alias("part")) \
                .agg(F.array_sort(F.collect_list(F.struct("turn", "speaker", "text"))).alias("turns"))
    people = said.filter(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"),
                                                           F.col("speaker").alias("perspective")).distinct()
    each = parts.join(people, F.col("conv_id").eqNullSafe(F.col("of")))

    def head(t: Column) -> Column:
        name = F.regexp_replace(t["speaker"], r"[^\p{L}\p{N}_.-]", "_")
        role = F.when(t["speaker"] == SYSTEM, F.lit("system")) \
                .when(t["speaker"] == F.col("perspective"), F.lit("assistant")) \
                .otherwise(F.concat(F.lit("user name="), name))
        return F.concat(F.lit(OPEN), role, F.lit("\n"))

    tail = CLOSE + "\n"
    shown = each.withColumn("shown", F.transform("turns", lambda t: F.struct(
        head(t).alias("head"), t["text"].alias("text"),
        (t["speaker"] == F.col("perspective")).alias("own"))))
    sizes = F.transform("shown", lambda s: (F.length(s["head"]) + F.length(s["text"]) + len(tail)).cast("bigint"))
    placed = shown.withColumn("ends", running_sum(sizes))
    spans = F.transform(F.filter(F.arrays_zip("shown", "ends"), lambda z: z["shown"]["own"]), lambda z: F.struct(
        (z["ends"] - len(tail) - F.length(z["shown"]["text"])).alias("start"), (z["ends"] - 1).alias("end")))
    return placed.select(
        F.col("conv_id"), "perspective", "part", F.size("turns").cast("bigint").alias("n_turns"),
        F.size(F.filter("shown", lambda s: s["own"])).cast("bigint").alias("n_own"),
        F.array_join(F.transform("shown", lambda s: F.concat(s["head"], s["text"], F.lit(tail))), "").alias("rendered"),
        spans.alias("mask"))
