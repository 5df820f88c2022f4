"""Preference formatting: one prompt, two masked completions.

For each pair of a chosen and a rejected conversation, the longest common prefix of turns (same role and
text, in order) is rendered once as the prompt; what is left of either side is rendered as its completion.
The result has a row for each rendered turn, with its place in its part and whether it counts for the loss:
only assistant turns of completions do. A conversation of any length stays rows; nothing is collected.

A turn is rendered as ``<|role|>``, a line break, its text, ``<|end|>`` and a line break. ``<|`` inside a role or text is
written ``< |``, so that no text can forge a marker.

Defined results: null text is empty, a null role is ``unknown``; turns are ordered by turn, nulls last, then role,
then text, so repeated and tied turns have an order; rows without an id belong to no conversation and are left
out; a side that is missing has no completion; equal sides have a prompt only; empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

ASSISTANT = "assistant"


def _plain(column: Column) -> Column:
    return F.replace(column, F.lit("<|"), F.lit("< |"))


def numbered_turns(turns: DataFrame, conversation: str) -> DataFrame:
    """(conversation, place, role, text) with places from 1 on."""
    role, text = F.coalesce("role", F.lit("unknown")), F.coalesce("text", F.lit(""))
    known = turns.filter(F.col(conversation).isNotNull())
    plain = known.select(conversation, "turn", _plain(role).alias("role"), _plain(text).alias("text"))
    order = Window.partitionBy(conversation).orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    return plain.select(conversation, F.row_number().over(order).alias("place"), "role", "text")


def preference_segments(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rendered turns of pairs; both sides are (pair_id, place, role, text) as ``numbered_turns`` gives them.

    pair_id, part (prompt, chosen or rejected), place in the conversation, role, segment, in_loss, and where
    the segment begins and ends in its part, in characters. The turn's text and its end marker count for
    the loss, the header does not: ``loss_begin`` is where they begin, null outside the loss.
    """
    sides = chosen.withColumn("side", F.lit("chosen")).unionByName(rejected.withColumn("side", F.lit("rejected")))
    said = F.struct("role", "text")
    at = sides.groupBy("pair_id", "place").agg(
        F.max(F.when(F.col("side") == "chosen", said)).alias("chosen"),
        F.max(F.when(F.col("side") == "rejected", said)).alias("rejected"),
    )
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    first = at.filter(differs).groupBy("pair_id").agg(F.min("place").alias("first"))
    placed = at.join(first, "pair_id", "left").withColumn("common", F.coalesce(F.col("place") < F.col("first"), F.lit(True)))
    both = F.array(
        F.struct(F.when(F.col("common"), "prompt").otherwise("chosen").alias("part"), F.col("chosen").alias("said")),
        F.struct(F.when(F.col("common"), F.lit(None)).otherwise("rejected").alias("part"), F.col("rejected").alias("said")),
    )
    parts = placed.select("pair_id", "place", F.explode(both).alias("x")).select("pair_id", "place", "x.part", "x.said.*")
    parts = parts.filter("part is not null and role is not null")
    head = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"))
    segment = F.concat(head, F.col("text"), F.lit("<|end|>\n"))
    rendered = parts.withColumns(
        {"segment": segment, "in_loss": (F.col("part") != "prompt") & (F.col("role") == ASSISTANT)}
    )
    so_far = Window.partitionBy("pair_id", "part").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    ended = rendered.withColumn("segment_end", F.sum(F.length("segment")).over(so_far))
    begin = F.col("segment_end") - F.length("segment")
    return ended.select(
        "pair_id",
        "part",
        "place",
        "role",
        "segment",
        "in_loss",
        begin.alias("segment_begin"),
        "segment_end",
        F.when(F.col("in_loss"), begin + F.length(head)).alias("loss_begin"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every conversation as chosen; as rejected, itself with its last answer swapped for a neighbour's.

    The neighbour is the conversation whose id differs in the last bit; where it has no answer, the rejected
    side ends before its own. A conversation without an answer is rejected as it is.
    """
    turns = numbered_turns(conversations, "conv_id")
    answers = turns.filter(F.col("role") == ASSISTANT)
    last = answers.groupBy("conv_id").agg(F.max(F.struct("place", "text")).alias("last"))
    own = last.select("conv_id", F.col("last.place").alias("last_place"))
    other = last.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("last.text").alias("swapped"))
    known = turns.join(own.join(other, "conv_id", "left"), "conv_id", "left")
    is_last = F.coalesce(F.col("place") == F.col("last_place"), F.lit(False))
    text = F.when(is_last, F.col("swapped")).otherwise(F.col("text"))
    rejected = known.select("conv_id", "place", "role", text.alias("text")).filter("text is not null")
    return turns.withColumnRenamed("conv_id", "pair_id"), rejected.withColumnRenamed("conv_id", "pair_id")
