"""Preference formatting: a chosen and a rejected conversation become a prompt and two completions.

The turns both conversations begin with (equal role and text, in turn order) are the prompt and are
rendered once. What follows in each is its completion; in it only the assistant's turns are trained
on (``masked`` false), everything else, the prompt too, is masked out. The result has one row per
rendered turn, with its place in the part it belongs to, so a conversation of any length is never put
together in one value; the parts are the rows' texts in ``position`` order.

DataFrame functions only. Turns are numbered and offsets summed by windows per conversation, which sort and
stream; the prefix is an equi-join by (pair, position) and a minimum.

Defined results: null roles and texts render as empty and are equal to each other. Turns that repeat a
number are ordered by role and text. A pair without one side has an empty prompt and one completion.
Equal conversations are all prompt. Null pair ids take no part. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def render(role: Column, text: Column) -> Column:
    """The chat template of one turn."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def numbered(turns: DataFrame) -> DataFrame:
    """(pair_id, position, role, text), positions from 1."""
    order = Window.partitionBy("pair_id").orderBy("turn", "role", "text")
    return turns.where("pair_id is not null").select("pair_id", F.row_number().over(order).alias("position"), "role", "text")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """(pair_id, part, position, role, rendered, start, n_chars, masked) for turns (pair_id, turn, role,
    text) of both sides. ``part``: prompt, chosen or rejected; ``start``: characters before it there."""
    a, b = numbered(chosen).alias("a"), numbered(rejected).alias("b")
    both = a.join(b, (F.col("a.pair_id") == F.col("b.pair_id")) & (F.col("a.position") == F.col("b.position")), "full").select(
        F.coalesce("a.pair_id", "b.pair_id").alias("pair_id"),
        F.coalesce("a.position", "b.position").alias("position"),
        F.when(F.col("a.position").isNotNull(), F.struct("a.role", "a.text")).alias("chosen"),
        F.when(F.col("b.position").isNotNull(), F.struct("b.role", "b.text")).alias("rejected"),
    )
    differs = ~F.col("chosen").eqNullSafe(F.col("rejected"))
    parted = Window.partitionBy("pair_id").orderBy("position").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    split = both.withColumn("_apart", F.max(differs).over(parted))
    sides = F.when(~F.col("_apart"), F.array(F.struct(F.lit("prompt").alias("part"), F.col("chosen").alias("turn")))).otherwise(
        F.array(*[F.struct(F.lit(x).alias("part"), F.col(x).alias("turn")) for x in ("chosen", "rejected")])
    )
    rows = split.select("pair_id", "position", F.explode(sides).alias("s")).where("s.turn is not null").select(
        "pair_id", "s.part", "position", "s.turn.role", render(F.col("s.turn.role"), F.col("s.turn.text")).alias("rendered")
    )
    before = Window.partitionBy("pair_id", "part").orderBy("position").rowsBetween(Window.unboundedPreceding, -1)
    n = F.length("rendered").cast("long")
    return rows.withColumns({
        "start": F.coalesce(F.sum(n).over(before), F.lit(0)).cast("long"),
        "n_chars": n,
        "masked": (F.col("part") == "prompt") | ~F.col("role").eqNullSafe(F.lit("assistant")),
    })


def refusal_pairs(conversations: DataFrame, refusal: str) -> tuple[DataFrame, DataFrame]:
    """(chosen, rejected) turns out of plain conversations (conv_id, turn, role, text): up to the last
    assistant turn, as it is, and with ``refusal`` in that turn's place. Others have no pair."""
    last = conversations.where("role = 'assistant'").groupBy("conv_id").agg(F.max("turn").alias("_last"))
    kept = conversations.join(last, "conv_id").where("turn <= _last").withColumnRenamed("conv_id", "pair_id")
    answer = (F.col("turn") == F.col("_last")) & (F.col("role") == "assistant")
    rejected = kept.withColumn("text", F.when(answer, F.lit(refusal)).otherwise(F.col("text")))
    return kept.drop("_last"), rejected.drop("_last")
