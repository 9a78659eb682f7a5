"""Preference formatting: a shared prompt and two masked completions.

The turns of a chosen and a rejected conversation are compared from the start; the longest common
prefix (same role and text) is rendered once as the prompt, what follows on either side as its
completion. Spans mark the characters of a completion that carry loss: the texts and end marks of
the trained role.

A conversation is one training example and one row; its turns must fit in memory. Defined cases:
exact repeats of a turn row count once (dropped before turns are gathered, so repeated rows make
no hot group); ties of the turn number are ordered by role and text, nulls first; null role is
rendered as ``none``, null text as empty; a side without a partner gives a row whose other
completion is null and whose prompt is empty; rows with null pair id belong to no pair and are
left out; equal conversations give two empty completions. Empty tables give no rows; extra columns are not
looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<|", "|>\n", "<|end|>\n"
TRAINED = "assistant"


def _turns(side: DataFrame, pair: str, turn: str, role: str, text: str, name: str) -> DataFrame:
    rows = side.where(F.col(pair).isNotNull()).select(
        F.col(pair).alias("pair_id"), F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("none")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text")).distinct()
    listed = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    return rows.groupBy("pair_id").agg(F.transform(listed, lambda t: F.struct(t["role"], t["text"])).alias(name))


def render(turns: Column) -> Column:
    """The turns as one string."""
    return F.array_join(F.transform(turns, lambda t: F.concat(
        F.lit(OPEN), t["role"], F.lit(MIDDLE), t["text"], F.lit(CLOSE))), "")


def loss_spans(turns: Column, trained: str = TRAINED) -> Column:
    """[start, end) of the characters with loss in the rendered turns."""
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def add(a: Column, t: Column) -> Column:
        begin = a["at"] + len(OPEN) + F.length(t["role"]) + len(MIDDLE)
        end = begin + F.length(t["text"]) + len(CLOSE)
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(t["role"] == trained, F.concat(a["spans"], span))
                        .otherwise(a["spans"]).alias("spans"))

    return F.aggregate(turns, zero, add, lambda a: a["spans"])


def common_turns(a: Column, b: Column) -> Column:
    """Length of the longest common prefix."""
    first = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(first.isNull(), 0).when(first > 0, first - 1).otherwise(F.size(a)).cast("int")


def format_preferences(chosen: DataFrame, rejected: DataFrame, pair: str = "pair_id", turn: str = "turn",
                       role: str = "role", text: str = "text", trained: str = TRAINED) -> DataFrame:
    """One row per pair: pair_id, n_prompt_turns, prompt, chosen, rejected and their loss spans."""
    both = _turns(chosen, pair, turn, role, text, "a").join(_turns(rejected, pair, turn, role, text, "b"), "pair_id", "full")
    both = both.withColumn("n_prompt_turns", common_turns(F.col("a"), F.col("b")))
    n = F.col("n_prompt_turns")

    def rest(side: str) -> Column:
        return F.slice(F.col(side), n + 1, F.greatest(F.size(side) - n, F.lit(0)))

    prompt = F.when(n > 0, render(F.slice("a", 1, n))).otherwise(F.lit(""))
    return both.select(
        "pair_id", "n_prompt_turns", prompt.alias("prompt"), render(rest("a")).alias("chosen"),
        render(rest("b")).alias("rejected"), loss_spans(rest("a"), trained).alias("chosen_spans"),
        loss_spans(rest("b"), trained).alias("rejected_spans"))
