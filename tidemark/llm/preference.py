"""Preference records: the common prompt once, and two completions with loss masks.

DataFrame functions only: a conversation is one sorted array of turns, and everything about
a pair is an expression over its two arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"
TRAINED = "assistant"


def _head(role: Column) -> Column:
    return F.concat(F.lit("<|"), role, F.lit("|>\n"))


def _rendered(turns: Column) -> Column:
    return F.array_join(
        F.transform(
            turns, lambda t: F.concat(_head(t["role"]), t["text"], F.lit(f"{END}\n"))
        ),
        "",
    )


def _mask(turns: Column, trained: str) -> Column:
    """start:end of the trained turns' texts with their end marks, in code points."""

    def add(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(_head(t["role"]))
        end = start + F.length(t["text"]) + len(END)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        spans = F.when(
            t["role"] == trained, F.concat(state["spans"], F.array(span))
        ).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.aggregate(turns, first, add, lambda state: F.array_join(state["spans"], ","))


def conversations(
    turns: DataFrame,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """(conv_id, turns): the turns of each conversation as an array, by turn, role and text.

    A null role is `unknown`, a null text is empty; rows without a conversation are left out.
    """
    one = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("unknown")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    return (
        turns.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias("conv_id"))
        .agg(F.sort_array(F.collect_list(one)).alias("turns"))
    )


def preference_records(
    convs: DataFrame, pairs: DataFrame, trained: str = TRAINED
) -> DataFrame:
    """One row per pair (pair_id, chosen_id, rejected_id) of conversations (conv_id, turns).

    prompt renders the longest common prefix of turns (equal role and text at each place)
    once; chosen and rejected render what follows, and their masks list the stretches to train
    on, those of `trained` turns. A conversation that is a prefix of the other has an empty
    completion; equal ones have two. Pairs with a missing conversation give no row. Repeated
    pairs give a row each.
    """
    one = convs.select(F.col("conv_id").alias("chosen_id"), F.col("turns").alias("one"))
    two = convs.select(F.col("conv_id").alias("rejected_id"), F.col("turns").alias("two"))
    both = pairs.select("pair_id", "chosen_id", "rejected_id").join(one, "chosen_id")
    both = both.join(two, "rejected_id")
    # A missing turn equals none; the flags say for each place whether the turns agree.
    agree = F.zip_with(
        "one", "two", lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False))
    )
    differs = F.array_position(agree, False)
    n = F.when(differs == 0, F.size("one")).otherwise(differs - 1).cast("int")
    tail = lambda turns: F.slice(turns, F.col("n") + 1, F.size(turns))
    split = both.withColumn("n", n).select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        F.col("n").alias("prompt_turns"),
        F.slice("one", F.lit(1), F.col("n")).alias("prompt"),
        tail(F.col("one")).alias("one"),
        tail(F.col("two")).alias("two"),
    )
    return split.select(
        "pair_id",
        "chosen_id",
        "rejected_id",
        "prompt_turns",
        _rendered(F.col("prompt")).alias("prompt"),
        _rendered(F.col("one")).alias("chosen"),
        _mask(F.col("one"), trained).alias("chosen_mask"),
        _rendered(F.col("two")).alias("rejected"),
        _mask(F.col("two"), trained).alias("rejected_mask"),
    )
