"""Preference formatting: a shared prompt and two masked completions of each pair of conversations.

The longest common prefix of turns (role and text equal) of the chosen and the
rejected conversation is rendered once, as the prompt. What follows on either
side is its completion. A completion's mask lists the stretches that training
should learn: what the assistant says, with its end mark. All DataFrame functions.

Edge cases: null texts are empty, null roles are ``unknown``; repeated equal
rows of a conversation are one turn, different ones of one number follow each
other by role and text, turns without a number come first; rows without a
conversation id are in none; equal conversations have two empty completions, and
where one is the beginning of the other, its completion is empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEARNED = "assistant"
END = "<|end|>"
SPANS = "array<struct<start:bigint,end:bigint>>"


def head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(head(t), t["text"], F.lit(END + "\n"))), "")


def mask(turns: Column) -> Column:
    """Stretches of the rendered turns, in code points, end exclusive."""

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(head(t))
        end = start + F.length(t["text"]) + len(END)
        own = F.array(F.struct(start.alias("start"), end.alias("end")))
        out = F.when(t["role"] == LEARNED, F.concat(state["out"], own)).otherwise(state["out"])
        return F.struct((end + 1).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(SPANS).alias("out"))
    return F.aggregate(turns, begin, step, lambda s: s["out"])


def turns_of(rows: DataFrame, key: str = "conv_id") -> DataFrame:
    """(key, turns): each conversation's turns in order, as (role, text)."""
    turn = F.struct("turn", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = F.transform(F.array_sort(F.collect_set(turn)), lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(turns.alias("turns"))


def format_pairs(pairs: DataFrame) -> DataFrame:
    """(pair_id, prompt_turns, prompt, chosen, rejected, chosen_mask, rejected_mask) of ``pairs`` (pair_id, chosen, rejected)."""
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    differ = F.array_position(same, F.lit(False))
    shared = F.when(differ > 0, differ - 1).otherwise(F.size("chosen")).cast("int")
    rest = lambda side: F.slice(side, F.col("prompt_turns") + 1, F.size(side))
    cut = pairs.select("pair_id", "chosen", "rejected", shared.alias("prompt_turns")).select(
        "pair_id", "prompt_turns", F.slice("chosen", 1, F.col("prompt_turns")).alias("start"), rest("chosen").alias("good"), rest("rejected").alias("bad")
    )
    return cut.select(
        "pair_id", "prompt_turns", render(F.col("start")).alias("prompt"), render(F.col("good")).alias("chosen"), render(F.col("bad")).alias("rejected"),
        mask(F.col("good")).alias("chosen_mask"), mask(F.col("bad")).alias("rejected_mask"),
    )
