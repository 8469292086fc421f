"""Preference formatting of chosen and rejected conversations.

The longest common prefix of turns, alike in role and text, is rendered once
as the prompt. What follows in either conversation is its completion, with the
spans of it that a loss applies to: the texts of assistant turns and their end
marks; turns of others and role marks are masked.

A pair is one row in the result, so its turns meet in one row; pairs spread
over the tasks. Turns are ordered by number, NULL first, then role and text;
repeated rows count once. NULL roles and texts are empty. Rows with a NULL pair id belong to
no pair. A side without turns has an empty completion.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BEGIN, MIDDLE, END = "<|", "|>\n", "<|end|>\n"
LEARNT_ROLE = "assistant"


def _turns(side: DataFrame, pair_id: str, name: str) -> DataFrame:
    """Each conversation in one array, gathered once."""
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = side.where(F.col(pair_id).isNotNull()).select(F.col(pair_id).alias("pair_id"), turn.alias("t"))
    return rows.groupBy("pair_id").agg(F.array_sort(F.collect_set("t")).alias(name))


def _said(turns: Column) -> Column:
    return F.transform(turns, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))


def _rendered(turns: Column) -> Column:
    parts = F.transform(turns, lambda t: F.concat(F.lit(BEGIN), t["role"], F.lit(MIDDLE), t["text"], F.lit(END)))
    return F.array_join(parts, "")


def _spans(turns: Column) -> Column:
    """``[start, end)`` of what is learnt, in code points of the completion."""

    def step(state: Column, t: Column) -> Column:
        start = state["at"] + F.length(t["role"]) + len(BEGIN) + len(MIDDLE)
        end = start + F.length(t["text"]) + len(END)
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        learnt = F.when(t["role"] == LEARNT_ROLE, span).otherwise(F.array().cast("array<struct<start: int, end: int>>"))
        return F.struct(end.alias("at"), F.concat(state["spans"], learnt).alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start: int, end: int>>").alias("spans"))
    return F.aggregate(turns, start, step, lambda s: s["spans"])


def format_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``(pair_id, n_shared, prompt, chosen, chosen_spans, rejected,
    rejected_spans)`` of two tables ``(pair_id, turn, role, text)``."""
    return _formatted(_turns(chosen, "pair_id", "good").join(_turns(rejected, "pair_id", "bad"), "pair_id", "full"))


def _formatted(pairs: DataFrame) -> DataFrame:
    """``format_pairs`` of two arrays of turns a row, ``good`` and ``bad``."""
    none = F.array().cast("array<struct<role: string, text: string>>")
    said = pairs.select("pair_id", *(F.coalesce(_said(F.col(c)), none).alias(c) for c in ("good", "bad")))
    differs = F.array_position(F.zip_with("good", "bad", lambda a, b: F.coalesce(a == b, F.lit(False))), F.lit(False))
    longest = F.greatest(F.size("good"), F.size("bad"))
    shared = said.withColumn("n_shared", F.when(differs > 0, differs - 1).otherwise(longest).cast("int"))
    rest = {c: F.slice(c, F.col("n_shared") + 1, F.size(c)) for c in ("good", "bad")}
    cut = shared.withColumns({f"{c}_rest": F.when(F.size(c) > 0, r).otherwise(none) for c, r in rest.items()})
    return cut.select(
        "pair_id",
        "n_shared",
        _rendered(F.slice("good", F.lit(1), F.col("n_shared"))).alias("prompt"),
        _rendered(F.col("good_rest")).alias("chosen"),
        _spans(F.col("good_rest")).alias("chosen_spans"),
        _rendered(F.col("bad_rest")).alias("rejected"),
        _spans(F.col("bad_rest")).alias("rejected_spans"),
    )


def format_replies(conversations: DataFrame) -> DataFrame:
    """``format_pairs`` of pairs made from a table of conversations
    ``(conv_id, turn, role, text)``, one for each: a conversation up to its last
    assistant turn is chosen; the same with that turn's text taken from the last
    assistant turn of conversation ``conv_id + 1`` is rejected. Where there is
    no such text, it is empty.

    Turns after the last reply are part of neither side, for nothing answers
    them. A conversation without a reply has all its turns on both sides, so
    they are the prompt and both completions are empty. A NULL turn number is
    below all others. Rows without a ``conv_id`` belong to no conversation;
    repeated ones count once; other columns play no part; an empty table has no
    rows.

    Conversations are gathered once, cut where they are, and joined with the
    others' last replies alone.
    """
    gathered = _turns(conversations, "conv_id", "turns")
    # In a struct a NULL is the least value and equal to itself.
    learnt = F.filter("turns", lambda t: t["role"] == LEARNT_ROLE)
    ended = gathered.withColumn("last", F.array_max(F.transform(learnt, lambda t: F.struct(t["turn"].alias("turn")))))

    def is_reply(t: Column) -> Column:
        return F.coalesce((F.struct(t["turn"].alias("turn")) == F.col("last")) & (t["role"] == LEARNT_ROLE), F.lit(False))

    def answered(t: Column) -> Column:
        return F.col("last").isNull() | (F.struct(t["turn"].alias("turn")) <= F.col("last"))

    cut = ended.select("pair_id", "last", F.filter("turns", answered).alias("good"))
    replies = cut.select(
        (F.col("pair_id") - 1).alias("pair_id"), F.array_min(F.transform(F.filter("good", is_reply), lambda t: t["text"])).alias("other")
    ).where(F.col("other").isNotNull())

    def replaced(t: Column) -> Column:
        text = F.when(is_reply(t), F.coalesce("other", F.lit(""))).otherwise(t["text"])
        return F.struct(t["turn"].alias("turn"), t["role"].alias("role"), text.alias("text"))

    both = cut.join(replies, "pair_id", "left")
    # Two replies at the last turn become one.
    bad = F.array_sort(F.array_distinct(F.transform("good", replaced)))
    return _formatted(both.select("pair_id", "good", bad.alias("bad")))
