"""Preference formatting: pairs of conversations become one prompt and two masked completions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, BREAK, END, AFTER = "<|im_start|>", "\n", "<|im_end|>", "\n"
TURNS = "array<struct<role:string,text:string>>"


def _header(t: Column) -> Column:
    return F.concat(F.lit(HEAD), t["role"], F.lit(BREAK))


def _rendered(t: Column) -> Column:
    return F.concat(_header(t), t["text"], F.lit(END + AFTER))


def _clean(turns: Column) -> Column:
    """The turns with empty strings for what is null; no turns where the array is null."""
    fixed = F.transform(turns.cast(TURNS), lambda t: F.struct(F.coalesce(t["role"], F.lit("")).alias("role"), F.coalesce(t["text"], F.lit("")).alias("text")))
    return F.coalesce(fixed, F.array().cast(TURNS))


def _spans(turns: Column) -> Column:
    """(start, end) in characters of the completion of what an assistant's turn says, its end marker included."""
    sizes = F.transform(turns, lambda t: F.length(_rendered(t)))
    each = F.transform(
        turns,
        lambda t, i: F.struct(
            (t["role"] == "assistant").alias("loss"),
            (F.aggregate(F.slice(sizes, 1, i), F.lit(0), lambda a, x: a + x) + F.length(_header(t))).alias("start"),
            (F.aggregate(F.slice(sizes, 1, i + 1), F.lit(0), lambda a, x: a + x) - len(AFTER)).alias("end"),
        ),
    )
    return F.transform(F.filter(each, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["end"]))


def formatted_preferences(pairs: DataFrame) -> DataFrame:
    """(pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans), one row per row of pairs.

    pairs(pair_id, chosen, rejected): two conversations, arrays of turns with role and text. Turns that both begin with
    are rendered once, as prompt; the others of either side are its completion. Spans say where the loss applies: the
    assistant's turns of the completion, as character positions in it. Equal conversations have empty completions.

    A null array counts as no turns, a null role or text as empty. Repeated rows stay; other columns are ignored. The
    plan is one projection: no shuffle, whatever the number of pairs. Spans take time with the square of the number of
    turns of one conversation, not of its length.
    """
    clean = pairs.select("pair_id", _clean(F.col("chosen")).alias("chosen"), _clean(F.col("rejected")).alias("rejected"))
    same = F.zip_with("chosen", "rejected", lambda a, b: a.eqNullSafe(b))
    first_other = F.array_position(same, F.lit(False)).cast("int")
    counted = clean.withColumn("n_prompt_turns", F.when(first_other == 0, F.size(same)).otherwise(first_other - 1))
    rest = lambda side: F.slice(side, F.col("n_prompt_turns") + 1, F.greatest(F.size(side) - F.col("n_prompt_turns"), F.lit(0)))
    text = lambda turns: F.array_join(F.transform(turns, _rendered), "")
    split = counted.select("pair_id", "n_prompt_turns", F.slice("chosen", 1, F.col("n_prompt_turns")).alias("shared"), rest("chosen").alias("won"), rest("rejected").alias("lost"))
    return split.select(
        "pair_id",
        "n_prompt_turns",
        text(F.col("shared")).alias("prompt"),
        text(F.col("won")).alias("chosen"),
        text(F.col("lost")).alias("rejected"),
        _spans(F.col("won")).alias("chosen_spans"),
        _spans(F.col("lost")).alias("rejected_spans"),
    )


def pairs_of_conversations(conversations: DataFrame) -> DataFrame:
    """Pairs from a table of turns (conv_id, turn, role, text): every conversation is the chosen one of a pair.

    The rejected one goes alike up to the last assistant's turn, and there has the last assistant's answer of the
    neighbouring conversation (conv_id with the last bit flipped). Without an assistant's turn, or a neighbour with one,
    the rejected conversation stops before that answer. Turns go by turn, role and text; rows without a conv_id belong to
    no conversation and are left out. A null turn comes first, a null role or text is empty, repeated rows are turns of
    their own. No rows: no pairs. Other columns are ignored.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    whole = conversations.where("conv_id is not null").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    whole = whole.select("conv_id", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"))
    at = whole.withColumn("answers", F.filter("turns", lambda t: t["role"] == "assistant")).withColumn(
        "last", F.size("turns") - F.array_position(F.reverse(F.transform("turns", lambda t: t["role"])), "assistant").cast("int") + 1
    )
    other = at.where(F.size("answers") > 0).select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.slice("answers", -1, 1).alias("answer"))
    before = F.when(F.size("answers") > 0, F.slice("turns", 1, F.col("last") - 1)).otherwise(F.col("turns"))
    return at.join(other, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"),
        F.col("turns").alias("chosen"),
        F.when(F.size("answers") > 0, F.concat(before, F.coalesce("answer", F.array().cast(TURNS)))).otherwise(before).alias("rejected"),
    )
