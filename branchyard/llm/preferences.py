"""Preference pairs: a prompt that both conversations share, and two masked completions.

The turns of a pair's chosen and rejected conversations meet in one grouping. Their longest common
prefix of turns (equal role and text) is rendered once, as the prompt; the other turns of each side
are its completion. A completion's mask marks the text of assistant turns, with the mark that ends
a turn: that is what a model is trained on. It is a list of ``from:to`` in characters, 0 first.

A turn is rendered as ``<|im_start|>role`` newline text ``<|im_end|>`` newline. In a text, ``<|im_``
becomes ``<| im_``, so that no text can end its turn.

All of it is DataFrame functions and one shuffle. A conversation has to fit a row, as its rendering
does.

Defined results: a null role or text is empty. Turns stand by number, equal numbers by role and
text; a null number comes first. Rows that repeat a turn repeat it in the conversation. Where a side
has no turns, its completion is empty and so is the prompt; where both sides are equal, both
completions are. Rows without a conversation id are left out. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"


def rendered(turn: Column) -> Column:
    text = F.replace(turn["text"], F.lit("<|im_"), F.lit("<| im_"))
    return F.concat(F.lit(START), turn["role"], F.lit("\n"), text, F.lit(END + "\n"))


def completion(turns: Column, role: str) -> Column:
    """struct(text, mask): turns rendered one after the other, and where the role's text stands."""
    nothing = F.struct(F.lit("").alias("text"), F.array().cast("array<string>").alias("mask"))

    def add(made: Column, turn: Column) -> Column:
        text = rendered(turn)
        start = F.length(made["text"]) + len(START) + F.length(turn["role"]) + 1
        end = F.length(made["text"]) + F.length(text) - 1
        span = F.concat_ws(":", start, end)
        mask = F.when(turn["role"] == role, F.concat(made["mask"], F.array(span))).otherwise(made["mask"])
        return F.struct(F.concat(made["text"], text).alias("text"), mask.alias("mask"))

    return F.aggregate(turns, nothing, add)


def preference_pairs(turns: DataFrame, *, role: str = "assistant") -> DataFrame:
    """One row per pair: pair_id, n_prompt_turns, n_chosen_turns, n_rejected_turns, prompt, chosen, chosen_mask, rejected, rejected_mask.

    ``turns`` has pair_id, is_chosen, turn, role and text. Masks are ``from:to`` joined by commas.
    """
    turn = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = turns.where("pair_id IS NOT NULL AND is_chosen IS NOT NULL").select("pair_id", "is_chosen", turn.alias("t"))
    side = lambda chosen: F.sort_array(F.collect_list(F.when(F.col("is_chosen") == chosen, F.col("t"))))
    pairs = rows.groupBy("pair_id").agg(side(True).alias("c"), side(False).alias("r"))
    shorter = F.least(F.size("c"), F.size("r"))
    differs = F.filter(
        F.when(shorter > 0, F.sequence(F.lit(0), shorter - 1)).otherwise(F.array().cast("array<int>")),
        lambda i: (F.get("c", i)["role"] != F.get("r", i)["role"]) | (F.get("c", i)["text"] != F.get("r", i)["text"]),
    )
    pairs = pairs.withColumn("n", F.coalesce(F.get(differs, F.lit(0)), shorter))
    rest = lambda name: F.slice(name, F.col("n") + 1, F.size(name))
    pairs = pairs.select(
        "pair_id",
        F.col("n").cast("long").alias("n_prompt_turns"),
        (F.size("c") - F.col("n")).cast("long").alias("n_chosen_turns"),
        (F.size("r") - F.col("n")).cast("long").alias("n_rejected_turns"),
        F.array_join(F.transform(F.slice("c", F.lit(1), F.col("n")), rendered), "").alias("prompt"),
        completion(rest("c"), role).alias("chosen"),
        completion(rest("r"), role).alias("rejected"),
    )
    return pairs.select(
        "pair_id", "n_prompt_turns", "n_chosen_turns", "n_rejected_turns", "prompt",
        F.col("chosen.text").alias("chosen"), F.array_join("chosen.mask", ",").alias("chosen_mask"),
        F.col("rejected.text").alias("rejected"), F.array_join("rejected.mask", ",").alias("rejected_mask"),
    )
