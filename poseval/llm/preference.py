"""Preference formatting: a shared prompt and two masked completions per pair.

The turns that a chosen and a rejected conversation begin with alike are the
prompt, rendered once; what follows in either is its completion. A completion's
mask gives runs of characters in order, with whether they bear loss: the text
of assistant turns and its end marker do, headers and other roles don't.

Only built-in functions are used. Turns meet in one shuffle, by pair; a pair is
one training example, so it has to fit one row, as its rendered text has to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from poseval.schema import require_columns

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"
LEARNT_ROLE = "assistant"


def _common(a: Column, b: Column) -> Column:
    """Leading turns alike in role and text; the shorter side is padded with nulls, which differ."""
    same = F.zip_with(a, b, lambda x, y: F.coalesce((x["role"] == y["role"]) & (x["body"] == y["body"]), F.lit(False)))
    first = F.array_position(same, False).cast("int")
    return F.when(first > 0, first - 1).otherwise(F.size(a))


def _header(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_header(t), t["body"], F.lit(CLOSE + "\n"))), "")


def _mask(turns: Column) -> Column:
    runs = F.transform(
        turns,
        lambda t: F.array(
            F.struct(F.char_length(_header(t)).alias("length"), F.lit(False).alias("loss")),
            F.struct((F.char_length(t["body"]) + len(CLOSE)).alias("length"), (t["role"] == LEARNT_ROLE).alias("loss")),
            F.struct(F.lit(1).alias("length"), F.lit(False).alias("loss")),
        ),
    )
    return F.flatten(runs)


def format_preferences(turns: DataFrame, pair_id: Column, is_chosen: Column) -> DataFrame:
    """One row per pair: ``prefix_turns, prompt, chosen, rejected``, their masks, and ``usable``.

    ``pair_id`` and ``is_chosen`` say for each row of ``turns`` (``turn, role,
    text``) which pair and side it belongs to; a row without either is left
    out. Turns are in the order of ``turn``, a null one first; several under one number
    follow by role and text; repeated rows count once. Null roles and texts are
    empty. Template marks inside a text are broken by a space. A side without
    turns is an empty conversation, and equal conversations leave two empty
    completions; ``usable`` tells whether both completions have something to
    learn. An empty table gives no rows; other columns are ignored.
    """
    require_columns(turns, ["turn", "role", "text"])
    clean = lambda c: F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("<|"), F.lit("< |"))
    rows = turns.select(
        pair_id.alias("pair_id"), is_chosen.alias("side"), F.struct("turn", clean("role").alias("role"), clean("text").alias("body")).alias("t")
    ).where("pair_id IS NOT NULL AND side IS NOT NULL")
    side = lambda wanted: F.sort_array(F.collect_set(F.when(F.col("side") == wanted, F.col("t"))))
    pairs = rows.groupBy("pair_id").agg(side(True).alias("a"), side(False).alias("b"))
    pairs = pairs.withColumn("prefix_turns", _common(F.col("a"), F.col("b")))
    after = lambda c: F.slice(c, F.col("prefix_turns") + 1, F.greatest(F.size(c), F.lit(1)))
    cut = pairs.select(
        "pair_id",
        "prefix_turns",
        F.slice("a", F.lit(1), F.col("prefix_turns")).alias("p"),
        after(F.col("a")).alias("a"),
        after(F.col("b")).alias("b"),
    )
    learns = lambda c: F.exists(c, lambda t: t["role"] == LEARNT_ROLE)
    return cut.select(
        "pair_id",
        "prefix_turns",
        _text(F.col("p")).alias("prompt"),
        _text(F.col("a")).alias("chosen"),
        _text(F.col("b")).alias("rejected"),
        _mask(F.col("a")).alias("chosen_mask"),
        _mask(F.col("b")).alias("rejected_mask"),
        (learns("a") & learns("b")).alias("usable"),
    )


def mask_text(mask: str) -> Column:
    """A mask as text: ``length:loss`` runs, with loss 0 or 1."""
    return F.array_join(F.transform(mask, lambda r: F.concat_ws(":", r["length"], r["loss"].cast("int"))), ",")
