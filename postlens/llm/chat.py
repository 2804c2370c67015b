"""Preference formatting: one prompt, two masked completions.

A chosen and a rejected conversation share their first turns. The longest common turn prefix is rendered once
as the prompt; what follows it on each side is that side's completion, with the character spans a trainer
learns from (assistant turns) beside it. Column expressions and one aggregate per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAINED_ROLE = "assistant"


def _turn(row: Column) -> Column:
    return F.concat(
        F.lit("<|"), F.coalesce(row.role, F.lit("")), F.lit("|>\n"), F.coalesce(row.text, F.lit("")), F.lit("<|end|>\n")
    )


def _rendered(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _turn), "")


def _trained_spans(turns: Column) -> Column:
    """``start-end`` of each trained turn's text and end mark in the rendered completion, comma-joined."""
    ends = F.aggregate(
        turns,
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("spans")),
        lambda acc, row: F.struct(
            (acc.at + F.length(_turn(row))).alias("at"),
            F.when(
                row.role.eqNullSafe(F.lit(TRAINED_ROLE)),
                F.concat(
                    acc.spans,
                    F.array(
                        F.concat_ws(
                            "-",
                            acc.at + F.lit(5) + F.length(F.coalesce(row.role, F.lit(""))),
                            acc.at + F.length(_turn(row)) - F.lit(1),
                        )
                    ),
                ),
            )
            .otherwise(acc.spans)
            .alias("spans"),
        ),
    )
    return F.array_join(ends.spans, ",")


def preferences(turns: DataFrame) -> DataFrame:
    """One row per ``pair_id`` of ``(pair_id, side, turn, role, text)``, side ``chosen`` or ``rejected``.

    Turns are equal if role and text are (nulls equal nulls); they are compared in the order of turn, ties by
    role and text, whatever their turn numbers, so repeated rows are turns of their own. A side without turns,
    or all of whose turns are shared, has the empty completion. Null roles and texts render as empty; rows
    without pair_id belong to no pair and are left out. Empty input gives no rows. A conversation is one
    training example and, like a document's text, has to fit into a row; a pair is one group.
    """
    side = lambda name: F.array_sort(
        F.collect_list(F.when(F.col("side") == name, F.struct("turn", "role", "text")))
    )
    pairs = (
        turns.filter("pair_id IS NOT NULL")
        .groupBy("pair_id")
        .agg(side("chosen").alias("_chosen"), side("rejected").alias("_rejected"))
    )
    same = F.zip_with(
        "_chosen",
        "_rejected",
        lambda a, b: a.isNotNull() & b.isNotNull() & a.role.eqNullSafe(b.role) & a.text.eqNullSafe(b.text),
    )
    differs = F.array_position(same, F.lit(False))
    prefix = F.when(differs > 0, differs - 1).otherwise(F.size("_chosen")).cast("int")
    cut = pairs.withColumn("_n", prefix)
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c) - F.col("_n"), F.lit(0)))
    sides = cut.withColumns({"_c": rest("_chosen"), "_r": rest("_rejected")})
    return sides.select(
        "pair_id",
        F.col("_n").cast("long").alias("n_prompt_turns"),
        F.size("_c").cast("long").alias("n_chosen_turns"),
        F.size("_r").cast("long").alias("n_rejected_turns"),
        _rendered(F.slice("_chosen", F.lit(1), F.col("_n"))).alias("prompt"),
        _rendered(F.col("_c")).alias("chosen"),
        _rendered(F.col("_r")).alias("rejected"),
        _trained_spans(F.col("_c")).alias("chosen_trained"),
        _trained_spans(F.col("_r")).alias("rejected_trained"),
    )


def contrasted(conversations: DataFrame) -> DataFrame:
    """Pairs out of plain conversations: each is chosen; rejected is the same one with its last assistant turn
    replaced by that of its neighbour (the ids 2i and 2i + 1 are neighbours), as a fluent but unfitting answer.

    What follows the last assistant turn is left out of the rejected side alone. Without neighbour, or with a
    neighbour that has no assistant turn, the rejected side just ends earlier. Rows without conv_id are left out.
    """
    known = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", "text")
    both = Window.partitionBy("_two")
    placed = F.coalesce(F.col("turn"), F.lit(-1))
    marked = (
        known.withColumn("_two", F.shiftright("conv_id", 1))
        .withColumn("_paired", F.min("conv_id").over(both) != F.max("conv_id").over(both))
        .withColumn("_last", F.max(F.when(F.col("role") == TRAINED_ROLE, placed)).over(Window.partitionBy("_two", "conv_id")))
    )
    answer = F.col("role").eqNullSafe(F.lit(TRAINED_ROLE)) & (placed == F.col("_last"))
    chosen = [F.col("conv_id").alias("pair_id"), F.lit("chosen").alias("side")]
    kept = [F.col("conv_id").alias("pair_id"), F.lit("rejected").alias("side")]
    lent = [F.col("conv_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.lit("rejected").alias("side")]
    row = lambda head, turn: F.struct(*head, turn.alias("turn"), "role", "text")
    turn = F.col("turn").cast("long")
    before = F.col("_last").isNull() | (placed < F.col("_last"))
    copies = F.array(
        row(chosen, turn),
        F.when(before, row(kept, turn)),
        F.when(answer & F.col("_paired"), row(lent, F.lit(2**62).cast("long"))),
    )
    return marked.select(F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("r")).select("r.*")
