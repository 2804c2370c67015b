"""Mixing sources to target weights.

Words are summed per source, the sums give each source a target and so a repetition rate, and each document is
emitted floor(rate) times plus one more time with the probability of the fraction. The draw is a hash of seed,
document id and text, so reruns and retried tasks agree, and documents without an id, or with one id, draw each for
themselves. Row-local but for one aggregate to a row per source.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm.common import measured, n_words

WEIGHTS = (3, 1, 2)
SEED = "mix"


def targets(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = 1.5, most: int = 2
) -> DataFrame:
    """``(source, source_size, target)`` from ``(source, size)`` rows.

    Sources in code point order, null last, take ``weights`` in turn and share ``share`` times all words. No
    source gets more than ``most`` times its own words; what it would get beyond that goes to the others by
    weight. That is a common level times the weight, cut at the source's limit: sources in the order in which
    a rising level reaches their limits, the level is set by the first one it doesn't reach.

    Sources without words get target 0. No rows give no rows. The windows hold one row per source.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(ordered) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), turn + 1)
    limits = per_source.select(
        "source", "source_size", weight.cast("long").alias("_weight"), (most * F.col("source_size")).alias("_most")
    )
    rising = Window.orderBy(F.col("_most") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("_most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("_weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    levels = limits.withColumn("_level", (F.lit(share) * total - before) / open_weight)
    reached = F.when(F.col("_level") * F.col("_weight") <= F.col("_most"), F.col("_level"))
    first = F.first(reached, ignorenulls=True).over(
        rising.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    level = F.coalesce(first, F.lit(float("inf")))
    return levels.select(
        "source", "source_size", F.least(F.col("_most").cast("double"), level * F.col("_weight")).alias("target")
    )


def draw(key: Column, text: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) that depends on seed, key and text alone. Null counts as empty."""
    filled = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), filled(key), F.lit(":"), F.md5(filled(text))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def with_copies(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with _size, _source_size, _target and _copies.

    Null texts have size 0; null is a source like any other. Only rows with the same doc_id and the same text draw alike:
    such repeated rows are all taken once more or none of them. Empty input gives no rows. Columns of ``docs`` keep
    their names and values; the added ones start with ``_``.
    """
    sized = docs.withColumn("_size", n_words(F.col("text")))
    goals = targets(sized.select("source", F.col("_size").alias("size")), **shares).select(
        F.col("source").alias("_source"), F.col("source_size").alias("_source_size"), F.col("target").alias("_target")
    )
    joined = sized.join(measured(goals, "mix-targets"), F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("_source_size") > 0, F.col("_target") / F.col("_source_size")).otherwise(0.0)
    extra = (draw(F.col("doc_id"), F.col("text"), seed) < rate - F.floor(rate)).cast("int")
    return joined.withColumn("_copies", F.floor(rate).cast("int") + extra).drop("_source")


def mixed(docs: DataFrame, seed: str = SEED, **shares) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; same columns."""
    copies = with_copies(docs, seed, **shares).filter("_copies > 0")
    emitted = copies.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    return emitted.select(*(emitted[f"`{c}`"] for c in docs.columns))
