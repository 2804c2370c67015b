"""Counting over batches, labels and time."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.sentiment import count_in
from postlens.session import written

# The two labels of the running counts.
POSITIVE = "Positive"
NEGATIVE = "Negative"


def per_interval(df: DataFrame, ts: str, interval: str = "10 seconds") -> DataFrame:
    """Records per processing interval."""
    windowed = df.groupBy(F.window(ts, interval).alias("w")).agg(F.count("*").alias("records"))
    return windowed.select(F.col("w.start").alias("batch_start"), "records")


def per_datetime(df: DataFrame, ts: str, unit: str = "hour", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(F.date_trunc(unit, ts).alias("posted_at"), *by).agg(F.count("*").alias("posts"))


def class_totals(
    df: DataFrame, words: str, positive: Iterable[str], negative: Iterable[str], by: Sequence[str] = (),
    records: str | None = None,
) -> DataFrame:
    """``(by, label, count)``: tokens per class; a word on both lists counts for both.

    Each text is reduced to two numbers in place, so nothing is exploded and the shuffle carries one row
    per task and group. Both labels appear, with 0 where nothing was found. ``records`` names an extra
    column with the number of texts.
    """
    per_text = df.select(
        *by, count_in(words, positive).alias("_pos"), count_in(words, negative).alias("_neg")
    )
    totals = per_text.groupBy(*by).agg(
        F.coalesce(F.sum("_pos"), F.lit(0)).alias(POSITIVE),
        F.coalesce(F.sum("_neg"), F.lit(0)).alias(NEGATIVE),
        *([F.count("*").alias(records)] if records else []),
    )
    kept = [*by, records] if records else list(by)
    return totals.unpivot(kept, [POSITIVE, NEGATIVE], "label", "count")


def class_union(df: DataFrame, word: str, positive: Iterable[str], negative: Iterable[str]) -> DataFrame:
    """``(label, hit)``: one row per token and class, 1 for a hit. One pass, no union of two scans."""
    positive, negative = sorted(set(positive)), sorted(set(negative))
    return df.select(
        F.col(word).isin(positive).cast("int").alias(POSITIVE),
        F.col(word).isin(negative).cast("int").alias(NEGATIVE),
    ).unpivot([], [POSITIVE, NEGATIVE], "label", "hit")


def running_totals(
    history: DataFrame, batch: str, label: str = "label", count: str = "count", span: int = 1024
) -> DataFrame:
    """Cumulative count per label over batches.

    Batches are summed per span first; only span totals are accumulated per label, and each span is then
    accumulated on its own. No window partition holds more than ``span`` batches or one row per span.
    """
    # The history is used twice but must not be computed twice: it is one row per batch and label, made
    # from all the texts. Writing it keeps the texts to one pass.
    spans = written(history.withColumn("_span", F.floor(F.col(batch) / span)), "batch-history")
    whole = Window.partitionBy(label).orderBy("_span").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        spans.groupBy(label, "_span")
        .agg(F.sum(count).alias("_total"))
        .select(label, "_span", F.coalesce(F.sum("_total").over(whole), F.lit(0)).alias("_before"))
    )
    within = (
        Window.partitionBy(label, "_span").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        spans.join(before, [label, "_span"])
        .select(batch, label, (F.col("_before") + F.sum(count).over(within)).alias("running_count"))
    )


def preview(df: DataFrame, order: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` rows in a stated order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(n)
