"""What was read of a topic: ranges of offsets, gaps, repeats, and where to go on.

Offsets of a partition are gathered into ranges without holes, block by block, so that no task holds the history of a
partition; what is left are ranges, merged as intervals. Ranges of batches merge in the same way, so the ledger of a
stream is read from its batches' ranges and never from its messages.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Offsets that one group of the first step may span.
BLOCK = 1 << 16
SOURCE = ("topic", "partition")


def _merged(ranges: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``(keys, first, last, messages)`` with ranges that touch or overlap made one."""
    order = Window.partitionBy(*keys).orderBy("first", "last")
    reached = F.max("last").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("first") > reached + 1, 1).otherwise(0)
    numbered = ranges.withColumn("_opens", opens).withColumn("_range", F.sum("_opens").over(order))
    merged = numbered.groupBy(*keys, "_range").agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("messages").alias("messages"))
    return merged.drop("_range")


def ranges(messages: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """``(keys, first, last, messages)``: the ranges of ``messages(keys, offset)`` that have every offset, and how many messages
    they hold, repeated ones counted. Messages without offset are no part of any."""
    blocks = [*keys, "_block"]
    seen = messages.where(F.col("offset").isNotNull()).groupBy(*keys, F.col("offset")).agg(F.count("*").alias("n"))
    placed = seen.withColumn("_block", F.floor(F.col("offset") / BLOCK))
    run = F.col("offset") - F.row_number().over(Window.partitionBy(*blocks).orderBy("offset"))
    found = placed.withColumn("_run", run).groupBy(*blocks, "_run").agg(
        F.min("offset").alias("first"), F.max("offset").alias("last"), F.sum("n").alias("messages"),
    )
    return _merged(found.drop("_run", "_block"), keys)


def ledger(ranges_: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """``(keys, first, last, messages, repeats, missing)`` of ranges from any number of batches.

    repeats counts messages beyond one for each offset, whether a batch or several had them; missing are the offsets between
    a range and the next one of its partition, 0 after the last.
    """
    merged = _merged(ranges_.select(*keys, "first", "last", "messages"), keys)
    following = F.lead("first").over(Window.partitionBy(*keys).orderBy("first"))
    return merged.select(
        *keys, "first", "last", "messages", (F.col("messages") - (F.col("last") - F.col("first") + 1)).alias("repeats"),
        F.coalesce(following - F.col("last") - 1, F.lit(0)).alias("missing"),
    )


def resume_points(ledger_: DataFrame, keys: Sequence[str] = SOURCE) -> DataFrame:
    """``(keys, safe, seen)``: the first offset that was not read, so that all before were, and the one after the last read."""
    lowest = F.min_by(F.col("last"), F.col("first"))
    return ledger_.groupBy(*keys).agg((lowest + 1).alias("safe"), (F.max("last") + 1).alias("seen"))


def starting_offsets(points: DataFrame, offset: str = "safe") -> str:
    """The ``startingOffsets`` of a topic stream that goes on from ``points(topic, partition, safe, seen)``: JSON with the offset of
    each partition. Reads one row for each partition of the topics."""
    found: dict[str, dict[str, int]] = {}
    for row in points.select("topic", "partition", F.col(offset).alias("at")).orderBy("topic", "partition").collect():
        found.setdefault(row.topic, {})[str(row.partition)] = row["at"]
    return json.dumps(found)
