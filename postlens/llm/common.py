"""Small helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.session import written

#: Characters that part words: space, tab, line feed, vertical tab, form feed, carriage return.
GAPS = "[\\x20\\x09-\\x0D]+"
BROADCAST_ROWS = 100_000
_SHIPPED: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAPS), "")


def n_words(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def measured(small: DataFrame, purpose: str, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A frame of few, short rows, written once and broadcast if its counted rows stay within ``rows``.

    Beyond that it joins by shuffle, where adaptive execution splits hot keys.
    """
    kept = written(small, purpose)
    return F.broadcast(kept) if kept.limit(rows + 1).count() <= rows else kept


def _ship(context: SparkContext) -> None:
    """Send this package to the Python workers, once for each application: they run on machines that don't have it."""
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for source in sorted(root.rglob("*.py")):
            target.write(source, source.relative_to(root.parent))
    # Spark serves the driver's file to the executors; nothing is read by its path there.
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def arrow_map(df: DataFrame, batches: Callable, schema) -> DataFrame:
    """``mapInArrow`` whose Python workers have this package, wherever they run."""
    _ship(df.sparkSession.sparkContext)
    return df.mapInArrow(batches, schema)
