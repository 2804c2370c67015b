"""Embedding rows that can be worked with, and their entries as whole numbers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _finite(vector: Column) -> Column:
    """Not null and without null, NaN or infinite entries."""
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True))


def usable(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """``rows`` with ``vector`` as doubles, without null vectors or entries that are null or not finite; and the
    vectors' length.

    Vectors of another length than the most frequent one (the longer of two as frequent) take no part either: they
    have no place in a common space. No rows have length 0.
    """
    plain = rows.withColumn(vector, F.col(vector).cast("array<double>"))
    good = plain.filter(_finite(F.col(vector)))
    lengths = good.groupBy(F.size(vector).alias("d")).count()
    most = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    width = most.d if most else 0
    return good.filter(F.size(vector) == width), width


def whole(vector: Column, scale: int, most: int, offset: int = 0) -> Column:
    """floor(scale * entry) + offset per entry, as longs. Products beyond ``most`` either way count as that."""
    bound = F.lit(float(most))
    return F.transform(vector, lambda c: F.floor(F.greatest(F.least(c * float(scale), bound), -bound)) + F.lit(offset).cast("long"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """The lists of an Arrow column, all ``width`` long, as the rows of a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
