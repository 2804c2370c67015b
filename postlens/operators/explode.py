"""Explode without recomputing the array.

For a plain ``explode`` of a computed array Catalyst infers a filter on the array's size and evaluates the
whole computation again in it. The outer form infers nothing; the null row it adds for an empty array is
dropped afterwards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def items(df: DataFrame, array: Column | str, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, name)``: one row per array element; elements must not be null."""
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def positioned_items(df: DataFrame, array: Column | str, pos: str, name: str, keep: Sequence[str] = ()) -> DataFrame:
    """``(keep, pos, name)``: the same with the element's position."""
    return df.select(*keep, F.posexplode_outer(array).alias(pos, name)).where(F.col(pos).isNotNull())
