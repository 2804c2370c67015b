"""The newest row of each key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def latest_by_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest ``order``. Keys may be null; so may other columns.

    An aggregate that carries whole rows can't hash and sorts its whole input first. Here the greatest first
    order value of each key (the first field, if it is a struct) is found by a hash aggregate and joined back;
    only the rows that have it are settled by ``max_by``.
    """
    rest = [c for c in df.columns if c != key]
    kind = df.schema[order[0]].dataType
    first = f"{order[0]}.{kind.names[0]}" if isinstance(kind, StructType) else order[0]
    best = df.groupBy(F.col(key).alias("_key")).agg(F.max(first).alias("_best"))
    kept = df.join(best, F.col(key).eqNullSafe(F.col("_key")) & F.col(first).eqNullSafe(F.col("_best")))
    newest = kept.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return newest.select(key, *[F.col("_row")[c].alias(c) for c in rest])
