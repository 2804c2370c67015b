"""Token lookups against dictionaries of any size.

A dictionary of checked, small size is used as a plan literal and needs no shuffle. A larger one is joined, with
each token carrying its position, and only the tokens that match travel back to their text, in order. Either form
gives the same result; the work of the join grows with the tokens, not with their square. A token found in nearly
every text makes a hot join key: a dictionary of measured size is broadcast, and beyond that adaptive execution
splits the key, as its rows meet one dictionary row and are not aggregated by token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlens.functions.literals import in_set, map_value
from postlens.operators.explode import positioned_items
from postlens.sources.dictionaries import LITERAL_LIMIT, bounded_rows

BROADCAST_BYTES = 64 << 20


def small_enough_to_broadcast(table: DataFrame, row_bytes: Column) -> bool:
    """Measured, not assumed: the bytes of all rows plus an allowance for each."""
    size = table.agg(F.sum(row_bytes + F.lit(64)).alias("bytes")).first().bytes
    return (size or 0) <= BROADCAST_BYTES


def frequent(table: DataFrame, row_bytes: Column, count: str) -> int | None:
    """The least ``count`` from which on the rows of ``table`` may be broadcast together; None where all may.

    Counts go down in few steps, as a corpus of N words has less than sqrt(2 N) different ones.
    """
    steps = table.groupBy(count).agg(F.sum(row_bytes + F.lit(64)).alias("bytes"))
    upto = F.sum("bytes").over(Window.orderBy(F.desc(count)))
    fits = steps.withColumn("upto", upto).withColumn("fits", F.col("upto") <= BROADCAST_BYTES)
    found = fits.agg(F.count_if(~F.col("fits")).alias("over"), F.max(F.when(~F.col("fits"), F.col(count))).alias("highest")).first()
    return found.highest + 1 if found.over else None


def matches(
    df: DataFrame, id_cols: Sequence[str], array: str, table: DataFrame, key: str, values: Sequence[str], out: str,
    lower: bool = False,
) -> DataFrame:
    """``df`` with ``out``: a struct of position and ``values`` for each element of ``array`` that is a key of
    ``table``, in order; empty where nothing matches, null where ``array`` is.

    ``id_cols`` must identify a row of ``df``; ``table`` has one row per key. With ``lower`` elements are
    looked up in lower case.
    """
    element = F.lower("_element") if lower else F.col("_element")
    asked = positioned_items(df, array, "pos", "_element", id_cols).withColumn("_element", element)
    entries = table.select(F.col(key).alias("_element"), *values)
    sizes = [F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in entries.columns]
    width = sizes[0]
    for size in sizes[1:]:
        width = width + size
    found = asked.join(F.broadcast(entries) if small_enough_to_broadcast(entries, width) else entries, "_element")
    per_row = found.groupBy(*id_cols).agg(F.array_sort(F.collect_list(F.struct("pos", *values))).alias(out))
    # Left join on a unique row key: rows without any match get the empty list.
    joined = df.join(per_row, list(id_cols), "left")
    nothing = F.array().cast(per_row.schema[out].dataType)
    return joined.withColumn(out, F.when(F.col(array).isNotNull(), F.coalesce(out, nothing)))


def _put_in(words: str, hits: str, other: str) -> str:
    """SQL: ``words`` with the hits at their positions; where both claim a position the hit sorts first."""
    plain = f"transform({words}, (__w, __i) -> named_struct('pos', __i, 'rank', 1, 'token', {other}))"
    chosen = f"transform({hits}, __h -> named_struct('pos', __h.pos, 'rank', 0, 'token', __h._value))"
    first = "filter(__all, (__x, __i) -> __i = 0 OR get(__all, __i - 1).pos <> __x.pos)"
    return (
        f"get(transform(array(array_sort(concat({plain}, {chosen}))), "
        f"__all -> transform({first}, __x -> __x.token)), 0)"
    )


def replace_tokens(
    df: DataFrame, id_cols: Sequence[str], words: str, dictionary: DataFrame, out: str, key: str = "key",
    value: str = "value", limit: int = LITERAL_LIMIT, lower: bool = True, other: str = "__w",
) -> DataFrame:
    """Array ``out``: each token replaced by its dictionary value; an unknown token ``__w`` becomes the SQL
    ``other``, by default itself. With ``lower`` tokens are looked up in lower case."""
    asked = "lower(__w)" if lower else "__w"
    rows = bounded_rows(dictionary.select(key, F.col(value).cast("string").alias(value)), limit)
    if rows is not None:
        mapping = {row[key]: row[value] for row in rows}
        replaced = f"CASE WHEN {in_set(asked, mapping)} THEN {map_value(asked, mapping)} ELSE {other} END"
        return df.withColumn(out, F.expr(f"transform({words}, __w -> {replaced})"))
    entries = dictionary.select(F.col(key).alias("_key"), F.col(value).cast("string").alias("_value"))
    matched = matches(df, id_cols, words, entries, "_key", ["_value"], "_hits", lower)
    return matched.withColumn(out, F.expr(_put_in(words, "_hits", other))).drop("_hits")


