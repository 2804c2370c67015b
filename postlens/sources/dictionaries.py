"""Dictionary files as DataFrames, and as bounded driver-side values for plan literals.

Every loader works on a ``(line_no, line)`` frame, so a dictionary may come from text files or from any
table with an order. Nothing about a dictionary's size is assumed: see ``bounded_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from postlens.functions.text import split_words
from postlens.operators.latest import latest_by_key

LITERAL_LIMIT = 20_000


def read_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(path, line_no, line)`` for dictionary files of any size, read in splits.

    ``line_no`` orders the lines of a file: by the split they are in, then by their order within it.
    """
    place = F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"), place.alias("line_no"), F.col("value").alias("line")
    )


def word_set(lines: DataFrame, line: str = "line") -> DataFrame:
    """Distinct lines, stripped and lower-cased; blank lines carry no word."""
    word = F.lower(F.trim(F.col(line)))
    return lines.select(word.alias("word")).where("word <> ''").distinct()


def raw_word_set(lines: DataFrame, line: str = "line") -> DataFrame:
    """Distinct lines as written, case kept; the empty line is ignored."""
    return lines.select(F.col(line).alias("word")).where("word <> ''").distinct()


def _last_line_wins(entries: DataFrame, key: str, order: str, values: list[str]) -> DataFrame:
    return latest_by_key(entries, key, [order]).select(key, *values)


def slang_table(lines: DataFrame, line: str = "line", order: str = "line_no") -> DataFrame:
    """``(key, value)``: first token of each line -> the rest; the last line of a key wins."""
    parts = split_words(F.col(line))
    entries = lines.select(
        F.col(order).alias("_order"),
        F.get(parts, F.lit(0)).alias("key"),
        F.array_join(F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1))), " ").alias("value"),
    ).where("key IS NOT NULL")
    return _last_line_wins(entries, "key", "_order", ["value"])


def gazetteer(lines: DataFrame, sep: str | None = "\t") -> DataFrame:
    """``(place, latitude, longitude)``; ``sep=None`` reads the white-space form with one-token places."""
    parts: Column = split_words(F.col("line")) if sep is None else F.split("line", sep)
    entries = lines.select(
        "line_no",
        F.lower(F.get(parts, F.lit(0))).alias("place"),
        F.get(parts, F.lit(1)).alias("latitude"),
        F.get(parts, F.lit(2)).alias("longitude"),
    ).where("longitude IS NOT NULL")
    return _last_line_wins(entries, "place", "line_no", ["latitude", "longitude"])


def entity_dictionary(lines: DataFrame) -> DataFrame:
    """``(entity_type, role, token)`` from files named ``b_<type>.txt`` and ``i_<type>.txt``."""
    name = F.regexp_extract("path", r"([bi])_([a-z_]+)\.txt$", 2)
    role = F.upper(F.regexp_extract("path", r"([bi])_([a-z_]+)\.txt$", 1))
    token = F.lower(F.trim("line"))
    return (
        lines.select(name.alias("entity_type"), role.alias("role"), token.alias("token"))
        .where("entity_type <> '' AND token <> ''")
        .distinct()
    )


def bounded_rows(table: DataFrame, limit: int = LITERAL_LIMIT) -> list[Row] | None:
    """The rows of ``table`` if there are at most ``limit``, else ``None``: the size check that decides
    between a plan literal and a join."""
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def entity_sets(rows: Sequence[Row]) -> dict[str, tuple[set[str], set[str]]]:
    """``{entity_type: (begin tokens, inside tokens)}`` for the literal form."""
    sets: dict[str, tuple[set[str], set[str]]] = {}
    for row in rows:
        begin, inside = sets.setdefault(row.entity_type, (set(), set()))
        (begin if row.role == "B" else inside).add(row.token)
    return sets
