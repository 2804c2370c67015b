"""Row selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def by_keyword(df: DataFrame, keyword: str, language: str, text: str = "text", lang: str = "lang") -> DataFrame:
    """Posts in one language that mention a keyword, ignoring case."""
    return df.where((F.col(lang) == language) & F.contains(F.lower(text), F.lit(keyword.lower())))


def by_any_keyword(df: DataFrame, keywords: Iterable[str], text: str = "text") -> DataFrame:
    mentions = F.lit(False)
    for keyword in keywords:
        mentions = mentions | F.contains(F.lower(text), F.lit(keyword.lower()))
    return df.where(mentions)


def up_to_id(df: DataFrame, max_id: int | Column, id_col: str = "id") -> DataFrame:
    """Back-fill page: everything not newer than ``max_id``, a number or a scalar subquery. Reaches the scan
    as a pushed filter."""
    return df.where(F.col(id_col) <= (F.lit(max_id) if isinstance(max_id, int) else max_id))


def id_marks(df: DataFrame, by: list[str], id_col: str = "id") -> DataFrame:
    """Lowest and highest id seen per group: where the next page starts and where new posts begin."""
    return df.groupBy(*by).agg(F.min(id_col).alias("low_id"), F.max(id_col).alias("high_id"))
