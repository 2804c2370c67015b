"""Lexicon sentiment as column expressions over a token array."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.literals import in_set

# The labels stored with every post.
LABEL_POSITIVE = "positif"
LABEL_NEGATIVE = "negatif"
LABEL_NEUTRAL = "netral"


def count_in(words: str, members: Iterable[str], unless: Iterable[str] = ()) -> Column:
    """How many tokens of ``words`` are in ``members`` and not in ``unless``."""
    kept = set(members) - set(unless)
    return F.expr(f"size(filter({words}, __w -> {in_set('__w', kept)}))")


def hit_counts(words: str, positive: Iterable[str], negative: Iterable[str]) -> tuple[Column, Column]:
    """(positive, negative) token counts; a word listed on both sides counts as negative."""
    negative = set(negative)
    return count_in(words, positive, unless=negative), count_in(words, negative)


def label(pos: Column, neg: Column) -> Column:
    return (
        F.when(neg > pos, LABEL_NEGATIVE).when(pos > neg, LABEL_POSITIVE).otherwise(LABEL_NEUTRAL)
    )


def score(pos: Column, neg: Column) -> Column:
    """(pos - neg) / (pos + neg), 0 when nothing was found."""
    return F.when(pos + neg > 0, (pos - neg) / (pos + neg)).otherwise(F.lit(0.0))


def word_polarity(word: str, positive: Iterable[str], negative: Iterable[str]) -> Column:
    """Polarity of one word; here the positive list is asked first."""
    return F.expr(
        f"CASE WHEN {in_set(word, positive)} THEN 'positive' WHEN {in_set(word, negative)} THEN 'negative' END"
    )
