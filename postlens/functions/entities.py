"""Dictionary entities over a token array.

An entity starts at a token of the begin list and takes the following token along when that one is in
the inside list. Results are distinct and in first-seen order.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.literals import in_set, map_value, quoted
from postlens.functions.stemming import stem_sql

def heads(words: str, begin: Iterable[str]) -> str:
    """SQL: ``array<struct<token,following>>`` for the tokens that may begin an entity.

    One pass over the tokens serves all entity types: what is left is short.
    """
    head = f"named_struct('token', __w, 'following', get({words}, __i + 1))"
    marked = f"transform({words}, (__w, __i) -> CASE WHEN {in_set('__w', begin)} THEN {head} END)"
    return f"filter({marked}, __h -> __h IS NOT NULL)"


def from_heads(found: str, begin: Iterable[str], inside: Iterable[str]) -> Column:
    """Entities of one type among the heads ``found`` (a column name or SQL expression)."""
    text = (
        f"CASE WHEN {in_set('__h.following', inside)} THEN concat(__h.token, ' ', __h.following) ELSE __h.token END"
    )
    own = f"filter({found}, __h -> {in_set('__h.token', begin)})"
    return F.expr(f"array_distinct(transform({own}, __h -> {text}))")


def begin_inside(words: str, begin: Iterable[str], inside: Iterable[str]) -> Column:
    """Entities of one type in the token array ``words``."""
    return from_heads(heads(words, begin), begin, inside)


def with_types(
    df: DataFrame, words: str, types: Mapping[str, tuple[Iterable[str], Iterable[str]]], prefix: str = ""
) -> DataFrame:
    """One array column per entity type, named ``prefix`` + type."""
    begins = set().union(*(begin for begin, _ in types.values()))
    marked = df.withColumn("_heads", F.expr(heads(words, begins)))
    columns = {prefix + kind: from_heads("_heads", begin, inside) for kind, (begin, inside) in types.items()}
    return marked.withColumns(columns).drop("_heads")


def single_tokens(words: str, names: Iterable[str]) -> Column:
    """Entities that are one listed token."""
    return F.expr(f"array_distinct(filter({words}, __w -> {in_set('__w', names)}))")


def by_stem(words: str, stems: Iterable[str], roots: Iterable[str]) -> Column:
    """Distinct surface tokens whose stem is in ``stems``.

    A stem can only lose its first letter to a sound change, so a token without any stem's tail cannot
    match: one alternation settles nearly all tokens before the stemmer runs.
    """
    stems = sorted(set(stems))
    tails = "|".join(sorted({re.escape(s[1:] if len(s) > 1 else s) for s in stems}))
    stem = stem_sql("__w", set(roots) | set(stems))
    return F.expr(
        f"filter(array_distinct({words}), __w -> __w RLIKE {quoted(tails)} AND {in_set(stem, stems)})"
    )


def located(places: str, gazetteer: Mapping[str, tuple[str, str]]) -> Column:
    """``array<struct<place,lat,long>>`` for the places found in the gazetteer; others are dropped."""
    lat = map_value("__p", {k: v[0] for k, v in gazetteer.items()})
    long = map_value("__p", {k: v[1] for k, v in gazetteer.items()})
    return F.expr(
        f"transform(filter({places}, __p -> {in_set('__p', gazetteer)}), "
        f"__p -> named_struct('place', __p, 'lat', {lat}, 'long', {long}))"
    )


def joined(values: Column, separator: str = ",") -> Column:
    return F.array_join(values, separator)
