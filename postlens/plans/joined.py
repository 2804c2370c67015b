"""The enrichment with dictionaries of any size, as joins.

What a dictionary says about a word is worked out once per distinct word of the posts, in tables; each post then
looks its tokens up by position (``postlens.operators.lookup``). Results equal those of the literal form.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import stemming, text
from postlens.functions.literals import quoted
from postlens.operators.explode import items, positioned_items
from postlens.operators.lookup import matches, small_enough_to_broadcast
from postlens.session import written


@dataclass(frozen=True)
class DictionaryTables:
    """Dictionaries as DataFrames, one row per key."""

    positive: DataFrame  # word
    negative: DataFrame  # word
    slang: DataFrame  # key, value
    roots: DataFrame  # word
    entities: DataFrame  # entity_type, role (B or I), token
    gazetteer: DataFrame  # place, latitude, longitude
    event_stems: DataFrame  # word


def _formal_words(words: DataFrame, dicts: DictionaryTables) -> DataFrame:
    """``(word, formal)``: each of ``words(word)`` stemmed and with slang replaced."""
    stem = words.join(stemming.stem_table(words, dicts.roots), "word", "left").withColumn("stem", F.coalesce("stem", "word"))
    slang = dicts.slang.select(F.col("key").alias("_slang"), F.col("value").alias("_formal"))
    return stem.join(slang, F.lower("stem") == F.col("_slang"), "left").select("word", F.coalesce("_formal", "stem").alias("formal"))


def _polar_words(words: DataFrame, dicts: DictionaryTables) -> DataFrame:
    """``(word, positive, negative)`` of the words whose formal text, cleaned on its own, has tokens on a list; a token
    listed on both sides counts as negative."""
    sides = dicts.positive.select("word", F.lit(0).alias("side")).unionByName(dicts.negative.select("word", F.lit(1).alias("side")))
    polar = sides.groupBy(F.col("word").alias("token")).agg(F.max("side").alias("side"))
    cleaned = text.split_cleaned(text.clean_text(F.col("formal")))
    tokens = items(_formal_words(words, dicts), cleaned, "token", ["word"])
    return tokens.join(polar, "token").groupBy("word").agg(F.count_if(F.col("side") == 0).alias("positive"), F.count_if(F.col("side") == 1).alias("negative"))


def _marked_words(words: DataFrame, dicts: DictionaryTables, kinds: Sequence[str]) -> DataFrame:
    """``(word, begins, inside, event)`` of the words that begin or continue an entity or whose stem is an event's."""
    wanted = dicts.entities.where(F.col("entity_type").isin(list(kinds)))
    role = lambda r: F.collect_set(F.when(F.col("role") == r, F.col("entity_type"))).alias(("begins", "inside")[r == "I"])
    typed = wanted.groupBy(F.col("token").alias("word")).agg(role("B"), role("I"))
    roots = dicts.roots.select("word").unionByName(dicts.event_stems.select("word"))
    stems = words.join(stemming.stem_table(words, roots), "word", "left").select("word", F.coalesce("stem", "word").alias("stem"))
    events = stems.join(dicts.event_stems.select(F.col("word").alias("stem")).distinct(), "stem").select("word", F.lit(True).alias("event"))
    found = words.join(typed, "word", "left").join(events, "word", "left")
    return found.where(F.col("begins").isNotNull() | F.col("event"))


def _entities(kind: str) -> Column:
    """Tokens of ``_marks`` that begin an entity of a type, with the next token if that is an inside token."""
    following = "get(_marks, __i + 1)"
    inside = f"coalesce({following}.at = __m.at + 1 AND array_contains({following}.inside, {quoted(kind)}), false)"
    one = f"CASE WHEN {inside} THEN concat(__m.word, ' ', {following}.word) ELSE __m.word END"
    all_ = f"transform(_marks, (__m, __i) -> CASE WHEN array_contains(__m.begins, {quoted(kind)}) THEN {one} END)"
    return F.expr(f"array_distinct(filter({all_}, __e -> __e IS NOT NULL))")


def found_words(texts: DataFrame, id_cols: Sequence[str], source: str, dicts: DictionaryTables, kinds: Sequence[str]) -> DataFrame:
    """Per row of ``texts(id_cols, source)`` that has a word in a dictionary: _pos and _neg (tokens on the lists, after stems
    and slang), an array ``_kind`` of entities for each of ``kinds``, _event, and _places from the entities of kind
    ``location``.

    The texts are read once: their tokens of both kinds are written, and what the dictionaries say about a
    word, worked out once for each distinct one, is looked up in one pass over the tokens and brought together by
    one grouping of those that match.
    """
    tokens = text.with_word_tokens(texts.withColumn("_raw", stemming.stem_tokens_of(F.col(source))), source, "_tokens")
    of = lambda kind, words: F.transform(words, lambda w: F.struct(F.lit(kind).alias("kind"), w.alias("word")))
    both = F.concat(of(0, F.col("_raw")), of(1, F.col("_tokens")))
    base = written(tokens.select(*id_cols, both.alias("_words")), "tokens")
    # Repeats fall to the aggregation before the shuffle; array_distinct compares structs pair by pair.
    words = written(items(base, "_words", "w").select("w.*").distinct(), "words")
    kind = lambda k: words.where(F.col("kind") == k).select("word")
    entries = written(
        _polar_words(kind(0), dicts).withColumn("kind", F.lit(0)).unionByName(_marked_words(kind(1), dicts, kinds).withColumn("kind", F.lit(1)), allowMissingColumns=True),
        "known-words",
    )
    width = F.octet_length("word") + 16 * (F.lit(4) + F.coalesce(F.greatest(F.size("begins") + F.size("inside"), F.lit(0)), F.lit(0)))
    asked = positioned_items(base, "_words", "at", "w", id_cols).select(*id_cols, "at", "w.*")
    known = F.broadcast(entries) if small_enough_to_broadcast(entries, width) else entries
    mark = F.when(F.col("kind") == 1, F.struct("at", "word", "begins", "inside", "event"))
    per_row = asked.join(known, ["kind", "word"]).groupBy(*id_cols).agg(
        F.coalesce(F.sum("positive"), F.lit(0)).alias("_pos"), F.coalesce(F.sum("negative"), F.lit(0)).alias("_neg"),
        F.array_sort(F.collect_list(mark)).alias("_marks"),
    )
    event = F.expr("array_distinct(transform(filter(_marks, __m -> __m.event), __m -> __m.word))")
    typed = written(per_row.withColumns({f"_{k}": _entities(k) for k in kinds} | {"_event": event}).drop("_marks"), "found-words")
    return with_located(typed, id_cols, "_location", dicts, "_places")


def with_located(df: DataFrame, id_cols: Sequence[str], places: str, dicts: DictionaryTables, out: str) -> DataFrame:
    """``array<struct<place,lat,long>>`` for the places found in the gazetteer, in order; others are dropped."""
    found = matches(df, id_cols, places, dicts.gazetteer, "place", ["latitude", "longitude"], "_found")
    located = f"transform(_found, __f -> named_struct('place', get({places}, __f.pos), 'lat', __f.latitude, 'long', __f.longitude))"
    return found.withColumn(out, F.expr(located)).drop("_found")
