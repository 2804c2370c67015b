"""Word-frequency spelling correction over distinct words.

A known word is its own correction; otherwise the most frequent known word one edit away, else two edits
away, else the word itself. An edit deletes a character, swaps two neighbours, or replaces by or inserts a
letter a-z. Comparing every unknown word with the whole vocabulary is avoided by joining on keys that any
two words within reach must share:

* candidates of up to ``DELETION_LENGTH`` characters: what is left after deleting up to d characters;
* longer candidates: one of five segments, of which two edits can damage at most four.

The keys only propose pairs; every pair is verified exactly. Two-edit keys are made only for the words
that have no known word one edit away.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.operators.explode import items
from postlens.operators.lookup import replace_tokens
from postlens.session import written
from postlens.sources.dictionaries import LITERAL_LIMIT

DELETION_LENGTH = 20
SEGMENTS = 5
# Fixed value: letters an edit may put in.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _deletions(word: str) -> str:
    return f"transform(sequence(1, length({word})), i -> concat(left({word}, i - 1), substr({word}, i + 1)))"


def _deletion_keys(word: str, edits: int) -> str:
    keys = [f"array({word})", _deletions(word)]
    if edits == 2:
        pairs = (
            f"flatten(transform(sequence(1, length({word}) - 1), i -> transform(sequence(i + 1, length({word})), "
            f"j -> concat(left({word}, i - 1), substr({word}, i + 1, j - i - 1), substr({word}, j + 1)))))"
        )
        keys.append(f"CASE WHEN length({word}) > 1 THEN {pairs} ELSE array() END")
    return f"array_distinct(concat({', '.join(keys)}))"


def _segment(word: str, length: str, index: str, shift: str) -> str:
    """Key of one segment: its number, the candidate's length and the text. Null outside the word."""
    start = f"cast(floor(({length}) * {index} / {SEGMENTS}) AS int)"
    end = f"cast(floor(({length}) * ({index} + 1) / {SEGMENTS}) AS int)"
    segment = f"substr({word}, {start} + {shift} + 1, {end} - {start})"
    return f"CASE WHEN {start} + {shift} >= 0 THEN concat({index}, ' ', {length}, ' ', {segment}) END"


def _known_keys(known: DataFrame, edits: int) -> DataFrame:
    segments = f"transform(sequence(0, {SEGMENTS - 1}), s -> {_segment('word', 'length(word)', 's', '0')})"
    keys = F.expr(
        f"CASE WHEN length(word) <= {DELETION_LENGTH} THEN {_deletion_keys('word', edits)} ELSE {segments} END"
    )
    named = known.select("word", F.col("word").alias("candidate"), F.col("count").alias("candidate_count"))
    return (
        items(named, keys, "key", ["candidate", "candidate_count"])
        .where("key <> ''")
        .unionByName(_empty_key(known, edits))
    )


def _empty_key(known: DataFrame, edits: int) -> DataFrame:
    """The one candidate of the empty key, which all words of up to ``edits`` characters share.

    Any of them reaches any letters-only word of that length by replacing everything, so only the best such
    word can be the answer; a word with other characters would also share one of them as a key. Without
    this, all pairs of very short words would be made.
    """
    short = known.where((F.length("word") <= edits) & ~F.col("word").rlike("[^a-z]"))
    best = short.agg(F.min_by(F.struct("word", "count"), F.struct(-F.col("count"), "word")).alias("best"))
    return best.where("best IS NOT NULL").select(
        F.col("best.word").alias("candidate"), F.col("best.count").alias("candidate_count"), F.lit("").alias("key")
    )


def _unknown_keys(unknown: DataFrame, edits: int) -> DataFrame:
    sizes = f"filter(sequence(length(word) - {edits}, length(word) + {edits}), n -> n > {DELETION_LENGTH})"
    segments = (
        f"flatten(flatten(transform({sizes}, n -> transform(sequence(0, {SEGMENTS - 1}), s -> "
        f"transform(sequence(-{edits}, {edits}), h -> {_segment('word', 'n', 's', 'h')})))))"
    )
    # A word near the border may match candidates on both sides of it, so it gets both kinds of keys.
    keys = F.expr(
        f"CASE WHEN length(word) <= {DELETION_LENGTH - edits} THEN {_deletion_keys('word', edits)} "
        f"WHEN length(word) <= {DELETION_LENGTH + edits} THEN "
        f"concat({_deletion_keys('word', edits)}, array_distinct({segments})) "
        f"ELSE array_distinct({segments}) END"
    )
    return items(unknown, keys, "key", ["word"])


def _swaps(word: str) -> str:
    return (
        f"transform(filter(sequence(1, length({word})), i -> i < length({word})), i -> "
        f"concat(left({word}, i - 1), substr({word}, i + 1, 1), substr({word}, i, 1), substr({word}, i + 2)))"
    )


def _one_edit(word: str, other: str) -> str:
    """``other`` is one edit away from ``word``, with only letters put in."""
    kept = f"regexp_replace({word}, '[a-z]', '')"
    now = f"regexp_replace({other}, '[a-z]', '')"
    letters_only = (
        f"(length({other}) < length({word}) OR {kept} = {now} OR "
        f"(length({other}) = length({word}) AND length({now}) < length({kept})))"
    )
    return (
        f"((levenshtein({word}, {other}, 1) = 1 AND {letters_only}) OR "
        f"(length({word}) = length({other}) AND {word} <> {other} AND "
        f"levenshtein({word}, {other}, 2) = 2 AND exists({_swaps(word)}, t -> t = {other})))"
    )


def _two_edits(word: str, other: str) -> str:
    """``other`` is reached by two edits. Any order of two plain edits is the Levenshtein distance; a
    swap may come first, last or twice."""
    plain = f"levenshtein({word}, {other}, 2) BETWEEN 0 AND 2"
    swap_first = f"exists({_swaps(word)}, t -> levenshtein(t, {other}, 1) BETWEEN 0 AND 1)"
    swap_last = f"exists({_swaps(other)}, t -> levenshtein({word}, t, 1) BETWEEN 0 AND 1)"
    swap_twice = f"arrays_overlap({_swaps(word)}, {_swaps(other)})"
    in_reach = f"levenshtein({word}, {other}, 4) BETWEEN 0 AND 4"
    distance = f"({plain} OR ({in_reach} AND ({swap_first} OR {swap_last} OR {swap_twice})))"
    # Only a candidate with other characters can owe its closeness to an edit that may not put them in;
    # for those few the intermediate words are written out.
    spelled_out = f"exists({_edits(word)}, m -> {_one_edit('m', other)})"
    return f"({distance} AND (NOT {other} RLIKE '[^a-z]' OR {spelled_out}))"


def _edits(word: str) -> str:
    letters = f"split('{LETTERS}', '')"
    places = f"sequence(1, length({word}) + 1)"
    inserts = (
        f"flatten(transform({places}, i -> transform({letters}, "
        f"c -> concat(left({word}, i - 1), c, substr({word}, i)))))"
    )
    replaces = (
        f"flatten(transform(sequence(1, length({word})), i -> transform({letters}, "
        f"c -> concat(left({word}, i - 1), c, substr({word}, i + 1)))))"
    )
    return f"concat({_deletions(word)}, {_swaps(word)}, {replaces}, {inserts})"


def _best_within(unknown: DataFrame, known: DataFrame, edits: int) -> DataFrame:
    """``(word, correction)`` for the words with a candidate. The best is kept by an aggregate that
    combines before its shuffle; a pair proposed by several keys does no harm to it."""
    check = _one_edit("word", "candidate") if edits == 1 else _two_edits("word", "candidate")
    pairs = _unknown_keys(unknown, edits).join(_known_keys(known, edits), "key")
    near = pairs.where(F.abs(F.length("word") - F.length("candidate")) <= edits).where(F.expr(check))
    # Most frequent first, then the alphabetically first word.
    rank = F.struct(-F.col("candidate_count"), "candidate")
    return near.groupBy("word").agg(F.min_by("candidate", rank).alias("correction"))


def correct_words(words: DataFrame, frequencies: DataFrame) -> DataFrame:
    """``(word, correction)`` for the distinct lower-cased ``words(word)``, given ``(word, count)``.

    The vocabulary, the distinct words and the one-edit corrections are each needed several times, so they
    are written to the shared folder once: counting the corpus again for every use would dominate.
    """
    known = written(frequencies.select("word", "count"), "known-words")
    marked = words.where("word <> ''").distinct().join(known, "word", "left")
    asked = written(marked.select("word", F.col("count").isNotNull().alias("known")), "asked-words")
    unknown = asked.where("NOT known").select("word")
    once = written(_best_within(unknown, known, 1), "one-edit")
    twice = _best_within(unknown.join(once, "word", "left_anti"), known, 2)
    return asked.join(once.unionByName(twice), "word", "left").select(
        "word", F.coalesce("correction", "word").alias("correction")
    )


def correct_text(
    df: DataFrame, id_cols: Sequence[str], words: str, frequencies: DataFrame, out: str,
    limit: int = LITERAL_LIMIT,
) -> DataFrame:
    """Text ``out``: the tokens of ``words``, corrected and joined by one space."""
    distinct = items(df, F.array_distinct(words), "word").select(F.lower("word").alias("word"))
    fixes = written(correct_words(distinct, frequencies).where("word <> correction"), "corrections")
    fixed = replace_tokens(df, id_cols, words, fixes, "_fixed", "word", "correction", limit, other="lower(__w)")
    return fixed.withColumn(out, F.array_join("_fixed", " ")).drop("_fixed")
