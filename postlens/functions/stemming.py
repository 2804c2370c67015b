"""Affix stemming for Indonesian, guarded by a list of roots.

Follows the confix-stripping outline of Asian, Williams & Tahaghoghi (2005) and Adriani et al. (2007):
particles, possessives, then the derivational suffix come off first, prefixes (with the nasal sound
changes) after that, and a form is only accepted when it is a known root. The first accepted form wins;
a word without one is kept.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.literals import in_set, quoted
from postlens.functions.text import DIGITS, LOWER, split_cleaned

# The affixes, in the order they are tried.
PARTICLES = ("lah", "kah", "tah", "pun")
POSSESSIVES = ("nya", "ku", "mu")
SUFFIXES = ("kan", "an", "i")
PREFIXES = (
    "meng", "meny", "mem", "men", "me", "peng", "peny", "pem", "pen", "per", "pel", "pe", "ber", "bel",
    "be", "ter", "te", "di", "ke", "se",
)
BARE_PREFIXES = ("me", "pe", "be", "te", "di", "ke", "se")
# After "me" or "pe": the nasal that replaced a root's first letter, and that letter.
SOUND_CHANGES = (("ny", "s"), ("ng", "k"), ("m", "p"), ("n", "t"))
NOT_STEMMABLE = f"[^{LOWER}{DIGITS} -]+"


# Affixes are cut by comparing and slicing; a regular expression per form and token costs several times more.
def _without_end(word: str, endings: Iterable[str]) -> str:
    cases = " ".join(
        f"WHEN endswith({word}, {quoted(end)}) THEN left({word}, length({word}) - {len(end)})" for end in endings
    )
    return f"CASE {cases} ELSE {word} END"


def _without_start(word: str, starts: Iterable[str]) -> str:
    cases = " ".join(
        f"WHEN startswith({word}, {quoted(start)}) THEN substr({word}, {len(start) + 1})" for start in starts
    )
    return f"CASE {cases} ELSE {word} END"


def _sounded(word: str, nasal: str, letter: str) -> str:
    """``word`` with "me"/"pe" and the nasal turned back into the root's first letter."""
    return (
        f"CASE WHEN {in_set(f'left({word}, {len(nasal) + 2})', ('me' + nasal, 'pe' + nasal))} "
        f"THEN concat({quoted(letter)}, substr({word}, {len(nasal) + 3})) ELSE {word} END"
    )


def _has_prefix(word: str) -> str:
    return in_set(f"left({word}, 2)", BARE_PREFIXES)


def _has_affix(word: str) -> str:
    # "kan" ends in "an".
    return (
        f"({_has_prefix(word)} OR {in_set(f'right({word}, 3)', (*PARTICLES, 'nya'))} "
        f"OR {in_set(f'right({word}, 2)', ('an', 'ku', 'mu'))} OR endswith({word}, 'i'))"
    )


def _let(name: str, value: str, body: str) -> str:
    """Name an intermediate value inside an expression, so that it is computed once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def _unprefixed(base: str) -> str:
    """Array of the forms of ``base`` with a prefix removed, best first."""
    sounds = ", ".join(_sounded(base, nasal, letter) for nasal, letter in SOUND_CHANGES)
    return _let(
        "__once",
        _without_start(base, PREFIXES),
        f"array(__once, {sounds}, {_without_start(base, BARE_PREFIXES)}, "
        f"{_without_start('__once', PREFIXES)}, {_without_start('__once', BARE_PREFIXES)})",
    )


def _stripped(word: str, found: str) -> str:
    """``found`` with __s1, __s2, __s3 standing for ``word`` without particle, possessive and suffix."""
    inner = _let("__s2", _without_end("__s1", POSSESSIVES), _let("__s3", _without_end("__s2", SUFFIXES), found))
    return _let("__s1", _without_end(word, PARTICLES), inner)


def _from_short(word: str) -> str:
    return f"flatten(transform(array_distinct(array(__s3, __s2, __s1, {word})), __b -> {_unprefixed('__b')}))"


def stem_sql(word: str, roots: Iterable[str]) -> str:
    """SQL expression stemming one lower-case word.

    Forms are tried in order: the word, then without particle, possessive and suffix; then the same four
    from the shortest up with prefixes removed. Words that carry no affix cost a few comparisons.
    """
    accepted = in_set("__f", roots)
    unsuffixed = f"get(filter(array({word}, __s1, __s2, __s3), __f -> {accepted}), 0)"
    unprefixed = f"CASE WHEN {_has_prefix(word)} THEN get(filter({_from_short(word)}, __f -> {accepted}), 0) END"
    found = f"coalesce({unsuffixed}, {unprefixed}, {word})"
    return f"CASE WHEN {_has_affix(word)} THEN {_stripped(word, found)} ELSE {word} END"


def stem_table(words: DataFrame, roots: DataFrame) -> DataFrame:
    """``(word, stem)`` for the ``words(word)``, distinct and lower-case, that have another stem, given a root list
    of any size: the forms of each word are joined with it, and the first one that is a root is kept."""
    after = f"CASE WHEN {_has_prefix('word')} THEN {_from_short('word')} ELSE array() END"
    forms = _stripped("word", f"concat(array(word, __s1, __s2, __s3), {after})")
    tried = words.where(F.expr(_has_affix("word"))).select("word", F.posexplode_outer(F.expr(forms)).alias("at", "form"))
    known = tried.join(roots.select(F.col("word").alias("form")).distinct(), "form")
    return known.groupBy("word").agg(F.min_by("form", "at").alias("stem")).where("stem <> word")


def stem_word(word: str, roots: Iterable[str]) -> Column:
    return F.expr(stem_sql(word, roots))


def stemmable(text: Column) -> Column:
    """Lower-case, keep letters, digits, hyphens and spaces: the form stemming works on."""
    return F.regexp_replace(F.lower(text), NOT_STEMMABLE, " ")


def stem_words(words: str, roots: Iterable[str]) -> Column:
    """Stem every token of the array ``words`` (a column name or SQL expression)."""
    return F.expr(f"transform({words}, __w -> {stem_sql('__w', roots)})")


def stem_tokens_of(text: Column) -> Column:
    """The tokens that text stemming looks at."""
    return split_cleaned(stemmable(text))
