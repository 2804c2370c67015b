"""Text cleaning and tokenising, as built-in column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Classes are spelled out character by character: Java tests such a class with one bit set, but a class of
# several ranges with a chain of calls, several times slower on every character of every text.
LOWER = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"

# The cleaning patterns every stored result depends on.
NON_ASCII = r"[^\x00-\x7F]"
NON_LETTERS = f"[^{LOWER} ]+"
LINE_BREAK_TAG = "<br />"
# Unicode white space, written out so that every regular-expression dialect reads it alike.
WHITE_SPACE = (
    r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"
)
ASCII_WHITE_SPACE = "[ \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f]+"
MAYBE_OTHER_WHITE_SPACE = r"[\x{85}\x{A0}\x{1680}-\x{3000}]"
WORD = rf"[_{DIGITS}{LOWER}\p{{L}}\p{{N}}]+"

# Word tokeniser after the published Penn Treebank rules, in order. No look-around.
TREEBANK_RULES = (
    (r'(^|[ (\[{<])"', "$1 `` "),
    (r"([:,])([^0-9]|\z)", " $1 $2"),
    (r"([^.])\.([\])}>\"']*)([ \t\r\n]|\z)", "$1 . $2 "),
    (r"(\.\.\.|--|[;@#$%&?!\]\[(){}<>])", " $1 "),
    (r'"', " '' "),
)
CONTRACTION_RULE = (r"([^' ])('s|'m|'d|'ll|'re|'ve|n't|')( |\z)", "$1 $2 ")


def ascii_strip(text: Column) -> Column:
    """Drop every non-ASCII character; null stays null."""
    return F.regexp_replace(text, NON_ASCII, "")


def ascii_replace(text: Column) -> Column:
    """One question mark for every non-ASCII character."""
    return F.regexp_replace(text, NON_ASCII, "?")


def clean_text(text: Column) -> Column:
    """Lower-case; every run of anything but letters and spaces becomes one space."""
    lowered = F.replace(F.lower(text), F.lit(LINE_BREAK_TAG), F.lit(" "))
    return F.regexp_replace(lowered, NON_LETTERS, " ")


def split_on_space(text: Column) -> Column:
    """Split at each single space; empty tokens are kept."""
    return F.split(text, " ")


def split_cleaned(text: Column) -> Column:
    """Tokens of a text whose only white space is the space; no empty tokens."""
    return F.array_remove(F.split(text, " "), "")


def split_words(text: Column, original: Column | None = None) -> Column:
    """Split on white-space runs of any kind; no empty tokens.

    ``original`` may name the plain column ``text`` was computed from: it has the same kinds of white space
    and is cheaper to look at.
    """
    unusual = F.rlike(text if original is None else original, F.lit(MAYBE_OTHER_WHITE_SPACE))
    parts = F.when(unusual, F.split(text, WHITE_SPACE)).otherwise(F.split(text, ASCII_WHITE_SPACE))
    return F.array_remove(parts, "")


def with_word_tokens(df: DataFrame, source: str, out: str) -> DataFrame:
    """Adds ``out``: lower-cased tokens of column ``source``, punctuation standing alone (Treebank style).

    The steps are separate columns so that each is computed, and its code generated, once: nested inside
    the conditions they would be repeated until the generated method is too long for the JIT compiler.
    """
    padded = F.lower(F.col(source))
    for pattern, replacement in TREEBANK_RULES:
        padded = F.regexp_replace(padded, pattern, replacement)
    apart = F.regexp_replace("_padded", *CONTRACTION_RULE)
    apostrophes = F.contains(F.col(source), F.lit("'"))
    return (
        df.withColumn("_padded", padded)
        .withColumn("_apart", F.when(apostrophes, apart).otherwise(F.col("_padded")))
        .withColumn(out, split_words(F.col("_apart"), original=F.col(source)))
        .drop("_padded", "_apart")
    )


def regex_words(text: Column) -> Column:
    """Lower-cased runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD), F.lit(0))
