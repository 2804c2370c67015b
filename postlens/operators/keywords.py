"""Posts that mention any of a table of keywords, phrases included, ignoring case: an index instead of a predicate for each.

A keyword without a space is in a text if one of the text's words holds it, so keywords are looked for in the distinct words of all
posts, once each, through the rarest three letters of the keyword. Words that hold one lead to the posts; a phrase is
found by its longest part first and then verified in the text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.explode import items
from postlens.operators.lookup import small_enough_to_broadcast
from postlens.session import written

GRAM = 3


def _grams(word: Column, size: Column) -> Column:
    """Distinct runs of ``size`` characters of a word; none if it is shorter."""
    last = F.char_length(word) - size + 1
    starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(word, i, size)))


def _maybe_broadcast(table: DataFrame) -> DataFrame:
    size = sum((F.octet_length(c) for c in table.columns), F.lit(0))
    return F.broadcast(table) if small_enough_to_broadcast(table, size) else table


def holding_words(words: DataFrame, parts: DataFrame) -> DataFrame:
    """``(word, part)`` of ``words(word)`` that hold one of ``parts(part)``; both distinct, without empty ones.

    Of each part the run of three letters (fewer, if it is shorter) that the fewest words have is looked up; what it
    finds is verified.
    """
    sizes = [r.n for r in parts.select(F.least(F.lit(GRAM), F.char_length("part")).alias("n")).distinct().collect()]
    sized = F.array(*(F.lit(n) for n in sizes)).cast("array<int>")
    grams = F.flatten(F.transform(sized, lambda n: _grams(F.col("word"), n)))
    of_words = items(words, grams, "gram", ["word"])
    of_parts = items(parts, _grams(F.col("part"), F.least(F.lit(GRAM), F.char_length("part"))), "gram", ["part"])
    wanted = written(of_parts, "keyword-grams")
    counts = of_words.join(_maybe_broadcast(wanted.select("gram").distinct()), "gram").groupBy("gram").agg(F.count("*").alias("n"))
    rarest = wanted.join(counts, "gram", "left").groupBy("part").agg(F.min_by("gram", F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("gram"))
    found = of_words.join(_maybe_broadcast(written(rarest, "rarest-grams")), "gram")
    return found.where(F.contains("word", F.col("part"))).select("word", "part")


def mentions(df: DataFrame, id_cols: Sequence[str], keywords: DataFrame, text: str = "text", keyword: str = "keyword") -> DataFrame:
    """``(id_cols, keyword)``: each keyword of the table that a post's text holds, in lower case, once for each row.

    Null and empty keywords, and those of spaces alone, are in no text; keywords that differ in case are one. ``id_cols`` must
    identify a row. Null and empty texts mention nothing.
    """
    lowered = keywords.select(F.lower(keyword).alias("_keyword")).where(F.btrim("_keyword", F.lit(" ")) != "").distinct()
    longest = F.reduce(F.split("_keyword", " "), F.lit(""), lambda a, p: F.when(F.char_length(p) > F.char_length(a), p).otherwise(a))
    asked = written(lowered.select("_keyword", longest.alias("part")), "keywords")
    words_of = df.select(*id_cols, F.array_distinct(F.array_remove(F.split(F.lower(text), " "), "")).alias("_words"))
    words = written(items(words_of, "_words", "word").distinct(), "words")
    held = written(holding_words(words, asked.select("part").distinct()), "holding-words")
    by_word = held.join(asked, "part").select("word", "_keyword", (F.col("part") != F.col("_keyword")).alias("_phrase"))
    candidates = items(words_of, "_words", "word", id_cols).join(_maybe_broadcast(written(by_word, "keyword-words")), "word")
    candidates = candidates.select(*id_cols, "_keyword", "_phrase").distinct()
    certain = candidates.where(~F.col("_phrase"))
    phrases = candidates.where("_phrase").join(df.select(*id_cols, F.lower(text).alias("_text")), list(id_cols))
    verified = phrases.where(F.contains("_text", F.col("_keyword")))
    return certain.select(*id_cols, "_keyword").unionByName(verified.select(*id_cols, "_keyword")).withColumnRenamed("_keyword", keyword)
