"""Edge rules of the text functions, on literal rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postlens.functions import stemming, text


@pytest.fixture
def value(spark):
    def run(expression, given):
        df = spark.createDataFrame([(given,)], "t STRING")
        return df.select(expression(F.col("t")).alias("v")).first().v

    return run


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("Halo<br />DUNIA", "halo dunia"),
        ("a1b2", "a b "),
        ("a  b", "a  b"),
        ("x\n\ny", "x y"),
        ("café!", "caf "),
        ("", ""),
        (None, None),
        ("!!!", " "),
    ],
)
def test_clean_text(value, given, wanted):
    assert value(text.clean_text, given) == wanted


def test_ascii(value):
    assert value(text.ascii_strip, "aéb😀c") == "abc"
    assert value(text.ascii_replace, "aéb😀c") == "a?b?c"
    assert value(text.ascii_strip, None) is None


def test_split_words_knows_every_white_space(value):
    assert value(text.split_words, " a\tb c d　\x0be ") == ["a", "b", "c", "d", "e"]
    assert value(text.split_words, "“quoted” text") == ["“quoted”", "text"]
    assert value(text.split_words, "") == []
    assert value(text.split_on_space, "a  b") == ["a", "", "b"]


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("Hello, world.", ["hello", ",", "world", "."]),
        ("Price: 1,000 at 10:30.", ["price", ":", "1,000", "at", "10:30", "."]),
        ("PT Maju (Persero), Tbk", ["pt", "maju", "(", "persero", ")", ",", "tbk"]),
        ('He said "yes"!', ["he", "said", "``", "yes", "''", "!"]),
        ("it's don't", ["it", "'s", "do", "n't"]),
        ("wait... ok", ["wait", "...", "ok"]),
        ("#tag @user", ["#", "tag", "@", "user"]),
        ("First. Second.", ["first", ".", "second", "."]),
        ("", []),
        (None, None),
    ],
)
def test_word_tokens(spark, given, wanted):
    df = spark.createDataFrame([(given,)], "t STRING")
    assert text.with_word_tokens(df, "t", "tokens").first().tokens == wanted


def test_regex_words(value):
    assert value(text.regex_words, "Ça va_bien 42!") == ["ça", "va_bien", "42"]


ROOTS = ["lari", "pukul", "tulis", "sapu", "kirim", "ajar", "makan", "baca", "buku", "main", "beri"]


@pytest.mark.parametrize(
    ("word", "stem"),
    [
        ("berlari", "lari"),
        ("memukul", "pukul"),
        ("menulis", "tulis"),
        ("menyapu", "sapu"),
        ("mengirim", "kirim"),
        ("pelajar", "ajar"),
        ("makanan", "makan"),
        ("makan", "makan"),
        ("bukunya", "buku"),
        ("bacalah", "baca"),
        ("bukukulah", "buku"),
        ("memberikan", "beri"),
        ("dibacakannya", "baca"),
        ("permainan", "main"),
        ("xyzan", "xyzan"),
        ("komputer", "komputer"),
    ],
)
def test_stem(spark, word, stem):
    df = spark.createDataFrame([(word,)], "w STRING")
    assert df.select(stemming.stem_word("w", ROOTS).alias("s")).first().s == stem
