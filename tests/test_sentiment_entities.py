from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postlens.functions import entities, sentiment

POS, NEG = {"bagus", "tahan", "senang"}, {"buruk", "tahan", "jelek"}


@pytest.mark.parametrize(
    ("words", "label", "score"),
    [
        (["bagus"], "positif", 1.0),
        (["tahan"], "negatif", -1.0),
        (["bagus", "buruk", "jelek"], "negatif", -1 / 3),
        (["bagus", "buruk"], "netral", 0.0),
        (["lain"], "netral", 0.0),
        ([], "netral", 0.0),
        (None, "netral", 0.0),
    ],
)
def test_label_and_score(spark, words, label, score):
    df = spark.createDataFrame([(words,)], "w ARRAY<STRING>")
    pos, neg = sentiment.hit_counts("w", POS, NEG)
    row = df.select(pos.alias("p"), neg.alias("n")).select(
        sentiment.label(F.col("p"), F.col("n")).alias("l"), sentiment.score(F.col("p"), F.col("n")).alias("s")
    ).first()
    assert (row.l, row.s) == (label, score)


def test_word_polarity_asks_the_positive_list_first(spark):
    df = spark.createDataFrame([("tahan",), ("jelek",), ("lain",)], "w STRING")
    got = [r.p for r in df.select(sentiment.word_polarity("w", POS, NEG).alias("p")).collect()]
    assert got == ["positive", "negative", None]


@pytest.mark.parametrize(
    ("words", "wanted"),
    [
        (["joko", "widodo"], ["joko widodo"]),
        (["kata", "joko"], ["joko"]),
        (["joko", "kata"], ["joko"]),
        (["joko", "joko", "widodo"], ["joko joko", "joko widodo"]),
        (["joko", "widodo", "joko", "widodo"], ["joko widodo"]),
        (["widodo"], []),
        ([], []),
    ],
)
def test_begin_inside(spark, words, wanted):
    df = spark.createDataFrame([(words,)], "w ARRAY<STRING>")
    found = entities.begin_inside("w", ["joko"], ["widodo", "joko"])
    assert df.select(found.alias("e")).first().e == wanted


def test_inside_entry_may_be_punctuation(spark):
    df = spark.createDataFrame([(["pt", ",", "x"],)], "w ARRAY<STRING>")
    assert df.select(entities.begin_inside("w", ["pt"], [","]).alias("e")).first().e == ["pt ,"]


def test_empty_dictionaries_find_nothing(spark):
    df = spark.createDataFrame([(["a", "b"],)], "w ARRAY<STRING>")
    assert df.select(entities.begin_inside("w", [], []).alias("e")).first().e == []


def test_places_stay_aligned_when_some_are_unknown(spark):
    gazetteer = {"bandung": ("0654'S", "10737'E"), "jakarta pusat": ("0610'S", "10650'E")}
    df = spark.createDataFrame([(["barat", "sorong", "bandung", "x", "jakarta pusat"],)], "p ARRAY<STRING>")
    places = df.select(entities.located("p", gazetteer).alias("l")).first().l
    assert [(p.place, p.lat, p.long) for p in places] == [
        ("bandung", "0654'S", "10737'E"), ("jakarta pusat", "0610'S", "10650'E"),
    ]


def test_negative_events_keep_the_surface_word(spark):
    words = ["pembunuhan", "dibunuh", "pembunuhan", "korupsi", "mencuri", "bunga", "terculik"]
    df = spark.createDataFrame([(words,)], "w ARRAY<STRING>")
    found = entities.by_stem("w", ["curi", "bunuh", "korupsi", "culik"], ["bunga"])
    assert df.select(found.alias("e")).first().e == [
        "pembunuhan", "dibunuh", "korupsi", "mencuri", "terculik",
    ]
