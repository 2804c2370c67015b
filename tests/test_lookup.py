"""Small dictionaries as literals and large ones as joins must agree."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postlens.operators import lookup, vocabulary
from postlens.plans.enrich import slang_tokens

ROWS = [(1, ["GPP", "saya", "egp", "Saya"]), (2, []), (3, None), (4, ["saya"] * 5), (5, ["gpp", "x"])]
SLANG = [("gpp", "tidak apa-apa"), ("egp", "emang gue pikirin")]


@pytest.fixture
def texts(spark):
    return spark.createDataFrame(ROWS, "id INT, words ARRAY<STRING>")


@pytest.fixture
def slang(spark):
    return spark.createDataFrame(SLANG, "key STRING, value STRING")


@pytest.mark.parametrize("limit", [100, 0])
@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_replace_tokens(texts, slang, limit, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(lookup, "BROADCAST_BYTES", broadcast_bytes)
    done = lookup.replace_tokens(texts, ["id"], "words", slang, "out", limit=limit)
    assert done.columns == ["id", "words", "out"]
    assert {r.id: r.out for r in done.collect()} == {
        1: ["tidak apa-apa", "saya", "emang gue pikirin", "Saya"], 2: [], 3: None, 4: ["saya"] * 5,
        5: ["tidak apa-apa", "x"],
    }


def test_literal_form_agrees(texts, slang):
    joined = lookup.replace_tokens(texts, ["id"], "words", slang, "out", limit=0)
    both = joined.withColumn("literal", slang_tokens("words", dict(SLANG)))
    assert both.where("NOT (out <=> literal)").count() == 0


@pytest.mark.parametrize("limit", [100, 0])
def test_encode_sequence(spark, limit):
    known = spark.createDataFrame([("a", 1), ("b", 1 << 40)], "word STRING, id BIGINT")
    sizes = (1, 69, 70, 71, 141)
    rows = [(n, ["a"] * (n - 1) + ["b"]) for n in sizes] + [(0, []), (2, ["zz", "b"]), (3, None)]
    texts = spark.createDataFrame(rows, "id INT, words ARRAY<STRING>")
    done = vocabulary.encode_sequence(texts, ["id"], "words", known, "ids", limit=limit)
    got = {(r.id, r.window): list(r.ids) for r in done.collect()}
    assert all(len(ids) == 70 for ids in got.values())
    assert got[0, 0] == [0] * 70 == got[3, 0] and got[2, 0] == [0, 1 << 40] + [0] * 68
    for n in sizes:
        windows = [got[n, w] for w in range(-(-n // 70))]
        assert [x for ids in windows for x in ids if x] == [1] * (n - 1) + [1 << 40]
    assert len(got) == 3 + 3 + 2 + 3


@pytest.mark.parametrize("small", [True, False])
def test_pooled_embedding_counts_repeats(spark, small, monkeypatch):
    monkeypatch.setattr(vocabulary, "small_enough_to_broadcast", lambda *_: small)
    ids = spark.createDataFrame([(1, [1, 1, 1 << 40, 0]), (2, [0, 0]), (3, [1 << 40, 9]), (4, None)], "id INT, ids ARRAY<BIGINT>")
    matrix = spark.createDataFrame([(1, [3.0, 0.0]), (1 << 40, [0.0, 6.0])], "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    pooled = vocabulary.pooled_embedding(ids, ["id"], "ids", matrix)
    got = {r.id: r["mean"] and list(r["mean"]) for r in pooled.collect()}
    assert got == {1: [2.0, 2.0], 2: None, 3: [0.0, 6.0], 4: None}


@pytest.mark.parametrize("small", [True, False])
@pytest.mark.parametrize("texts_of_a_group", [2, 8192])
def test_pooled_embedding_over_groups(spark, small, texts_of_a_group, monkeypatch):
    """Texts of one key in several groups, two vectors of one id, a null key, and more ids than are gathered at a time."""
    monkeypatch.setattr(vocabulary, "small_enough_to_broadcast", lambda *_: small)
    monkeypatch.setattr(vocabulary, "GROUP_TEXTS", texts_of_a_group)
    monkeypatch.setattr(vocabulary, "LOOKED_UP", 3)
    rows = [(1, "a", [1, 1, 2]), (2, "a", [3, 7, None]), (1, "a", [3]), (None, "b", [1]), (4, "b", [2] * 10 + [3] * 10), (5, None, [])]
    texts = spark.createDataFrame(rows, "id INT, s STRING, ids ARRAY<BIGINT>")
    matrix = spark.createDataFrame([(1, [4.0, 0.0]), (2, [0.0, 8.0]), (3, [1.0, 1.0]), (3, [3.0, 3.0]), (9, None)], "vec_id INT, embedding ARRAY<FLOAT>")
    pooled = vocabulary.pooled_embedding(texts, ["id", "s"], "ids", matrix)
    got = sorted(((r.id or 0, r.s or "", r["mean"] and [round(x, 9) for x in r["mean"]]) for r in pooled.collect()), key=str)
    four = [round(40 / 30, 9), round(120 / 30, 9)]
    assert got == [(0, "b", None), (1, "a", [2.4, 2.4]), (1, "a", [2.4, 2.4]), (2, "a", [2.0, 2.0]), (4, "b", four), (5, "", None)]


def test_pooling_shuffles_no_vector_for_each_word_of_a_text(spark, monkeypatch):
    """500 texts of the same 200 ids: 1 text or 500, the vectors of a group are sent to it once."""
    monkeypatch.setattr(vocabulary, "small_enough_to_broadcast", lambda *_: False)
    ids = spark.range(0, 500, 1, 2).selectExpr("id", "sequence(1L, 200L) AS ids")
    matrix = spark.range(1, 201).selectExpr("id AS vec_id", "array_repeat(cast(id AS float), 8) AS embedding")
    sent, plain = [], type(ids).distinct

    def counted(df):
        sent.append(plain(df).count())
        return plain(df)

    monkeypatch.setattr(type(ids), "distinct", counted)
    pooled = vocabulary.pooled_embedding(ids, ["id"], "ids", matrix)
    assert {tuple(r["mean"]) for r in pooled.collect()} == {(100.5,) * 8}
    assert sent == [2 * 200]


def test_weights_of_frequent_words_are_broadcast_and_others_joined(spark, monkeypatch):
    from postlens.operators import classify

    rows = [(1, ["the", "the", "a", "good"], 1), (2, ["the", "bad", "a"], 0), (3, ["the", "worse", "bad"], 0), (4, [], 1), (5, None, None), (6, ["new"], None), (None, ["the"], 1)]
    texts = spark.createDataFrame(rows, "id INT, words ARRAY<STRING>, label INT")
    counted = spark.createDataFrame([("the", 5), ("a", 2), ("bad", 2), ("good", 1), ("worse", 1)], "word STRING, n INT")
    found, least = [], []
    # A word takes 64 bytes, 8 for its weight and its own; with 160 only "the" fits, as two words were seen twice.
    for limit in (1 << 20, 160, 300, 0):
        monkeypatch.setattr(lookup, "BROADCAST_BYTES", limit)
        least.append(lookup.frequent(counted, F.octet_length("word") + 8, "n"))
        scored = classify.score(classify.fit(texts, "words", "label"), texts, ["id"], "words")
        found.append(sorted((r.id or 0, round(r.positive, 12), round(r.negative, 12)) for r in scored.collect()))
    assert least == [None, 3, 2, 6]
    assert found[0] == found[1] == found[2] == found[3] and found[0][1][1] > 0.5 > found[0][2][1]


def test_large_vocabulary_cleans_the_texts_once(spark, sf_dir):
    """The vocabulary is looked at three times and the words twice; neither starts from the texts again."""
    from postlens.plans.catalog import QUERIES

    plan = QUERIES["encode_sequence_large"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_replace" not in plan


def test_join_grows_with_the_tokens(spark):
    """A text of many tokens, all of them known: twice the tokens, about twice the time."""
    import time

    known = spark.range(30_000).selectExpr("concat('w', id) AS key", "concat('v', id) AS value")
    seconds = []
    for n in (4000, 4000, 8000):
        texts = spark.range(16).selectExpr("id", f"transform(sequence(1, {n}), i -> concat('w', i)) AS words")
        began = time.perf_counter()
        done = lookup.replace_tokens(texts, ["id"], "words", known, "out")
        assert done.where(F.get("out", F.lit(n - 1)) != f"v{n}").count() == 0
        seconds.append(time.perf_counter() - began)
    assert seconds[2] < 3 * seconds[1] + 2


def test_no_shuffle_for_small_dictionaries(texts, slang):
    done = lookup.replace_tokens(texts, ["id"], "words", slang, "out")
    assert "Exchange" not in done._jdf.queryExecution().executedPlan().toString()


def test_word_frequency(spark):
    texts = spark.createDataFrame([(["a", "b", "a"],), ([],), (["b", "a"],)], "words ARRAY<STRING>")
    rows = vocabulary.word_frequency(texts, "words").orderBy("word").collect()
    assert [(r.word, r["count"], r.probability) for r in rows] == [("a", 3, 0.6), ("b", 2, 0.4)]


def test_latest_and_running(spark):
    from postlens.operators import counts
    from postlens.operators.latest import latest_by_key

    rows = [(1, 10, "a"), (1, 12, "b"), (2, 5, None), (1, 12, "c")]
    df = spark.createDataFrame([(k, t, i, v) for i, (k, t, v) in enumerate(rows)], "id INT, t INT, n INT, v STRING")
    assert {(r.id, r.v) for r in latest_by_key(df, "id", ["t", "n"]).collect()} == {(1, "c"), (2, None)}
    history = spark.createDataFrame([(b, lab, 1) for b in range(5000) for lab in ("P", "N")], "b INT, label STRING, count INT")
    running = counts.running_totals(history, "b", span=64)
    assert running.where(F.col("running_count") != F.col("b") + 1).count() == 0
    assert running.count() == 10000


def test_class_totals_count_a_word_on_both_lists_twice(spark):
    from postlens.operators import counts

    df = spark.createDataFrame([(["x", "y", ""],), (["x"],)], "words ARRAY<STRING>")
    totals = counts.class_totals(df, "words", {"x"}, {"x", "y"})
    assert {r.label: r["count"] for r in totals.collect()} == {"Positive": 2, "Negative": 3}
    empty = counts.class_totals(df.where("false"), "words", {"x"}, {"y"})
    assert {r.label: r["count"] for r in empty.collect()} == {"Positive": 0, "Negative": 0}
