"""Language identification: held-out accuracy, plain Python beside it, and edge cases."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.llm import langid
from postlens.llm.queries import QUERIES

SPOKEN = {"a1": ["lum", "ora", "tene", "sil"], "b2": ["krz", "sto", "wie", "dno"], "ü3": ["ñandu", "peço", "ilha", "mão"]}


def text(make, language, n):
    return " ".join("".join(make.choice(SPOKEN[language]) for _ in range(make.randint(1, 3))) for _ in range(n))


@pytest.fixture(scope="module")
def corpus(spark):
    make = random.Random(4)
    rows = [(i, text(make, lang, make.randint(1, 60)), lang, 0, "s") for i in range(400) for lang in [make.choice(sorted(SPOKEN))]]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int, _text string")


def test_held_out_documents(spark, sf_dir):
    got = {r.doc_id: r for r in QUERIES["op12_language_id"](spark, sf_dir).collect()}
    table = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(table)
    right = [got[r.doc_id].lang_pred == r.lang for r in table if got[r.doc_id].held_out]
    assert np.mean(right) >= 0.97 and right
    for r in table:
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= got[r.doc_id].score <= 1


def plain_grams(raw):
    kept = "".join(c if c.isalpha() else " " for c in f" {raw} ".lower())
    kept = " " + " ".join(kept.split()) + " " if kept.strip() else " "
    return [(n, kept[i : i + n]) for n in langid.ORDERS for i in range(len(kept) - n + 1) if kept[i : i + n] != " "]


def test_agrees_with_plain_sets(corpus, monkeypatch):
    """With filters too large to err, the counts are those of plain sets of n-grams; slices change nothing."""
    monkeypatch.setattr(langid, "BITS_PER_GRAM", 1024)
    rows = corpus.collect()
    filters = langid.fitted(corpus.select(F.col("lang").alias("language"), "text"))
    assert filters.names == tuple(sorted(SPOKEN))
    counts = {name: Counter() for name in filters.names}
    for r in {(r.text, r.lang): r for r in rows}.values():
        counts[r.lang].update(plain_grams(r.text))
    totals = {(name, n): sum(v for (k, _), v in c.items() if k == n) for name, c in counts.items() for n in langid.ORDERS}
    share = lambda name, gram: counts[name][gram] / totals[name, gram[0]]
    holds = lambda name, gram: share(name, gram) >= langid.LEAST and share(name, gram) >= langid.PART * max(share(o, gram) for o in counts)
    some = [r.text for r in rows[:60]]
    expected = [[sum(holds(name, g) for g in plain_grams(t)) for name in filters.names] for t in some]
    hits, n = filters.counted([f" {t} " for t in some])
    assert n.tolist() == [len(plain_grams(t)) for t in some]
    assert np.abs(hits - np.array(expected)).max() <= 1
    monkeypatch.setattr(langid, "SLICE", 7)
    again, m = filters.counted([f" {t} " for t in some])
    assert (again == hits).all() and (m == n).all()


def test_many_languages_have_wider_masks(spark):
    make = random.Random(2)
    spoken = ["".join(make.choice("abcdefghijklmnopqrst") for _ in range(60)) for _ in range(70)]
    rows = spark.createDataFrame([(f"l{i:02d}", t) for i, t in enumerate(spoken) for _ in range(2)], "language string, text string")
    filters = langid.fitted(rows)
    assert len(filters.names) == 64 and filters.masks.dtype == np.uint64
    best, score = filters.decide([f" {spoken[int(name[1:])]} " for name in filters.names])
    assert best.tolist() == list(range(64)) and (score > 0).all()


def test_false_positives_are_taken_off():
    make = np.random.default_rng(6)
    masks = np.zeros(1 << 12, np.uint8)
    masks[make.random(1 << 12) < 0.7] |= 1
    masks[make.random(1 << 12) < 0.2] |= 2
    filters = langid.LanguageFilters(("a", "b"), masks)
    points = "".join(chr(int(c)) for c in make.integers(0x4E00, 0x9F00, 6000))
    hits, n = filters.counted([points])
    corrected = hits[0] - n[0] * filters.chance
    assert hits[0][0] > 0.2 * n[0] and np.abs(corrected).max() < 0.03 * n[0]


def test_edges(spark, corpus):
    long = "krz sto " * 300_000
    odd = spark.createDataFrame(
        [(None, "lum ora", None), (1, None, "a1"), (2, "", "a1"), (3, " 12 .\t!", "a1"), (4, "漢字仮名", None), (5, long, None), (5, long, None), (6, "\U0001d552 wiesto", None)],
        "doc_id long, text string, lang string",
    )
    rows = langid.identified(corpus.select("doc_id", "text", "lang").unionByName(odd).withColumn("held_out", F.lit("x")).withColumn("score", F.lit(1))).collect()
    assert len(rows) == 408
    tail = langid.predicted(odd, langid.fitted(corpus.select(F.col("lang").alias("language"), "text")), "doc_id", "text").collect()
    got = {r.doc_id: (r.lang_pred, r.score) for r in tail}
    assert got[1] == got[2] == got[3] == ("und", 0.0)
    assert got[4] == ("a1", 0.0) and got[None][0] == "a1" and got[5][0] == "b2" and got[6][0] == "b2"
    assert langid.identified(odd.limit(0)).collect() == []
    alone = langid.identified(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in alone} == {("und", 0.0)}


def test_prediction_looks_at_text_alone(spark, corpus):
    filters = langid.fitted(corpus.select(F.col("lang").alias("language"), "text"))
    moved = corpus.withColumn("doc_id", F.col("doc_id") + 7).withColumn("lang", F.lit("zz"))
    read = lambda df: {r.text: (r.lang_pred, r.score) for r in langid.predicted(df, filters, "text").collect()}
    assert read(corpus) == read(moved)
