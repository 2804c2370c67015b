"""Keyword tables: the same as a predicate for each keyword."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from postlens.operators import keywords


def test_agrees_with_plain_search(spark):
    make = random.Random(9)
    word = lambda: "".join(make.choice("abcé") for _ in range(make.randint(1, 6)))
    texts = [" ".join(word() for _ in range(make.randint(0, 12))) for _ in range(120)] + [None, "", "  a  b ", "Ab\nCa ab", "x" * 50_000 + " ab ca"]
    asked = [word() for _ in range(40)] + [f"{word()} {word()}" for _ in range(40)] + ["AB", "ab", None, "", " ", "b c", " a", "a  b", "\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    table = spark.createDataFrame([(k,) for k in asked], "keyword string")
    lowered = {k.lower() for k in asked if k and k.strip(" ")}
    wanted = {(i, k) for i, t in enumerate(texts) if t for k in lowered if k in t.lower()}
    rows = [tuple(r) for r in keywords.mentions(docs, ["id"], table).collect()]
    assert len(rows) == len(set(rows)) and set(rows) == wanted
    assert keywords.mentions(docs, ["id"], table.limit(0)).count() == keywords.mentions(docs.limit(0), ["id"], table).count() == 0


def test_many_keywords_make_a_small_plan(spark):
    table = spark.range(100_000).select(F.md5(F.col("id").cast("string")).alias("keyword"))
    docs = spark.createDataFrame([(1, "before " + __import__("hashlib").md5(b"77").hexdigest() + "tail")], "id int, text string")
    found = keywords.mentions(docs, ["id"], table)
    assert len(found._jdf.queryExecution().optimizedPlan().toString()) < 20_000
    assert found.count() == 1
