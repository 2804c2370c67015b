"""Inferred schemas: merged types, odd names, records that are none."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from postlens.sources import inference

ODD = [
    (1, '{"a":1,"b":{"c":"x","we ird`k":2.5},"t":["p","q"],"n":null,"z":1}'),
    (2, '{"a":2.5,"b":{"c":3},"t":[{"text":"z"}],"OBJECT<q\'\\"":true,"e":1e3,"z":2.25}'),
    (3, '"{\\"a\\":\\"s\\",\\"b\\":null}"'), (4, "[1,2]"), (5, "nope"), (6, None), (7, ""), (8, "{}"), (9, '"text"'),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "id int, value string")


def test_types_are_merged(odd):
    kind = inference.inferred_schema(odd)
    assert kind.simpleString() == (
        "struct<OBJECT<q'\":boolean,a:string,b:struct<c:string,we ird`k:decimal(2,1)>,e:double,n:string,t:array<string>,z:decimal(22,2)>"
    )


def test_profile(odd):
    rows = {r.path: (r.type, r.present, r.null_share) for r in inference.profile(odd).collect()}
    assert rows["$"] == ("struct", 4, 1 - 4 / 9)
    assert rows["b"][1] == rows["b.c"][1] == 2 and rows["b.we ird`k"][1] == 1 and rows["n"] == ("string", 0, 1.0)
    assert rows["a"] == ("string", 3, 0.25) and len(rows) == 10


def test_rows_keep_what_was_written(odd):
    rows = {r.id: r.post for r in inference.read_inferred(odd, keep=["id"]).collect()}
    assert [i for i in rows if rows[i] is None] == [4, 5, 6, 7, 9]
    assert (rows[1].a, rows[2].a, rows[3].a) == ("1", "2.5", "s") and rows[3].b is None and rows[1].b["we ird`k"] is not None
    assert rows[1].t == ["p", "q"] and rows[2].t == ['{"text":"z"}'] and rows[2].e == 1000.0 and rows[8].a is None


def test_a_given_schema_is_kept(odd):
    given = T.StructType([T.StructField("a", T.StringType()), T.StructField("later", T.LongType())])
    rows = {r.id: r.post for r in inference.read_inferred(odd, keep=["id"], schema=given).collect()}
    assert (rows[1].a, rows[1].later, rows[4]) == ("1", None, None)


def test_feeds_without_fields(spark, odd):
    for feed in (odd.limit(0), odd.where("id IN (4, 5, 6)"), odd.where("id = 8")):
        assert inference.inferred_schema(feed).fields == []
        rows = inference.profile(feed).collect()
        assert [r.path for r in rows] == ["$"] and rows[0].present == feed.where("id = 8").count()
        assert inference.read_inferred(feed, keep=["id"]).count() == feed.count()
    assert inference.profile(odd.limit(0)).first().null_share is None
