"""The whole enrichment with dictionaries read from files."""

from __future__ import annotations

import pytest

from postlens.plans import tables
from postlens.plans.enrich import enrich, load_dictionaries
from postlens.plans.joined import DictionaryTables
from postlens.sources import posts, schemas


@pytest.fixture
def loaded(spark, tmp_path):
    files = {
        "pos.txt": "bagus\nsenang\nhebat\n",
        "neg.txt": "buruk\nsedih\nbohong\n",
        "slang.txt": "bgs bagus sekali\ngk tidak\nbgs bagus\n",
        "events.txt": "bunuh\ncuri\n",
        "roots.txt": "senang\nbohong\nmenteri\njadi\nkunjung\n",
        "places.txt": "Bandung\t0654'S\t10737'E\njakarta pusat\t0610'S\t10650'E\n",
        "entities/b_person.txt": "Joko\nAnies\n",
        "entities/i_person.txt": "Widodo\n",
        "entities/b_company.txt": "PT\n",
        "entities/i_company.txt": "maju\n",
        "entities/b_country.txt": "indonesia\n",
        "entities/i_country.txt": "raya\n",
        "entities/b_location.txt": "bandung\njakarta\nsorong\n",
        "entities/i_location.txt": "pusat\n",
    }
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(exist_ok=True)
        path.write_text(content)
    at = lambda name: str(tmp_path / name)
    return lambda limit=20_000: load_dictionaries(
        spark, at("pos.txt"), at("neg.txt"), at("slang.txt"), at("roots.txt"), at("entities"), at("places.txt"),
        at("events.txt"), limit,
    )


@pytest.fixture
def dicts(loaded):
    return loaded()


@pytest.mark.parametrize("limit", [20_000, 0])
def test_enrich(spark, loaded, limit):
    dicts = loaded(limit)
    assert isinstance(dicts, DictionaryTables) == (limit == 0)
    rows = [
        (1, "Joko Widodo mengunjungi PT Maju di Jakarta Pusat, Sorong dan Bandung. BGS!"),
        (2, "Pembunuhan di Indonesia Raya: kebohongan Anies, menyedihkan & BURUK<br />buruk"),
        (3, ""),
        (4, None),
        (5, "@@@ !!! 123"),
    ]
    df = spark.createDataFrame(rows, "id INT, text STRING")
    done = {r.id: r for r in enrich(df, dicts, id_cols=["id"]).collect()}
    assert done[1].asDict() == {
        "id": 1, "text": rows[0][1], "sentiment": "positif", "total_score": 1.0, "person": "joko widodo",
        "company": "pt maju", "eventNegatif": "", "country": "", "city": "jakarta pusat,bandung",
        "lat_city": "0610'S,0654'S", "long_city": "10650'E,10737'E",
    }
    assert (done[2].sentiment, done[2].total_score) == ("negatif", -1.0)
    assert (done[2].person, done[2].country, done[2].eventNegatif) == ("anies", "indonesia raya", "pembunuhan")
    for empty in (3, 5):
        assert (done[empty].sentiment, done[empty].total_score, done[empty].person) == ("netral", 0.0, "")
    assert (done[4].sentiment, done[4].total_score, done[4].person) == ("netral", 0.0, None)


def test_time_of_joined_enrichment_does_not_grow_with_the_square_of_a_text(spark, loaded):
    import time

    words = "concat_ws(' ', transform(sequence(1, 30000), i -> concat('w', i, 'x')))"
    df = spark.range(1).selectExpr("id", f"concat({words}, ' BGS Anies') AS text")
    began = time.perf_counter()
    row = enrich(df, loaded(0), id_cols=["id"]).drop("text").first()
    assert (row.sentiment, row.person) == ("positif", "anies")
    assert time.perf_counter() - began < 60


def test_enrichment_needs_no_shuffle(spark, dicts):
    plan = enrich(spark.range(1).selectExpr("'a' AS text"), dicts)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_table_rows_keep_the_table_layout(spark, dicts):
    value = '{"message": "Anies di bandung", "comments": {"count": 2}, "from": {"name": "n", "id": "1"}, "id": "9"}'
    feed = spark.createDataFrame([(value,)], "value STRING")
    good, _ = posts.route(feed, schemas.FACEBOOK, posts.REQUIRED["facebook"])
    flat = tables.flatten_for_table(good, "facebook").selectExpr("*", "0.75D AS p", "0.25D AS n")
    row = tables.table_rows(flat, "facebook", dicts, "p", "n").first()
    assert len(row) == 20
    assert (row.ID, row.COMMENTS_COUNT, row.FROM_NAME, row.LIKES_COUNT) == ("9", 2, "n", None)
    assert (row.POSITIVE_SCORES, row.SENTIMENT, row.ENTITAS_CITY, row.ENTITAS_PERSON) == ("0.750000", "Positive", "bandung", "anies")


@pytest.mark.parametrize(
    ("source", "width"), [("facebook", 20), ("gplus", 19), ("instagram", 26), ("news", 17), ("tweet", 24)]
)
def test_table_widths(source, width):
    assert len(tables.SOURCE_COLUMNS[source]) + 8 == width
