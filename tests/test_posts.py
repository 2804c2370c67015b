from __future__ import annotations

import json
import random

import pytest

from pyspark.sql import functions as F

from postlens.sources import archives, dictionaries, posts, schemas


def _values(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "n INT, value STRING")


TWEET = {
    "raw": {
        "text": "halo dunia", "id": 985731867316215808, "id_str": "985731867316215808", "retweet_count": 3,
        "entities": {"urls": ["a", "b"], "hashtags": [{"text": "x"}], "symbols": []},
        "user": {"screen_name": "Ayu", "id_str": "7"},
    }
}


def test_tweets_decoded_once_or_twice_and_broken_ones_dropped(spark):
    once = json.dumps(TWEET)
    feed = _values(spark, once, json.dumps(once), once[:-3], "", None, "[1]", "5", "null")
    kept = posts.drop_malformed(feed, schemas.TWEET)
    rows = posts.flatten_tweet(kept, ["n"]).orderBy("n").collect()
    assert [r.n for r in rows] == [0, 1]
    for row in rows:
        assert row.id == 985731867316215808
        assert (row.urls, row.hashtags, row.symbols) == ("a,b", None, "")
        assert (row.user_screen_name, row.user_id, row.created_at) == ("Ayu", "7", None)


def test_one_odd_field_does_not_spoil_the_record(spark):
    odd = json.dumps({"raw": {"text": "x", "retweet_count": "many", "id_str": "1"}})
    row = posts.flatten_tweet(posts.drop_malformed(_values(spark, odd), schemas.TWEET)).first()
    assert (row.text, row.retweet_count, row.id_str) == ("x", None, "1")


def test_route_names_the_reason(spark):
    good = {"message": "m", "comments": {"count": 2}, "from": {"name": "n", "id": "1"}}
    no_from = {"message": "m", "comments": {"count": 2}}
    feed = _values(spark, json.dumps(good), json.dumps(no_from), "{", json.dumps({"comments": {}}))
    ok, bad = posts.route(feed, schemas.FACEBOOK, posts.REQUIRED["facebook"])
    assert [r.n for r in ok.collect()] == [0]
    assert {r.n: r.reason for r in bad.collect()} == {1: "missing from", 2: "malformed", 3: "missing message"}


def test_lists_with_other_elements_become_null(spark):
    from postlens.functions.jsons import list_text

    raws = ['["a","b"]', "[]", '["a",1]', '[{"x":1}]', '["a",null]', None, '["q\\"é"]']
    df = _values(spark, *raws).withColumn("j", list_text(F.col("value"), " ")).orderBy("n")
    assert [r.j for r in df.collect()] == ["a b", "", None, None, None, None, 'q"é']


def test_typed_tweet(spark):
    flat = _values(spark, json.dumps({"created_at": "Mon Apr 16 03:36:07 +0000 2018", "id": 1, "truncated": True}))
    row = posts.typed_tweets(posts.flatten_flat_tweet(posts.drop_malformed(flat, schemas.FLAT_TWEET))).first()
    assert (str(row.created_at), row.id, row.truncated) == ("2018-04-16 03:36:07", "1", True)


def test_project_strings_and_compact(spark):
    feed = _values(spark, json.dumps({"id": "1", "name": "n", "text": "t", "more": [1]}), "x")
    assert posts.project_strings(feed, ["id", "text"]).collect() == [("1", "t")]
    status = json.dumps({"id": 5, "text": "é!", "user": {"id_str": "9", "name": "Ayu"}})
    compact = posts.compact_post(posts.drop_malformed(_values(spark, status), schemas.STATUS))
    assert compact.first().asDict() == {"id": "9", "name": "Ayu", "text": "?!"}


def test_news_falls_back_to_the_file(spark):
    feed = _values(spark, json.dumps({"file_content": "f", "result_content": "r"}), json.dumps({"file_content": "f"}))
    flat = posts.flatten_news(posts.drop_malformed(feed, schemas.NEWS), ["n"]).orderBy("n").collect()
    assert [r.news_text for r in flat] == ["r", "f"]


def test_archive_of_objects_without_separators(spark, tmp_path):
    objects = [{"id": i, "text": 'a }{ b "}{" c', "user": {"id_str": str(i), "name": "n"}} for i in range(50)]
    (tmp_path / "archive.txt").write_text("".join(json.dumps(o) for o in objects))
    values = archives.archive_statuses(spark, str(tmp_path))
    ids = [r.id for r in posts.drop_malformed(values, schemas.STATUS).select("post.id", "post.text").collect()]
    assert sorted(ids) == list(range(50))


@pytest.mark.parametrize("gap", ["", " ", "\n", "\r\n  "])
@pytest.mark.parametrize("split", [None, 64])
def test_archives_with_boundaries_in_texts(spark, tmp_path, gap, split):
    texts = ["x}{", "y", 'q "}{" r', "}{", "a\\", "z}{\"k\": 1}", "", "{}", "line\nbreak }{"]
    objects = [{"id": i, "text": t, "user": {"id_str": "1", "n": {"m": {}}}, "e": {}} for i, t in enumerate(texts * 3)]
    archive = gap.join(json.dumps(o) for o in objects)
    (tmp_path / "archive.txt").write_text(archive)
    if split:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        scanned = [json.loads(r.value) for r in archives.archive_statuses(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted(scanned, key=lambda o: o["id"]) == objects
    rows = spark.createDataFrame([(archive,), ("",), (None,)], "value STRING")
    parts = archives.split_archives(rows, "value").orderBy("pos").collect()
    assert [json.loads(r.value) for r in parts] == objects


@pytest.mark.parametrize("split", [150, 1 << 20])
def test_archives_cut_anywhere(spark, tmp_path, split):
    """Lists of texts that look like boundaries, keys too, over splits that end anywhere."""
    make = random.Random(split)
    texts = ["}{", 'x}{', 'a"}{', "\\}{", "}{}{", "z", "", '"}{"}{']
    for n in range(2):
        objects = [{"id": 100 * n + i, "}{": [make.choice(texts) for _ in range(make.randint(0, 9))], make.choice(texts): 1} for i in range(15)]
        (tmp_path / f"a{n}.txt").write_text("".join(json.dumps(o) for o in objects))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = [r.value for r in archives.archive_statuses(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    wanted = sorted("".join(p.read_text() for p in sorted(tmp_path.glob("a*.txt"))).replace('}{"id"', '}\x1e{"id"').split("\x1e"))
    assert sorted(found) == wanted


@pytest.mark.parametrize("split", [50, 1 << 20])
def test_what_never_parses_stays(spark, tmp_path, split):
    whole = ['{"id": 1, "t": "x}{"}', '{"id": 2}', '{"id": 3, "t": "}{"}']
    (tmp_path / "cut.txt").write_text(whole[0] + '{"id": 9, "t": "never closed' + whole[1] * 2 + whole[2] + '{"id": 8')
    (tmp_path / "only.txt").write_text('x}{"' * 12 + "x")
    (tmp_path / "empty.txt").write_text("")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        found = [r.value for r in archives.archive_statuses(spark, str(tmp_path)).collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # The object without end takes the next one with it; what parses alone starts afresh.
    assert whole[0] in found and whole[1] in found and whole[2] in found and '{"id": 8}' in found
    assert sum(v.count("x") for v in found if "id" not in v) == 13


def test_dictionary_files(spark, tmp_path):
    (tmp_path / "slang.txt").write_text("gpp tidak apa-apa\negp emang saya\n\ngpp  tidak   masalah\nkosong\n")
    slang = dictionaries.slang_table(dictionaries.read_lines(spark, str(tmp_path / "slang.txt")))
    assert {r.key: r.value for r in slang.collect()} == {
        "gpp": "tidak masalah", "egp": "emang saya", "kosong": "",
    }
    (tmp_path / "b_person.txt").write_text("Joko\n joko \n\nAnies\n")
    (tmp_path / "i_person.txt").write_text("Widodo\n")
    sets = dictionaries.entity_sets(
        dictionaries.entity_dictionary(dictionaries.read_lines(spark, [str(tmp_path / "*_person.txt")])).collect()
    )
    assert sets == {"person": ({"joko", "anies"}, {"widodo"})}
    (tmp_path / "places.txt").write_text("Bandung\t0654'S\t10737'E\nbroken\nbandung\t1'S\t2'E\n")
    places = dictionaries.gazetteer(dictionaries.read_lines(spark, str(tmp_path / "places.txt")))
    assert places.collect() == [("bandung", "1'S", "2'E")]


def test_literal_dictionaries_are_size_checked(spark):
    table = spark.range(30).select(F.col("id").cast("string").alias("word"))
    assert dictionaries.bounded_rows(table, 29) is None
    assert len(dictionaries.bounded_rows(table, 30)) == 30
