from __future__ import annotations

import pytest

from postlens.plans import tables
from postlens.sources import streams
from postlens.streaming import sinks

NASTY = ['line\nbreak | pipe, comma "quote"', "plain", "", "ends \\", "\r\n"]


@pytest.fixture
def rows(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(NASTY)], "id INT, text STRING")


def test_json_batches_replace_themselves(spark, rows, tmp_path):
    out = str(tmp_path)
    sinks.write_json(rows, out, 1, "tweet")
    sinks.write_json(rows, out, 2, "tweet")
    sinks.write_json(rows.where("id < 2"), out, 1, "tweet")
    back = streams.read_json(spark, out, "id INT, text STRING, source_name STRING, batch_id INT")
    assert back.count() == 2 + len(NASTY)
    assert {r.text for r in back.where("batch_id = 2").collect()} == set(NASTY)


def test_pipe_text_round_trip(spark, rows, tmp_path):
    sinks.write_pipe(rows, str(tmp_path), 1)
    back = streams.read_delimited(spark, str(tmp_path), "id INT, text STRING, batch_id INT", sep="|").collect()
    assert {r.id: r.text or "" for r in back} == dict(enumerate(NASTY))
    lines = [r.line for r in tables.pipe_row(rows, ["id", "text"]).collect()]
    assert lines[:3] == ['0|"line\nbreak | pipe, comma ""quote"""', "1|plain", "2|"]


def test_post_csv_replaces_a_replayed_batch(spark, rows, tmp_path):
    posts = rows.selectExpr("id", "'n' AS n", "'u' AS u", "text", "'' AS s")
    for batch in (1, 1, 2):
        sinks.write_post_csv(posts, str(tmp_path), posts.columns, batch, rows_per_file=2)
    files = list(tmp_path.glob("*/*.csv"))
    assert all(f.read_text().startswith("Post ID,Screen Name,ID,sentence,Sentiment") for f in files)
    back = streams.read_delimited(spark, str(tmp_path), "id INT, n STRING, u STRING, text STRING, s STRING, batch_id INT", header=True)
    assert back.count() == 2 * len(NASTY) and len(files) >= 6
    assert {r.text or "" for r in back.collect()} == set(NASTY)


def test_database_rows_are_dealt_after_the_work(spark, rows):
    ready = sinks.for_database(rows.repartition(7), 4, 3)
    assert ready.rdd.getNumPartitions() == 3 and {r.batch_id for r in ready.collect()} == {4}
    deleted = []
    write = sinks.jdbc_sink("jdbc:none:x", "t", {}, deleted.append)
    with pytest.raises(Exception, match="(?i)driver"):
        write(rows, 9)
    assert deleted == [9]


def test_tables(spark, rows, tmp_path):
    spark.sql("DROP TABLE IF EXISTS posts_t")
    for batch in (1, 2, 2):
        sinks.append_table(rows, "posts_t", batch, path=str(tmp_path / "t"))
    assert spark.table("posts_t").count() == 2 * len(NASTY)
    spark.sql("DROP TABLE IF EXISTS external_t")
    for _ in range(2):
        sinks.overwrite_table(rows, "external_t", str(tmp_path / "e"))
    assert spark.table("external_t").count() == len(NASTY)
    assert spark.read.parquet(str(tmp_path / "e")).count() == len(NASTY)


def test_topic_value(spark, rows):
    row = tables.topic_value(rows.where("id = 1"), "id").first()
    assert (row.key, row.value) == ("1", '{"id":1,"text":"plain"}')


def test_a_folder_has_few_files_and_a_hot_one_is_dealt(spark, tmp_path, monkeypatch):
    """One row for each of many folders in every task, and one folder with nearly all bytes."""
    rows = spark.range(4000).repartition(16).selectExpr("id", "CASE WHEN id % 10 = 0 THEN id % 70 / 10 ELSE 99 END AS day", "repeat(md5(string(id)), 40) AS text")
    monkeypatch.setattr(sinks, "TASK_BYTES", 24 << 10)
    setting = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    sinks.write_json(rows, str(tmp_path), 1, "tweet", ["day", "batch_id"])
    assert spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes") == setting
    sizes = {}
    for f in tmp_path.glob("source_name=tweet/day=*/batch_id=1/*.json"):
        sizes.setdefault(f.parent.parent.name, []).append(f.stat().st_size)
    assert len(sizes) == 8 and spark.read.json(str(tmp_path)).count() == 4000
    assert max(len(v) for k, v in sizes.items() if k != "day=99.0") <= 2 and len(sizes["day=99.0"]) >= 3
    assert max(map(max, sizes.values())) < sum(sizes["day=99.0"]) / 2


def test_compaction_bounds_files_by_bytes(spark, tmp_path):
    schema = "id BIGINT, text STRING, lang STRING, batch_id INT"
    rows = spark.range(900).selectExpr("id", "repeat('x', int(id % 50) * 10) AS text", "CASE WHEN id % 3 = 0 THEN 'a' WHEN id % 3 = 1 THEN 'b' END AS lang")
    for batch in range(6):
        sinks.write_json(rows.where(f"id div 150 = {batch}").repartition(3), str(tmp_path / "in"), batch, "s", ["lang", "batch_id"])
    before = list((tmp_path / "in").glob("*/*/*/*.json"))
    for _ in range(2):
        sinks.compact(spark, str(tmp_path / "in"), str(tmp_path / "out"), schema, ["lang"], target_bytes=30_000)
        after = [f.stat().st_size for f in (tmp_path / "out").glob("*/*.json")]
        assert max(after) < 60_000 and len(after) < len(before)
        back = streams.read_json(spark, str(tmp_path / "out"), schema).collect()
        assert sorted((r.id, len(r.text), r.batch_id) for r in back) == [(i, i % 50 * 10, i // 150) for i in range(900)]
        assert {r.lang for r in back} == {"a", "b", None}
    assert list((tmp_path / "in").glob("*/*/*/*.json")) == before
