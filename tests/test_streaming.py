from __future__ import annotations

import time

import json

import pytest
from pyspark.sql import functions as F

from postlens.functions import text
from postlens.plans.samples import DICTIONARIES
from postlens.sources import schemas, streams
from postlens.streaming import jobs, sinks

POST = "id STRING, name STRING, text STRING, at TIMESTAMP"


def land(folder, name, posts):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(p) for p in posts) + "\n")


@pytest.fixture
def feed(tmp_path):
    land(tmp_path / "in", "a.json", [{"id": "1", "text": "the best of"}, {"id": "2", "text": "of of  x"}])
    return tmp_path


def test_running_counts_keep_state_and_never_reprocess(spark, feed):
    words = streams.landed_stream(spark, str(feed / "in"), POST).select(text.split_on_space(F.col("text")).alias("w"))
    totals = jobs.running_class_counts(words, "w", {"the", "best"}, {"of"})
    seen = []

    def write(batch, batch_id):
        seen.append({r.label: r["count"] for r in batch.collect()})

    def run():
        jobs.start(totals, write, str(feed / "cp"), mode="complete").awaitTermination()

    run()
    assert seen[-1] == {"Positive": 2, "Negative": 3}
    batches = len(seen)
    run()
    assert len(seen) == batches
    land(feed / "in", "b.json", [{"id": "3", "text": "the of"}])
    run()
    assert seen[-1] == {"Positive": 3, "Negative": 4}


def test_enrichment_job_writes_good_and_bad_once(spark, tmp_path):
    good = {"raw": {"text": "The der of", "id": 1}}
    land(tmp_path / "in", "a.json", [{"value": json.dumps(good)}, {"value": "{broken"}, {"value": json.dumps(json.dumps(good))}])
    stream = streams.landed_stream(spark, str(tmp_path / "in"), "value STRING")
    write = jobs.enrichment_writer("tweet", DICTIONARIES, str(tmp_path / "out"))
    jobs.start(stream, write, str(tmp_path / "cp")).awaitTermination()
    schema = "id BIGINT, sentiment STRING, reason STRING, rejected STRING, status STRING"
    out = streams.read_json(spark, str(tmp_path / "out"), schema)
    rows = sorted(map(tuple, out.select("id", "sentiment", "reason", "rejected", "status").collect()), key=str)
    # "the" is slang for two neutral words here, so one word on each side remains.
    expected = (1, "netral", None, None, "good")
    assert rows == sorted([expected, expected, (None, None, "malformed", "{broken", "quarantined")], key=str)
    write(spark.createDataFrame([(json.dumps(good),), ("{broken",)], "value STRING"), 0)
    assert streams.read_json(spark, str(tmp_path / "out"), schema).count() == 2


def test_output_is_filed_under_the_day_a_message_arrived(spark, tmp_path):
    value = json.dumps({"id": "1", "name": "n", "text": "x"})
    rows = [(value, "2018-04-13 23:59:59"), (value, "2018-04-14 00:00:01"), ("{", "2018-04-14 00:00:02")]
    batch = spark.createDataFrame(rows, "value STRING, at STRING").selectExpr("value", "to_timestamp(at) AS timestamp")
    write = jobs.enrichment_writer("compact", DICTIONARIES, str(tmp_path))
    write(batch, 4)
    write(batch, 4)
    folders = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("*/*/*/*") if p.is_dir()}
    day = "source_name=compact/ingest_date=2018-04-{}/batch_id=4/status={}"
    assert folders == {day.format(13, "good"), day.format(14, "good"), day.format(14, "quarantined")}
    assert spark.read.json(str(tmp_path)).count() == 3


@pytest.mark.parametrize(("most", "folders"), [(3, {"2018-04-13", "2018-04-14", "2018-05-01"}), (2, {"2018-04", "2018-05"}), (1, {"2018"})])
def test_a_batch_of_many_days_is_filed_by_month_or_year(spark, tmp_path, monkeypatch, most, folders):
    monkeypatch.setattr(jobs, "DATE_FOLDERS", most)
    value = json.dumps({"id": "1", "name": "n", "text": "x"})
    rows = [(value, "2018-04-13"), (value, "2018-04-14"), ("{", "2018-05-01"), (value, None)]
    batch = spark.createDataFrame(rows, "value STRING, at STRING").selectExpr("value", "to_timestamp(at) AS timestamp")
    write = jobs.enrichment_writer("compact", DICTIONARIES, str(tmp_path))
    write(batch, 4)
    write(batch, 4)
    assert {p.name for p in tmp_path.glob("source_name=compact/*")} == {f"ingest_date={f}" for f in (*folders, "__HIVE_DEFAULT_PARTITION__")}
    back = streams.read_json(spark, str(tmp_path), "arrival_date STRING, status STRING")
    assert sorted((r.arrival_date or "", r.status) for r in back.collect()) == [
        ("", "good"), ("2018-04-13", "good"), ("2018-04-14", "good"), ("2018-05-01", "quarantined"),
    ]


def test_landed_files_grow_in_number_not_in_size(spark, tmp_path, monkeypatch):
    """A file is written by one task: rows of many splits must land in as many files, still in four micro-batches."""
    from pyspark.sql import DataFrame

    from postlens.plans import catalog

    monkeypatch.setattr(catalog, "shared_dir", lambda *_: str(tmp_path / "landed"))
    rows = spark.range(0, 200_000, 1, 100)
    stream = catalog._landed(rows, "rows", "id")
    assert len(list((tmp_path / "landed").glob("*.parquet"))) == 100
    seen = []

    def write(batch: DataFrame, batch_id: int) -> None:
        seen.append(batch.count())

    jobs.start(stream, write, str(tmp_path / "cp")).awaitTermination()
    assert len(seen) == 4 and sum(seen) == 200_000


def test_row_local_enrichment_runs_on_the_stream_itself(spark, tmp_path):
    land(tmp_path / "in", "a.json", [{"value": json.dumps({"id": "1", "name": "n", "text": "in the"})}])
    stream = streams.decoded(streams.landed_stream(spark, str(tmp_path / "in"), "value STRING"))
    query = (
        jobs.enriched_posts(stream, "compact", DICTIONARIES)
        .writeStream.format("memory").queryName("enriched").trigger(availableNow=True)
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.awaitTermination()
    row = spark.table("enriched").first()
    assert (row.city, row.lat_city, row.long_city) == ("in the", "0609'S", "10649'E")


def test_raw_archive_and_history_and_counts(spark, feed):
    stream = streams.landed_stream(spark, str(feed / "in"), "id STRING, text STRING")
    raw = stream.select(F.to_json(F.struct("*")).alias("value"))
    jobs.raw_archive(raw, str(feed / "raw"), str(feed / "cp1")).awaitTermination()
    assert spark.read.schema("value STRING").json(str(feed / "raw")).count() == 2
    words = stream.select(text.split_on_space(F.col("text")).alias("w"))
    write = jobs.history_writer("w", {"the"}, {"of"}, str(feed / "hist"))
    jobs.start(words, write, str(feed / "cp2")).awaitTermination()
    history = spark.read.parquet(str(feed / "hist"))
    assert {(r.label, r["count"], r.records, r.batch_id) for r in history.collect()} == {("Positive", 1, 2, 0), ("Negative", 3, 2, 0)}
    reported = []
    jobs.start(stream, jobs.count_writer(lambda b, n: reported.append((b, n))), str(feed / "cp3")).awaitTermination()
    assert reported == [(0, 2)]


def test_first_seen_and_latest(spark, tmp_path):
    posts = [{"id": "1", "text": "a", "at": "2018-04-13T00:00:01Z"}, {"id": "1", "text": "b", "at": "2018-04-13T00:00:02Z"}]
    land(tmp_path / "in", "a.json", posts)
    stream = streams.landed_stream(spark, str(tmp_path / "in"), POST)
    write = lambda batch, batch_id: sinks.write_parquet(batch, str(tmp_path / "first"), batch_id)
    jobs.start(jobs.first_seen(stream, "id", "at"), write, str(tmp_path / "cp-first")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "first")).count() == 1
    out = str(tmp_path / "latest")
    jobs.start(stream, jobs.latest_writer("id", ["at"], out), str(tmp_path / "cp-l")).awaitTermination()
    assert [r.text for r in spark.read.parquet(out).collect()] == ["b"]
    land(tmp_path / "in", "b.json", [{"id": "1", "text": "c", "at": "2018-04-14T00:00:00Z"}, {"id": "2", "text": "d", "at": "2018-04-14T00:00:00Z"}])
    jobs.start(stream, jobs.latest_writer("id", ["at"], out), str(tmp_path / "cp-l")).awaitTermination()
    assert {(r.id, r.text) for r in jobs.latest_posts(spark, out, "id", ["at"]).collect()} == {("1", "c"), ("2", "d")}


def test_console(spark, feed):
    words = streams.landed_stream(spark, str(feed / "in"), POST).select(text.split_on_space(F.col("text")).alias("w"))
    query = jobs.to_console(jobs.running_class_counts(words, "w", {"the"}, {"of"}), str(feed / "cp"))
    query.awaitTermination()
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 2


def test_topic_job_asks_for_the_connector(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)kafka"):
        jobs.topic_job(spark, "none:1", "weblogs", DICTIONARIES, str(tmp_path / "o"), str(tmp_path / "c"))


def test_bounded_run_stops(spark, feed):
    stream = streams.landed_stream(spark, str(feed / "in"), POST)
    query = jobs.start(stream, lambda batch, batch_id: None, str(feed / "cp"), interval="1 second")
    assert jobs.run_bounded(query, 3) is False
    assert not query.isActive


def test_message_schema_matches_the_topic():
    assert schemas.TOPIC_MESSAGE.fieldNames() == ["key", "value", "topic", "partition", "offset", "timestamp"]


def test_counts_come_with_the_batch(spark, tmp_path):
    """Records and sums of each batch, without a second job on it."""
    reported, out = [], str(tmp_path / "out")
    listener = jobs.BatchCounts("posts", lambda batch, sums: reported.append((batch, sums)))
    spark.streams.addListener(listener)
    try:
        for n, name in ((2, "a.json"), (3, "b.json")):
            land(tmp_path / "in", name, [{"id": str(i), "text": "x" * i, "at": "2018-04-13T00:00:01Z"} for i in range(n)])
            stream = streams.landed_stream(spark, str(tmp_path / "in"), POST)
            seen = jobs.observed(stream, "posts", F.sum(F.length("text")).alias("letters"))
            write = lambda batch, batch_id: sinks.write_parquet(batch, out, batch_id)
            jobs.start(seen, write, str(tmp_path / "cp")).awaitTermination()
        deadline = time.time() + 20
        while len(reported) < 2 and time.time() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert reported == [(0, {"records": 2, "letters": 1}), (1, {"records": 3, "letters": 3})]


def test_state_is_read_from_the_checkpoint(spark, tmp_path):
    """After a run that stopped and one that went on, the checkpoint holds what the stream last reported."""
    last = {}
    for name, texts in (("a.json", ["good", "bad", "good"]), ("b.json", ["bad", "good", "new"])):
        land(tmp_path / "in", name, [{"id": t, "text": t, "at": "2018-04-13T00:00:01Z"} for t in texts])
        totals = streams.landed_stream(spark, str(tmp_path / "in"), POST).groupBy("id").agg(F.count("*").alias("posts"))
        write = lambda batch, _: last.update({r.id: r.posts for r in batch.collect()})
        jobs.start(totals, write, str(tmp_path / "cp"), mode="update").awaitTermination()
    assert last == {"good": 3, "bad": 2, "new": 1}
    kept = lambda **options: {r[0]: r[1] for r in jobs.kept_state(spark, str(tmp_path / "cp"), **options).collect()}
    assert kept() == last and kept(batchId="0") == {"good": 2, "bad": 1}


def test_state_of_the_running_counts(spark, tmp_path):
    """One row of sums, which are the totals that the stream reports."""
    land(tmp_path / "in", "a.json", [{"id": "1", "text": "good bad good", "at": "2018-04-13T00:00:01Z"}])
    words = streams.landed_stream(spark, str(tmp_path / "in"), POST).select(text.split_on_space(F.col("text")).alias("w"))
    reported = {}
    write = lambda batch, _: reported.update({r.label: r["count"] for r in batch.collect()})
    jobs.start(jobs.running_class_counts(words, "w", {"good"}, {"bad"}), write, str(tmp_path / "cp"), mode="complete").awaitTermination()
    (row,) = jobs.kept_state(spark, str(tmp_path / "cp")).collect()
    assert reported == {"Positive": 2, "Negative": 1} == {"Positive": row["sum"], "Negative": row["sum_2"]}
