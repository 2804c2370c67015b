"""Streaming jobs: enrichment, running class counts, batch history, raw archive, de-duplication."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery, StreamingQueryListener

from postlens.operators import counts
from postlens.operators.latest import latest_by_key
from postlens.plans.enrich import Dictionaries, enrich
from postlens.sources import offsets, posts, streams
from postlens.sources.scans import spread
from postlens.sources.schemas import ANALYSIS_COLUMNS, TOPICS
from postlens.streaming import sinks

# Micro-batch intervals of the jobs.
INTERVALS = {"source_jobs": "2 seconds", "table_job": "5 seconds", "deployed": "10 seconds", "strings_table": "60 seconds"}

# Folder names of the two outcomes.
GOOD = "good"
QUARANTINED = "quarantined"

#: Most date folders a batch makes; one that spans more days is filed by month, or by year. Every folder costs a file,
#: and the driver a rename.
DATE_FOLDERS = 512

BatchFunction = Callable[[DataFrame, int], None]


def triggered(writer: DataStreamWriter, interval: str | None) -> DataStreamWriter:
    """At an interval; without one, work off what is there and stop."""
    return writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)


def start(
    df: DataFrame, write: BatchFunction, checkpoint: str, interval: str | None = None, mode: str = "append"
) -> StreamingQuery:
    """Run ``write`` per micro-batch; without an interval, work off what is there and stop."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(write)
    return triggered(writer, interval).start()


def run_bounded(query: StreamingQuery, seconds: int) -> bool:
    """Let a query run for a limited time, then stop it cleanly. True when it ended by itself."""
    ended = query.awaitTermination(seconds)
    if not ended:
        query.stop()
    return ended


def enriched_posts(messages: DataFrame, source: str, dicts: Dictionaries) -> DataFrame:
    """Decoded messages of one source as enriched flat rows. Works on a stream as it stands: every step
    is row-local."""
    good, _ = posts.route(messages, posts.SCHEMAS[source], posts.REQUIRED[source])
    flat = posts.FLATTEN[source](good)
    return enrich(flat, dicts, posts.TEXT_COLUMN[source])


def _folder_of(day: Column, batch: DataFrame) -> Column:
    """The name of the date folder a row goes to: its day, or its month or year where the batch spans too many. It follows
    from the batch, so a replay meets its own folders."""
    days = batch.select(day.alias("day")).distinct()
    month, year = F.date_format(day, "yyyy-MM"), F.date_format(day, "yyyy")
    found = days.agg(F.count("day").alias("days"), F.count_distinct(F.date_format("day", "yyyy-MM")).alias("months")).first()
    if found.days <= DATE_FOLDERS:
        return day.cast("string")
    return month if found.months <= DATE_FOLDERS else year


def enrichment_writer(source: str, dicts: Dictionaries, out: str, arrival: str = "timestamp") -> BatchFunction:
    """Per batch: enriched rows as JSON by source and date, unusable ones beside them with their reason.

    One pass over the batch writes both: rows are marked instead of split, and the mark is a folder level
    (``status=good`` / ``status=quarantined``) of the output. The date is the message's own ``arrival``, where
    the messages have one: the clock of a replay could be another day's. Rows have it as ``arrival_date`` as well, since
    a batch of very many days is filed by month or year.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        day = F.to_date(arrival)
        dated = [day.cast("string").alias("arrival_date"), _folder_of(day, batch).alias("ingest_date")] if arrival in batch.columns else []
        messages = spread(batch.select("value", *dated))
        judged = posts.judged(messages, posts.SCHEMAS[source], posts.REQUIRED[source])
        marked = judged.withColumns(
            {
                "status": F.when(F.col("reason").isNull(), GOOD).otherwise(QUARANTINED),
                "rejected": F.when(F.col("reason").isNotNull(), F.col("value")),
            }
        )
        dates = ["ingest_date"] if dated else []
        own = ["arrival_date", "ingest_date"] if dated else []
        flat = posts.FLATTEN[source](marked, ["status", "reason", "rejected", *own])
        enriched = enrich(flat, dicts, posts.TEXT_COLUMN[source])
        usable = F.col("status") == GOOD
        analysed = enriched.withColumns(
            {name: F.when(usable, F.col(name)) for name in ANALYSIS_COLUMNS}
        )
        sinks.write_json(analysed, out, batch_id, source, [*dates, "batch_id", "status"])

    return write


def topic_job(
    spark: SparkSession, servers: str, topic: str, dicts: Dictionaries, out: str, checkpoint: str,
    interval: str = INTERVALS["source_jobs"], ascii_only: bool = False,
) -> StreamingQuery:
    """The whole job of one feed: topic -> enriched JSON by source and batch."""
    messages = streams.decoded(streams.topic_stream(spark, servers, [topic]), ascii_only)
    return start(messages, enrichment_writer(TOPICS[topic], dicts, out), checkpoint, interval)


def to_console(
    df: DataFrame, checkpoint: str, rows: int = 20, mode: str = "update", interval: str | None = None
) -> StreamingQuery:
    """Print each batch, as the counting jobs do."""
    writer = df.writeStream.format("console").option("numRows", rows).outputMode(mode)
    return triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def running_class_counts(
    posts_stream: DataFrame, words: str, positive: Iterable[str], negative: Iterable[str]
) -> DataFrame:
    """Streaming totals per label since the start. Two keys of state, never expired."""
    return counts.class_totals(posts_stream, words, positive, negative)


def history_writer(words: str, positive: Iterable[str], negative: Iterable[str], out: str) -> BatchFunction:
    """Each batch's class counts appended to a table instead of a driver-side list."""
    positive, negative = set(positive), set(negative)

    def write(batch: DataFrame, batch_id: int) -> None:
        totals = counts.class_totals(batch, words, positive, negative, records="records")
        sinks.write_parquet(totals, out, batch_id)

    return write


def count_writer(report: Callable[[int, int], None]) -> BatchFunction:
    """Number of records in each batch, reported as it completes."""

    def write(batch: DataFrame, batch_id: int) -> None:
        report(batch_id, batch.count())

    return write


class BatchCounts(StreamingQueryListener):
    """Reports how many records each batch of one stream had, and other sums of it, without reading the batch again.

    The sums are taken as the batch runs through (:func:`observed`) and come with its progress. Register it with
    ``spark.streams.addListener``; ``report`` gets the batch's number and its sums.
    """

    def __init__(self, name: str, report: Callable[[int, dict[str, int]], None]):
        self.name, self.report = name, report

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        sums = event.progress.observedMetrics.get(self.name)
        if sums is not None and event.progress.numInputRows:
            self.report(event.progress.batchId, sums.asDict())

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def observed(stream: DataFrame, name: str, *sums: Column) -> DataFrame:
    """``stream`` as it is, with its records, and further ``sums``, counted on the way for :class:`BatchCounts`."""
    return stream.observe(name, F.count("*").alias("records"), *sums)


def kept_state(spark: SparkSession, checkpoint: str, **options: str) -> DataFrame:
    """The keyed state of a stream as its checkpoint holds it after the last finished batch (or the one that ``batchId``
    names): a row for each key, with the columns of key and value. Reads the files; the stream need not run. Values without a name of their own are called
    after what they are, as ``sum``; the second of that name is ``sum_2``."""
    state = spark.read.format("statestore").options(**options).load(checkpoint)
    seen: dict[str, int] = {}

    def distinct(part: str) -> Column:
        fields = []
        for field in state.schema[part].dataType:
            seen[field.name] = seen.get(field.name, 0) + 1
            fields.append(T.StructField(field.name if seen[field.name] == 1 else f"{field.name}_{seen[field.name]}", field.dataType))
        # A cast of a struct goes by position, which tells fields of one name apart.
        return F.col(part).cast(T.StructType(fields)).alias(part)

    return state.select(distinct("key"), distinct("value")).select("key.*", "value.*")


def raw_archive(messages: DataFrame, out: str, checkpoint: str, interval: str | None = None) -> StreamingQuery:
    """Store messages unparsed, with where they came from."""
    kept = [c for c in ("topic", "partition", "offset", "timestamp") if c in messages.columns]
    writer = messages.select("value", *kept).writeStream.format("json").option("path", out)
    return triggered(writer.option("checkpointLocation", checkpoint), interval).start()


def ledger_writer(out: str) -> BatchFunction:
    """The ranges of offsets that each batch read; :func:`read_ledger` makes one account of them. A replayed batch
    replaces its own."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_parquet(offsets.ranges(batch.select("topic", "partition", "offset")), out, batch_id)

    return write


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ranges, repeats and gaps over all batches of ``ledger_writer``."""
    return offsets.ledger(spark.read.parquet(path))


def first_seen(stream: DataFrame, key: str, time: str, delay: str = "1 day") -> DataFrame:
    """Drop repeats of a post that come within ``delay`` of event time, which bounds the state."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def latest_writer(key: str, order: list[str], out: str) -> BatchFunction:
    """Latest version of each post within a batch; ``latest_posts`` settles versions across batches."""

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_parquet(latest_by_key(batch, key, order), out, batch_id)

    return write


def latest_posts(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The latest version of every post over all batches of ``latest_writer``."""
    return latest_by_key(spark.read.parquet(path), key, [*order, "batch_id"])
