"""Per-batch sinks. A replayed batch overwrites its own part, so nothing is written twice."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Header of the comma-separated posts file.
POST_CSV_HEADER = ("Post ID", "Screen Name", "ID", "sentence", "Sentiment")
#: A delimited file with quoted line breaks is read by one task, so files are kept to so many rows.
DELIMITED_ROWS = 1_000_000
# Delimited text keeps every character of a field: quoted where needed, white space at its ends included.
WHOLE_FIELDS = {
    "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


#: What a task of a clustered write takes of the shuffled batch, and what compaction makes files of.
TASK_BYTES, FILE_BYTES = 64 << 20, 128 << 20
#: Parts that folders are hashed to before small ones are joined and large ones split, so that few share a part with a
#: large one.
FOLDER_PARTS = 400


@contextmanager
def _set(spark: SparkSession, **values: str) -> Iterator[None]:
    """Settings of the session while a write runs. The session of a stream has adaptive execution off for the sake
    of its own state; a batch it hands on is planned already, so its write can have it."""
    names = {k.replace("_", "."): v for k, v in values.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _stamped(df: DataFrame, batch_id: int, source: str | None) -> DataFrame:
    stamped = df.withColumn("batch_id", F.lit(batch_id))
    return stamped.withColumn("source_name", F.lit(source)) if source else stamped


def replace_batch(
    df: DataFrame, path: str, format: str, batch_id: int, source: str | None = None,
    levels: Sequence[str] = ("batch_id",), **options,
) -> None:
    """Write one batch as its own partitions of a folder partitioned by source, then ``levels``.

    A level besides ``batch_id`` must follow from the row itself, so that a replay meets its own partitions. Rows of a
    folder are brought together first, so that a folder has a file for each TASK_BYTES of its rows, not one for
    each task that has a row of it; a folder with most of the rows is dealt to as many tasks as it needs.
    """
    parts = [*(["source_name"] if source else []), *levels]
    varied = [level for level in levels if level != "batch_id"]
    with _set(df.sparkSession, spark_sql_adaptive_enabled="true", spark_sql_adaptive_advisoryPartitionSizeInBytes=f"{TASK_BYTES}b"):
        (
            _stamped(df, batch_id, source)
            .hint("rebalance", FOLDER_PARTS, *varied)
            .write.format(format)
            .mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .options(**options)
            .partitionBy(*parts)
            .save(path)
        )


def packed(files: DataFrame, levels: Sequence[str], target_bytes: int) -> DataFrame:
    """``files(file, bytes, levels...)`` that are smaller than ``target_bytes``, with the ``bin`` of their folder each goes to.

    Files are taken in order of their name; a bin holds those whose bytes end within the same multiple of the target,
    so it has less than twice the target. Folders in which that changes nothing are left out.
    """
    folder = Window.partitionBy(*levels)
    ends = F.sum("bytes").over(folder.orderBy("file").rowsBetween(Window.unboundedPreceding, 0))
    small = files.where(F.col("bytes") < target_bytes).withColumn("bin", F.floor((ends - 1) / target_bytes))
    counts = small.withColumns({"_n": F.count("*").over(folder), "_bins": F.max("bin").over(folder) + 1})
    return counts.where("_n > _bins").drop("_n", "_bins")


def compact(
    spark: SparkSession, path: str, out: str, schema: T.StructType | str, levels: Sequence[str], format: str = "json",
    target_bytes: int = FILE_BYTES, **options,
) -> None:
    """Copy the rows below ``path`` into ``out``, partitioned by ``levels`` (a choice of the folder levels of ``path``,
    such as all but the batch), in files of about ``target_bytes``.

    Small files of a folder are packed into bins, each of which one task writes as one file; larger files are dealt out as they
    are. What is in ``out`` for a folder is replaced, so a run that is repeated, or comes after more batches, leaves
    each row once. Nothing below ``path`` is changed or removed.
    """
    rows = spark.read.format(format).schema(schema).options(**options).load(path)
    rows = rows.withColumn("_file", F.col("_metadata.file_path"))
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    where = rows.select("_file", *levels).groupBy("_file").agg(*(F.first(c).alias(c) for c in levels))
    name = F.regexp_replace(F.col("path"), "^([a-z0-9]+):/+", "$1:/")
    sizes = listed.select(name.alias("_name"), F.col("length").alias("bytes"))
    files = where.withColumn("_name", F.regexp_replace("_file", "^([a-z0-9]+):/+", "$1:/")).join(sizes, "_name").withColumnRenamed("_file", "file")
    bins = packed(files, levels, target_bytes).select(F.col("file").alias("_file"), "bin")
    placed = rows.join(bins, "_file", "left").withColumn("_bin", F.coalesce(F.col("bin").cast("string"), "_file"))
    cores = spark.sparkContext.defaultParallelism
    dealt = placed.repartition(max(cores, int(spark.conf.get("spark.sql.shuffle.partitions"))), *levels, "_bin").drop("_file", "bin", "_bin")
    dealt.write.format(format).mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**options).partitionBy(*levels).save(out)


def write_json(
    df: DataFrame, path: str, batch_id: int, source: str, levels: Sequence[str] = ("batch_id",)
) -> None:
    replace_batch(df, path, "json", batch_id, source, levels)


def write_pipe(df: DataFrame, path: str, batch_id: int, rows_per_file: int = DELIMITED_ROWS) -> None:
    """Pipe-delimited with quoting: breaks, pipes and quotes in a text survive the round trip."""
    replace_batch(df, path, "csv", batch_id, sep="|", header=False, maxRecordsPerFile=rows_per_file, **WHOLE_FIELDS)


def write_post_csv(
    df: DataFrame, path: str, columns: Sequence[str], batch_id: int, rows_per_file: int = DELIMITED_ROWS
) -> None:
    """Add one batch of comma-separated posts under the fixed five-column header; a replay replaces it."""
    named = df.select(*[F.col(c).alias(h) for c, h in zip(columns, POST_CSV_HEADER, strict=True)])
    replace_batch(named, path, "csv", batch_id, header=True, maxRecordsPerFile=rows_per_file, **WHOLE_FIELDS)


def write_parquet(df: DataFrame, path: str, batch_id: int) -> None:
    replace_batch(df, path, "parquet", batch_id)


def append_table(df: DataFrame, table: str, batch_id: int, format: str = "parquet", path: str | None = None) -> None:
    """Add one batch to a catalog table; running the batch again replaces what it wrote."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        columns = ", ".join(f"`{c}`" for c in spark.table(table).columns if c != "batch_id")
        # A static partition clause: an overwriting insertInto would replace the whole table.
        spark.sql(
            f"INSERT OVERWRITE TABLE {table} PARTITION (batch_id = {int(batch_id)}) SELECT {columns} FROM {{batch}}",
            batch=df,
        )
        return
    writer = _stamped(df, batch_id, None).write.format(format).partitionBy("batch_id")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def overwrite_table(df: DataFrame, table: str, path: str, format: str = "parquet") -> None:
    """Replace an external table's content."""
    df.write.format(format).mode("overwrite").option("path", path).saveAsTable(table)


def for_database(df: DataFrame, batch_id: int, connections: int) -> DataFrame:
    """The rows of a batch as they are inserted: marked with the batch, in as many parts as connections.

    The parts are dealt after everything before has run in its own parallelism; asking the writer for fewer
    partitions would run the enrichment in as few tasks.
    """
    return df.withColumn("batch_id", F.lit(batch_id)).repartition(connections)


def jdbc_sink(
    url: str, table: str, properties: dict[str, str], delete_batch: Callable[[int], None], connections: int = 16
) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function inserting into a database table; needs the database's driver jar.

    ``delete_batch`` removes the rows of a batch from the table, in the database's own way; it is called before
    the inserts, so a replayed batch isn't stored twice.
    """

    def write(df: DataFrame, batch_id: int) -> None:
        delete_batch(batch_id)
        for_database(df, batch_id, connections).write.option("batchsize", 5000).jdbc(
            url, table, mode="append", properties=properties
        )

    return write


def topic_sink(df: DataFrame, servers: str, topic: str, checkpoint: str):
    """Start writing ``value`` rows to a topic; needs the Kafka connector."""
    return (
        df.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .start()
    )
