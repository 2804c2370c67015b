"""The latest row of every key over any number of batches, kept as a table that stays cheap to read.

Each batch adds a delta: its latest row per key. Deltas are merged in levels: a full level becomes one run of the next, and
the last level is a snapshot that takes up what lies above it once that is as much as it or its level is full. So a
read meets one snapshot and less than twice ``fan`` runs, whatever the number of batches, and a row is rewritten
a few times only. Runs are divided by a hash of the key; a look-up reads the buckets of its keys.

What counts is named by a manifest, which is written last: a batch that fails half-way leaves runs that nothing
names. Merging is by the greatest order and then batch, so applying a batch again, the last or any before it,
changes nothing. One writer at a time; a second one's manifest fails, as the version is taken.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.latest import latest_by_key

BUCKETS, FAN = 64, 8
DELTA, MERGED, SNAPSHOT = 0, 1, 2
BATCH, BUCKET = "_batch", "_bucket"
_MANIFEST = "version long, level int, run string, rows long, batch long"
_PATH_NOT_FOUND = "PATH_NOT_FOUND"


@dataclass(frozen=True)
class Run:
    """A part of the table: its level, folder and rows; batch is the newest that it holds."""

    level: int
    run: str
    rows: int
    batch: int


class LatestTable:
    """``path`` holds the table. ``key`` and ``order`` name columns of the batches; rows with a null key are one key's.

    Of equal ``order`` the later batch counts, and within a batch any one row. ``buckets`` must stay the same over the life
    of a table; ``fan`` may change.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str], buckets: int = BUCKETS, fan: int = FAN):
        self.spark, self.path, self.key, self.order, self.buckets, self.fan = spark, path, key, [*order, BATCH], buckets, fan

    def _manifests(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(_MANIFEST).option("recursiveFileLookup", True).parquet(os.path.join(self.path, "manifest"))
        except AnalysisException as missing:
            if missing.getCondition() != _PATH_NOT_FOUND:
                raise
            return None

    def state(self) -> tuple[int, list[Run]]:
        """The newest version and its runs; version 0 has none."""
        manifests = self._manifests()
        version = manifests.agg(F.max("version")).first()[0] if manifests is not None else None
        if version is None:
            return 0, []
        rows = manifests.where(F.col("version") == version).collect()
        return version, sorted((Run(r.level, r.run, r.rows, r.batch) for r in rows), key=lambda r: (r.level, r.batch, r.run))

    def _bucket(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.buckets)).cast("int")

    def _add(self, rows: DataFrame, level: int, batch: int) -> Run:
        name = f"{('delta', 'merged', 'snapshot')[level]}-{batch}-{uuid.uuid4().hex}"
        placed = rows.withColumn(BUCKET, self._bucket(F.col(self.key))).repartition(BUCKET)
        folder = os.path.join(self.path, "runs", name)
        placed.write.partitionBy(BUCKET).parquet(folder)
        return Run(level, name, self.spark.read.schema(placed.schema).parquet(folder).count(), batch)

    def _read(self, runs: Sequence[str]) -> DataFrame:
        each = [self.spark.read.parquet(os.path.join(self.path, "runs", run)) for run in runs]
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), each)

    def _merge(self, runs: list[Run], level: int) -> Run:
        rows = self._read([r.run for r in runs]).drop(BUCKET)
        return self._add(latest_by_key(rows, self.key, self.order), level, max(r.batch for r in runs))

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Take up a batch; usable as a ``foreachBatch`` function. A batch without rows changes nothing."""
        version, runs = self.state()
        delta = self._add(latest_by_key(batch.withColumn(BATCH, F.lit(batch_id).cast("long")), self.key, self.order), DELTA, batch_id)
        if not delta.rows:
            return
        # A replay takes the place of its own delta, if that isn't merged yet.
        runs = [r for r in runs if (r.level, r.batch) != (DELTA, batch_id)] + [delta]
        deltas = [r for r in runs if r.level == DELTA]
        if len(deltas) >= self.fan:
            runs = [r for r in runs if r.level != DELTA] + [self._merge(deltas, MERGED)]
        above, base = ([r for r in runs if r.level == level] for level in (MERGED, SNAPSHOT))
        if above and (len(above) >= self.fan or sum(r.rows for r in above) >= sum(r.rows for r in base)):
            runs = [r for r in runs if r.level == DELTA] + [self._merge(above + base, SNAPSHOT)]
        rows = [(version + 1, r.level, r.run, r.rows, r.batch) for r in runs]
        named = self.spark.createDataFrame(rows, _MANIFEST).coalesce(1)
        named.write.mode("errorifexists").parquet(os.path.join(self.path, "manifest", f"v{version + 1:010d}"))

    def read(self, keys: Sequence | None = None) -> DataFrame | None:
        """The latest row of each key (of ``keys``, if given), as it came; None before the first batch."""
        _, runs = self.state()
        if not runs:
            return None
        rows = self._read([r.run for r in runs])
        if keys is not None:
            wanted = self.spark.createDataFrame([(k,) for k in keys], f"k {dict(rows.dtypes)[self.key]}")
            buckets = [r.b for r in wanted.select(self._bucket(F.col("k")).alias("b")).distinct().collect()]
            some = rows.where(F.col(BUCKET).isin(buckets)) if buckets else rows.limit(0)
            rows = some.join(F.broadcast(wanted.distinct()), F.col(self.key).eqNullSafe(F.col("k")), "left_semi")
        return latest_by_key(rows.drop(BUCKET), self.key, self.order).drop(BATCH)

    def unnamed(self) -> list[str]:
        """Runs that the newest manifest doesn't name: merged, or left by a failure. No reader that begins now needs
        them; deleting them is left to the caller, who knows which readers began before."""
        _, runs = self.state()
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(os.path.join(self.path, "runs"))
        files = folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        named = {r.run for r in runs}
        return sorted({s.getPath().getName() for s in files.listStatus(folder)} - named)
