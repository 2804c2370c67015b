"""Hard negatives of stated anchors against all rows, with bounds from segment summaries.

A vector is cut into segments, of which the mean and the deviation (length of what is left of the segment once its mean
is taken off) are kept. The inner product of two vectors lies within the means' products, weighed by length, plus
or minus the products of deviations. Shorter segments give closer bounds: a pair is bounded by long segments
first, and only where that leaves it open by shorter ones, and scored entry by entry at last.

Anchors are taken in chunks of bounded bytes; each chunk meets every row where the row lies. A task keeps only the
best few of each anchor, so what is shuffled is some rows for each anchor and task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlens.llm import vectors
from postlens.llm.common import arrow_map
from postlens.session import shared_dir, written
from postlens.sources.scans import spread

#: Larger products of scale and entry count as this much, so that scores of up to 4,096 entries stay within a long.
SCALE, MOST = 256, 1 << 24
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these hundredths of the positive's.
LEAST_SHARE, MOST_SHARE = 80, 100
#: Lengths of segments, level by level.
SEGMENTS = (64, 16, 4)
#: Anchors that a pass over the rows takes, in bytes of their vectors.
CHUNK_BYTES = 16 << 20
ROWS, ANCHORS = 2048, 512
#: Below this share of open pairs they are refined one by one, above it as a whole block.
FEW = 1 / 16
NO_ID = np.iinfo(np.int64).max
NOTHING = np.iinfo(np.int64).min
SCHEMA = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


@dataclass(frozen=True)
class Summaries:
    """Vectors with their segments' weighed means and deviations, level by level."""

    x: np.ndarray
    means: tuple[np.ndarray, ...]
    deviations: tuple[np.ndarray, ...]

    @staticmethod
    def of(x: np.ndarray) -> Summaries:
        means, deviations, values = [], [], x.astype(float)
        for length in SEGMENTS:
            if length >= x.shape[1] and means:
                continue
            starts = np.arange(0, x.shape[1], length)
            sizes = np.diff(np.append(starts, x.shape[1]))
            sums = np.add.reduceat(values, starts, axis=1)
            squares = np.add.reduceat(values * values, starts, axis=1)
            means.append(sums / np.sqrt(sizes))
            deviations.append(np.sqrt(np.maximum(squares - sums * sums / sizes, 0)))
        return Summaries(x, tuple(means), tuple(deviations))

    def __getitem__(self, part: slice) -> Summaries:
        return Summaries(self.x[part], tuple(m[part] for m in self.means), tuple(d[part] for d in self.deviations))


def _products(a: np.ndarray, b: np.ndarray, pairs) -> np.ndarray:
    return a @ b.T if pairs is None else np.einsum("ij,ij->i", a[pairs[0]], b[pairs[1]])


def scored(left: Summaries, right: Summaries, open_: np.ndarray, least: np.ndarray, most: np.ndarray):
    """Positions in ``left`` and ``right`` and exact scores of the pairs marked ``open_`` whose score lies within
    ``least`` and ``most`` of the left one, and per level how many pairs its bounds left open."""
    pairs, counts = None, []
    if open_.mean() < FEW:
        pairs = np.nonzero(open_)
    slack = 1e-6 + 1e-9 * float(np.sqrt((left.x.astype(float) ** 2).sum(1).max(initial=0) * (right.x.astype(float) ** 2).sum(1).max(initial=0)))
    for level in range(len(left.means)):
        middle = _products(left.means[level], right.means[level], pairs)
        reach = _products(left.deviations[level], right.deviations[level], pairs) + slack
        low, high = (least[:, None], most[:, None]) if pairs is None else (least[pairs[0]], most[pairs[0]])
        near = (middle + reach >= low) & (middle - reach <= high)
        if pairs is None:
            open_ = open_ & near
            if open_.mean() < FEW:
                pairs = np.nonzero(open_)
        else:
            pairs = pairs[0][near], pairs[1][near]
        counts.append(int(open_.sum()) if pairs is None else len(pairs[0]))
    largest = int(np.abs(left.x).max(initial=0)) * int(np.abs(right.x).max(initial=0)) * left.x.shape[1]
    a, b = (left.x.astype(float), right.x.astype(float)) if largest < 1 << 53 else (left.x, right.x)
    score = _products(a, b, pairs).astype(np.int64)
    if pairs is None:
        pairs = np.nonzero(open_)
        score = score[pairs]
    fits = (score >= least[pairs[0]]) & (score <= most[pairs[0]])
    return pairs[0][fits], pairs[1][fits], score[fits], counts


class Best:
    """The ``k`` best (score, id) of each slot, higher scores first, then smaller ids."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.score = np.full((slots, k), NOTHING)
        self.id = np.full((slots, k), NO_ID)

    def floor(self) -> np.ndarray:
        """What a score must reach to count."""
        return self.score[:, -1]

    def put(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(slot):
            return
        touched = np.unique(slot)
        held = self.score[touched] > NOTHING
        slot = np.concatenate((slot, np.repeat(touched, self.k)[held.ravel()]))
        score = np.concatenate((score, self.score[touched][held]))
        ids = np.concatenate((ids, self.id[touched][held]))
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        place = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        top = place < self.k
        self.score[slot[top], place[top]], self.id[slot[top], place[top]] = score[top], ids[top]

    def batch(self, names: list[str], keys: np.ndarray) -> pa.RecordBatch:
        slot, place = np.nonzero(self.score > NOTHING)
        ids = self.id[slot, place]
        columns = [pa.array(keys[slot]), pa.array(ids, mask=ids == NO_ID), pa.array(self.score[slot, place])]
        return pa.RecordBatch.from_arrays(columns, names)


def _blocks(parts: Iterator[pa.RecordBatch], width: int):
    """Ids (NO_ID for null), labels and summaries of ``(vec_id, label, x)``, some rows at a time."""
    for part in parts:
        for start in range(0, part.num_rows, ROWS):
            one = part.slice(start, ROWS)
            ids = one.column(0).fill_null(NO_ID).to_numpy(zero_copy_only=False)
            yield ids, one.column(1).to_numpy(zero_copy_only=False), Summaries.of(vectors.matrix(one.column(2), width))


def _positives(rows: DataFrame, key, ids, labels, x, width: int) -> DataFrame:
    """``(key, positive_id, positive_score)``: each task's best rows of an anchor's label, without the anchor's id."""
    names = ["key", "positive_id", "positive_score"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, anchors, most = Best(len(key), POSITIVES), Summaries.of(x), np.full(len(key), NO_ID)
        for row_ids, row_labels, right in _blocks(parts, width):
            for at in range(0, len(key), ANCHORS):
                part = slice(at, min(at + ANCHORS, len(key)))
                open_ = (labels[part, None] == row_labels) & (ids[part, None] != row_ids)
                a, b, score, _ = scored(anchors[part], right, open_, best.floor()[part], most[part])
                best.put(a + at, score, row_ids[b])
        yield best.batch(names, key)

    return arrow_map(rows, batches, "key long, positive_id long, positive_score long")


def _negatives(rows: DataFrame, key, labels, x, goals: np.ndarray, width: int) -> DataFrame:
    """``(slot, negative_id, negative_score)``: each task's best rows of another label within the bounds of each
    positive; slot counts the positives of ``goals[anchor, positive]`` (NOTHING where there is none)."""
    names, k = ["slot", "negative_id", "negative_score"], goals.shape[1]
    real = goals > NOTHING
    least = np.where(real, -((-LEAST_SHARE * np.where(real, goals, 0)) // MOST_SHARE), NO_ID)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, anchors = Best(goals.size, NEGATIVES), Summaries.of(x)
        for row_ids, row_labels, right in _blocks(parts, width):
            for at in range(0, len(key), ANCHORS):
                part = slice(at, min(at + ANCHORS, len(key)))
                open_ = labels[part, None] != row_labels
                low = np.maximum(least[part], best.floor().reshape(goals.shape)[part])
                a, b, score, _ = scored(anchors[part], right, open_, low.min(axis=1), goals[part].max(axis=1))
                for j in range(k):
                    fits = (score >= low[a, j]) & (score <= goals[part][a, j])
                    best.put((a[fits] + at) * k + j, score[fits], row_ids[b[fits]])
        yield best.batch(names, np.arange(goals.size))

    return arrow_map(rows, batches, "slot long, negative_id long, negative_score long")


def _ranked(found: DataFrame, group: str, score: str, tie: str, most: int) -> DataFrame:
    order = Window.partitionBy(group).orderBy(F.desc(score), F.asc_nulls_last(tie))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def mined(rows: DataFrame, anchors: DataFrame, width: int) -> DataFrame:
    """Hard negatives of ``anchors(vec_id, label, x)`` among ``rows`` of the same columns: whole-number vectors of
    ``width`` entries, labels not null.

    One row for each anchor, positive and negative: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score. A positive is one of the first five rows of the anchor's label under another id, a negative one of
    the first five rows of another label whose score is 80 to 100 % of the positive's. Scores are inner products;
    equal ones go by id, null ids last. Repeated rows count each; so do anchors, each with results of its own.
    """
    spark, path = rows.sparkSession, shared_dir(rows.sparkSession, "hard-negatives")
    spark.createDataFrame([], SCHEMA).write.parquet(path)
    numbered = written(anchors.withColumn("key", F.monotonically_increasing_id()), "anchors")
    chunks = ceil(numbered.count() * 8 * max(1, width) / CHUNK_BYTES)
    even = spread(rows)
    for chunk in range(chunks):
        some = numbered.filter(F.pmod(F.xxhash64("key"), F.lit(chunks)) == chunk).select("vec_id", "label", "x", "key").toArrow().combine_chunks()
        if not some.num_rows:
            continue
        ids, labels, key = (some.column(k).to_numpy() for k in (0, 1, 3))
        x = vectors.matrix(some.column(2).chunk(0), width)
        near = _ranked(_positives(even, key, ids, labels, x, width), "key", "positive_score", "positive_id", POSITIVES).collect()
        place = {k: i for i, k in enumerate(key.tolist())}
        goals = np.full((len(key), POSITIVES), NOTHING)
        slots = []
        for r in near:
            i = place[r.key]
            goals[i, r["rank"] - 1] = r.positive_score
            slots.append((i * POSITIVES + r["rank"] - 1, int(ids[i]), r.positive_id, r.positive_score))
        of = spark.createDataFrame(slots, "slot long, anchor_id long, positive_id long, positive_score long")
        hard = _ranked(_negatives(even, key, labels, x, goals, width), "slot", "negative_score", "negative_id", NEGATIVES)
        columns = [c.split()[0] for c in SCHEMA.split(", ")]
        hard.join(F.broadcast(of), "slot").select(*columns).write.mode("append").parquet(path)
    return spark.read.schema(SCHEMA).parquet(path)


def hard_negatives(rows: DataFrame, every: int = 100) -> DataFrame:
    """:func:`mined` over ``rows(vec_id, embedding, label)`` with the rows whose vec_id ``every`` divides as anchors.

    Rows with a null label or vector, null or non-finite entries, or a vector of unusual length take no part. A
    row without id is no anchor but may be a partner. Where 7 divides vec_id, label becomes (label + 1) % 10. Entries
    become floor(256 * entry) (products beyond 2^24 count as that). No usable rows or anchors, or empty
    vectors, give no rows. Other columns are not looked at.
    """
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    plain = rows.filter(F.col("label").isNotNull()).select(F.col("vec_id").cast("long"), moved.alias("label"), F.col("embedding").alias("x"))
    good, width = vectors.usable(plain, "x")
    if not width:
        return rows.sparkSession.createDataFrame([], SCHEMA)
    kept = written(good.withColumn("x", vectors.whole(F.col("x"), SCALE, MOST)), "vectors")
    return mined(kept, kept.filter(F.col("vec_id") % every == 0), width)
