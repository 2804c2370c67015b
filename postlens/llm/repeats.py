"""Repeated windows of a fixed width over token sequences, exactly, without shuffling every window.

Each window picks an anchor: the least hash among the short seeds in it. Equal windows pick equal anchors, so only
anchors are counted over the corpus, and windows whose anchor occurs once are done. The consecutive windows of
one anchor are an instance; its context is the tokens they cover. Instances of equal context are settled by one
aggregate. What is left, one instance of each context of an anchor with several, is compared window by window.

What that comparison is (sorted suffixes, or k-mer edges), the operators say; both use this module for the rest.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import arrow_map
from postlens.session import written

#: Tokens of a text that are hashed at a time; bounds the arrays of a task whatever the length of a text.
BLOCK = 1 << 20
#: Rows whose instances a task holds at a time.
SLICE = 512
#: Anchors with more contexts than this are not compared in one task; their windows are dealt out singly.
HOT = 4096
#: Bits of the map of repeated anchors: 64 for each, at most this many (32 MB). Beyond, more anchors that are
#: not repeated pass; they are removed exactly later on.
MAP_BITS = 1 << 28
_BASE = 0x9E3779B97F4A7C15
_HIGH = np.uint64(0xFFFFFFFF00000000)
#: The constants of XXH64.
_PRIMES = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
COORDINATE = ("doc_id", "rev", "start")


def span_hashes(tokens: np.ndarray, width: int) -> np.ndarray:
    """A hash of each ``width`` consecutive tokens, by doubling, stirred so that its order means nothing."""
    done, total, power, part, size = 0, None, _BASE, tokens, 1
    left = width
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                n = len(tokens) - (done + size) + 1
                tail = part[done : done + n] if done else part[:n]
                total = tail.copy() if total is None else total[:n] * np.uint64(power) + tail
                done += size
            left >>= 1
            if left:
                part = part[: len(part) - size] * np.uint64(power) + part[size:]
                power, size = power * power % (1 << 64), size * 2
        return stirred(total)


def stirred(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
        x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
        return x ^ (x >> np.uint64(33))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[:-rest], values[rest:]) if rest else values


@dataclass(frozen=True)
class Instances:
    """Per anchor of a text: its seed's hash, first window start, number of windows, and how far after the first
    start the seed begins."""

    seed: np.ndarray
    start: np.ndarray
    n: np.ndarray
    lead: np.ndarray


def instances(tokens: np.ndarray, width: int, seed: int) -> Instances:
    """The anchors of all windows of ``tokens``. Among equal hashes the leftmost counts. A text longer than a
    block has its instances cut at block ends, which the window comparison evens out."""
    found = []
    for at in range(0, max(0, len(tokens) - width + 1), BLOCK):
        hashes = span_hashes(tokens[at : at + BLOCK + width - 1], seed)
        places = np.arange(len(hashes), dtype=np.uint64)
        anchor = (sliding_least((hashes & _HIGH) | places, width - seed + 1) & ~_HIGH).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
        n = np.diff(np.append(first, len(anchor)))
        found.append((hashes[anchor[first]], first + at, n, anchor[first] - first))
    if not found:
        none = np.empty(0, np.int64)
        return Instances(none.view(np.uint64), none, none, none)
    return Instances(*(np.concatenate(c) for c in zip(*found, strict=True)))


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true."""
    edges = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def slices(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most SLICE, as an instance becomes several objects."""
    for part in parts:
        for at in range(0, part.num_rows, SLICE):
            yield part.slice(at, SLICE)


@dataclass(frozen=True)
class Task:
    """What an operator brings: how a text becomes tokens, what of an instance is kept for comparison, and the
    comparison itself.

    tokens: text -> array of uint64. payloads: (text, tokens, starts, ns) -> per instance bytes that determine its
    windows.
    compare: columns of one bucket's instances -> per instance the flags of its windows that are repeated (for
    ``keep_first``: that have an earlier equal). window: (payload, n) -> a hash per window.
    """

    width: int
    seed: int
    keep_first: bool
    tokens: Callable[[bytes], np.ndarray]
    payloads: Callable[[bytes, np.ndarray, list[int], list[int]], list[bytes]]
    compare: Callable[[pa.Table], list[np.ndarray]]
    window: Callable[[bytes, int], np.ndarray]
    deal: Callable[[DataFrame], DataFrame]


def identified(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``rev`` (a hash of the text, so that texts under one id stay apart), ``raw``."""
    return docs.select(
        "doc_id", F.xxhash64("text").alias("rev"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    )


def _seeds(rows: DataFrame, task: Task) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            found = [instances(task.tokens(raw), task.width, task.seed).seed for raw in part.column(0).to_pylist()]
            seeds = np.concatenate(found) if found else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64))], names=["seed"])

    return arrow_map(rows.select("raw"), batches, "seed long")


def _bit_map(values: DataFrame):
    """A broadcast bit map of the longs in the one column of ``values``."""
    spark, name = values.sparkSession, values.columns[0]
    bits, n = 1 << 12, values.count()
    while bits < min(MAP_BITS, 64 * n):
        bits *= 2
    place = F.col(name).bitwiseAND(F.lit(bits - 1))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(63).cast("int"))
    words = values.select(F.shiftrightunsigned(place, 6).alias("w"), one.alias("bit")).groupBy("w").agg(F.bit_or("bit").alias("bits"))
    table = words.toArrow()
    filled = np.zeros(bits // 64, np.int64)
    filled[table.column("w").to_numpy()] = table.column("bits").to_numpy()
    return spark.sparkContext.broadcast(filled)


def repeated_seeds(rows: DataFrame, task: Task):
    """A broadcast bit map of the seeds that are the anchor of two instances or more."""
    return _bit_map(written(_seeds(rows, task).groupBy("seed").count().filter("count > 1").select("seed"), "seeds"))


def _is_in(bit_map: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    place = seeds & np.uint64(len(bit_map) * 64 - 1)
    words = bit_map.view(np.uint64)[(place >> np.uint64(6)).astype(np.int64)]
    return (words >> (place & np.uint64(63))) & np.uint64(1) != 0


def marks(owner: int, starts: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64(doc_id, rev, start)`` is at each of ``starts``, where ``xxhash64(doc_id, rev)`` is ``owner``."""
    one, two, three, four, five = (np.uint64(p) for p in _PRIMES)
    turned = lambda x, k: (x << np.uint64(k)) | (x >> np.uint64(64 - k))
    with np.errstate(over="ignore"):
        x = np.uint64(owner % (1 << 64)) + five + np.uint64(8)
        x = turned(x ^ (turned(starts.astype(np.uint64) * two, 31) * one), 27) * one + four
        x = (x ^ (x >> np.uint64(33))) * two
        x = (x ^ (x >> np.uint64(29))) * three
        return x ^ (x >> np.uint64(32))


def _instances(rows: DataFrame, task: Task, chosen: Callable[[int, Instances], np.ndarray], whole: bool) -> DataFrame:
    """The instances that ``chosen`` flags in a text; ``whole`` ones with their lead and payload."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            found, payloads, owner = [], [], []
            for row, (raw, mark) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True)):
                tokens = task.tokens(raw)
                all_ = instances(tokens, task.width, task.seed)
                some = np.flatnonzero(chosen(mark, all_))
                if not len(some):
                    continue
                payloads += task.payloads(raw, tokens, all_.start[some].tolist(), all_.n[some].tolist())
                found.append((all_.seed[some], all_.start[some], all_.n[some], all_.lead[some]))
                owner.append(np.full(len(some), row))
            if not found:
                continue
            seeds, starts, ns, leads = (np.concatenate(c) for c in zip(*found, strict=True))
            contexts = np.array([xxhash.xxh64_intdigest(p) for p in payloads], np.uint64).view(np.int64)
            owner = pa.array(np.concatenate(owner))
            columns = [pa.array(seeds.view(np.int64)), pa.array(contexts), part.column(0).take(owner), part.column(1).take(owner)]
            columns += [pa.array(starts), pa.array(ns.astype(np.int32))]
            if whole:
                columns += [pa.array(leads.astype(np.int32)), pa.array(payloads, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    fields = [("seed", T.LongType()), ("context", T.LongType()), ("doc_id", rows.schema["doc_id"].dataType), ("rev", T.LongType())]
    fields += [("start", T.LongType()), ("n", T.IntegerType())]
    fields += [("lead", T.IntegerType()), ("payload", T.BinaryType())] if whole else []
    schema = T.StructType([T.StructField(*f) for f in fields])
    return arrow_map(rows.select("doc_id", "rev", "raw", F.xxhash64("doc_id", "rev").alias("owner")), batches, schema)


def candidates(rows: DataFrame, task: Task, shared) -> DataFrame:
    """Instances whose seed is in the bit map ``shared`` of repeated ones (and few others), without their payload."""
    return written(_instances(rows, task, lambda mark, all_: _is_in(shared.value, all_.seed), False), "instances")


def opened(rows: DataFrame, task: Task, shared, open_: DataFrame) -> DataFrame:
    """The first instance of each context of ``open_(seed, context, contexts, at)``, with its payload.

    Payloads are large, so they are made from the texts anew, and only where a bit map of the first coordinates (and
    few others) says so: no other payload is written or shuffled.
    """
    mark = F.xxhash64(*(f"at.{c}" for c in COORDINATE)) if task.keep_first else F.col("at")
    firsts = _bit_map(open_.select(mark.alias("mark")))

    def chosen(owner: int, all_: Instances) -> np.ndarray:
        return _is_in(shared.value, all_.seed) & _is_in(firsts.value, marks(owner, all_.start))

    found = _instances(rows, task, chosen, True)
    is_first = _coordinate(task).eqNullSafe(F.col("at"))
    return found.join(open_, ["seed", "context"]).filter(is_first).drop("at").dropDuplicates(["seed", "context"])


def _coordinate(task: Task) -> Column:
    """Where a window or an instance starts: in order, where the earliest counts, else as a number of its own."""
    return F.struct(*COORDINATE) if task.keep_first else F.xxhash64(*COORDINATE)


def _ends(rows: DataFrame, task: Task, *keys: str) -> DataFrame:
    """Per key ``first``, the least coordinate, and whether there is ``another``."""
    at = _coordinate(task)
    several = F.count("*") > 1 if task.keep_first else F.min(at) != F.max(at)
    return rows.groupBy(*keys).agg(F.min(at).alias("first"), several.alias("another"))


def _later(rows: DataFrame, task: Task) -> DataFrame:
    """Of ``rows`` with first and another: those whose windows repeat (``keep_first``: repeat an earlier one)."""
    repeated = rows.filter("another")
    return repeated.filter(~_coordinate(task).eqNullSafe(F.col("first"))) if task.keep_first else repeated


def repeated(rows: DataFrame, task: Task) -> DataFrame:
    """``(doc_id, rev, start, n)``: runs of ``n`` windows from ``start`` on that repeat, of :func:`identified` rows."""
    shared = repeated_seeds(rows, task)
    plain = candidates(rows, task, shared)
    contexts = _ends(plain, task, "seed", "context")
    several = contexts.groupBy("seed").agg(F.count("*").alias("contexts"))
    known = written(contexts.join(several, "seed").filter("contexts > 1 OR another"), "contexts")
    settled = _later(plain.join(known.filter("another"), ["seed", "context"]), task).select(*COORDINATE, "n")

    open_ = known.filter("contexts > 1").select("seed", "context", "contexts", F.col("first").alias("at"))
    left = written(opened(rows, task, shared, open_), "open-instances")
    fields = [T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("rev", T.LongType())]
    schema = T.StructType([*fields, T.StructField("start", T.LongType()), T.StructField("n", T.IntegerType())])

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket = [p for p in parts if p.num_rows]
        if not bucket:
            return
        table = pa.Table.from_batches(bucket).combine_chunks()
        starts, owner, ns = table.column("start").to_numpy(), [], []
        out = []
        for i, flags in enumerate(task.compare(table)):
            for a, b in zip(*runs(flags), strict=True):
                owner.append(i), out.append(starts[i] + a), ns.append(b - a)
        keys = pa.array(owner, pa.int64())
        columns = [table.column("doc_id").take(keys).combine_chunks(), table.column("rev").take(keys).combine_chunks()]
        columns = [c.chunk(0) if isinstance(c, pa.ChunkedArray) and c.num_chunks else c for c in columns]
        if len(keys):
            yield pa.RecordBatch.from_arrays([*columns, pa.array(out, pa.int64()), pa.array(ns, pa.int32())], schema.names)

    compared = arrow_map(task.deal(left.filter(F.col("contexts") <= HOT)), compare, schema)
    return settled.unionByName(compared).unionByName(_dealt_singly(left.filter(F.col("contexts") > HOT), task))


def _dealt_singly(hot: DataFrame, task: Task) -> DataFrame:
    """The windows of anchors with very many contexts, each a row; equal ones meet by their hash."""
    fields = [f for f in hot.schema.fields if f.name in ("seed", "doc_id", "rev")]
    schema = T.StructType([*fields, T.StructField("start", T.LongType()), T.StructField("code", T.LongType())])

    def windows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(parts):
            ns = part.column("n").to_numpy()
            codes = [task.window(p, n) for p, n in zip(part.column("payload").to_pylist(), ns.tolist(), strict=True)]
            if not codes:
                continue
            owner = pa.array(np.repeat(np.arange(len(ns)), ns))
            starts = np.concatenate([s + np.arange(n) for s, n in zip(part.column("start").to_numpy(), ns, strict=True)])
            keys = [part.column(f.name).take(owner) for f in fields]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(starts), pa.array(np.concatenate(codes).view(np.int64))], schema.names)

    single = written(arrow_map(hot, windows, schema), "single-windows")
    ends = _ends(single, task, "seed", "code").filter("another")
    return _later(single.join(ends, ["seed", "code"]), task).select(*COORDINATE, F.lit(1).alias("n"))


def spans_by_document(found: DataFrame) -> DataFrame:
    """One row per document with its runs, an array no longer than its text has windows."""
    return found.groupBy("doc_id", "rev").agg(F.collect_list(F.struct("start", "n")).alias("spans"))


def with_spans(rows: DataFrame, spans: DataFrame) -> DataFrame:
    marked = spans.withColumnsRenamed({"doc_id": "_id", "rev": "_rev"})
    same: Column = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("rev") == F.col("_rev"))
    return rows.join(marked, same, "left").drop("_id", "_rev")


def covered(spans: list[dict] | None, n: int, width: int) -> np.ndarray:
    """Flags of the ``n`` tokens that lie in a window of the runs."""
    depth = np.zeros(n + 1, np.int64)
    if spans:
        starts = np.array([s["start"] for s in spans])
        np.add.at(depth, starts, 1)
        np.add.at(depth, starts + [s["n"] for s in spans] + width - 1, -1)
    return np.cumsum(depth[:-1]) > 0
