"""Suffix-array dedup: bytes in strings of 200 bytes that start in two places are removed.

Of all suffixes only those at anchors are sorted (see :mod:`postlens.llm.repeats`): a repeated string has an anchor at
the same place in both copies. Suffixes are dealt by range of their leading bytes, with splitters that Spark samples;
a splitter never parts suffixes with one seed, so nothing has to be compared across bucket boundaries but anchors
that are very frequent, whose strings are dealt out singly. A bucket sorts its suffixes by multikey quicksort, on
eight bytes at a time, and likewise the reversed texts before the anchors. A string that begins ``a`` bytes before the
anchor repeats if another one shares ``a`` bytes to the left and the rest to the right: both are runs of the two sorted
orders, cut where neighbours have too short a common prefix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm import repeats
from postlens.llm.common import arrow_map

LENGTH, SEED = 200, 32
_CODES = repeats.stirred(np.arange(1, 257, dtype=np.uint64))


def multikey_order(keys: np.ndarray) -> np.ndarray:
    """Order of the rows of ``keys`` (big-endian words): rows equal so far are parted by their next word."""
    order, group = np.arange(len(keys)), np.zeros(len(keys), np.int64)
    tied = np.arange(len(keys))
    for word in range(keys.shape[1]):
        if not len(tied):
            break
        rows, value = order[tied], keys[order[tied], word]
        by = np.lexsort((value, group[tied]))
        order[tied], value = rows[by], value[by]
        own = group[tied]
        new = np.concatenate(([True], (own[1:] != own[:-1]) | (value[1:] != value[:-1])))
        group[tied] = tied[np.flatnonzero(new)][np.cumsum(new) - 1]
        tied = tied[~(new & np.append(new[1:], True))]
    return order


def common_prefixes(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row in ``order`` shares with the one before; 0 for the first."""
    found = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 1 << 14):
        rows = order[at - 1 : at + (1 << 14)]
        apart = keys[rows[1:]] ^ keys[rows[:-1]]
        word = (apart != 0).argmax(axis=1)
        first = apart[np.arange(len(word)), word]
        byte = (first.astype(">u8").view(np.uint8).reshape(-1, 8) != 0).argmax(axis=1)
        found[at : at + len(word)] = np.where(first == 0, keys.shape[1] * 8, word * 8 + byte)
    return found


def _padded(parts: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join(p[:width].ljust(width, b"\0") for p in parts), ">u8").reshape(len(parts), -1).astype(np.uint64)


class _Sorted:
    """One side of the anchors in order. Padding never counts: an instance takes part only for offsets at which
    all bytes of the string are its own."""

    def __init__(self, parts: list[bytes], width: int):
        keys = _padded(parts, width)
        self.order = multikey_order(keys)
        self.shared = common_prefixes(keys, self.order)
        after = np.append(self.shared[1:], 0)
        self.most = np.empty(len(parts), np.int64)
        self.most[self.order] = np.maximum(self.shared, after)

    def groups(self, depth: int) -> np.ndarray:
        found = np.empty(len(self.order), np.int64)
        found[self.order] = np.cumsum(self.shared < depth)
        return found


def compare(table: pa.Table) -> list[np.ndarray]:
    """Which windows of the instances of a bucket have an equal among the others."""
    texts, lead, n = table.column("payload").to_pylist(), table.column("lead").to_numpy(), table.column("n").to_numpy()
    right = _Sorted([t[k:] for t, k in zip(texts, lead.tolist(), strict=True)], LENGTH)
    room = (LENGTH - SEED + 7) // 8 * 8
    left = _Sorted([t[:k][::-1] for t, k in zip(texts, lead.tolist(), strict=True)], room)
    ends = np.cumsum(n)
    flags = np.zeros(int(ends[-1]), bool)
    for a in range(int((lead - n + 1).min()), int(lead.max()) + 1):
        one = np.flatnonzero((lead >= a) & (lead - n < a) & (right.most >= LENGTH - a) & (left.most >= a))
        if len(one) < 2:
            continue
        key = right.groups(LENGTH - a)[one] * (len(n) + 1) + left.groups(a)[one]
        _, place, count = np.unique(key, return_inverse=True, return_counts=True)
        again = one[count[place] > 1]
        flags[ends[again] - n[again] + lead[again] - a] = True
    return np.split(flags, ends[:-1])


TASK = repeats.Task(
    width=LENGTH,
    seed=SEED,
    keep_first=False,
    tokens=lambda raw: _CODES[np.frombuffer(raw, np.uint8)],
    payloads=lambda raw, tokens, starts, ns: [raw[a : a + n - 1 + LENGTH] for a, n in zip(starts, ns, strict=True)],
    compare=compare,
    window=lambda payload, n: np.array([xxhash.xxh64_intdigest(payload[i : i + LENGTH]) for i in range(n)], np.uint64),
    deal=lambda left: left.repartitionByRange(F.expr(f"substring(payload, lead + 1, {SEED})")),
)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed, n_spans (maximal removed runs) and
    ``kept``, the remaining bytes.

    Null texts are empty; shorter texts than a string keep all. A string counts as repeated wherever it starts
    twice, in one document or in two, overlaps included. Repeated rows (same id and text) are one document, so
    they don't repeat each other; different texts under one id, or without id, stay apart. Empty input gives no
    rows; further columns are not looked at.
    """
    rows = repeats.identified(docs)
    spans = repeats.spans_by_document(repeats.repeated(rows, TASK))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in repeats.slices(parts):
            removed, n_spans, kept = [], [], []
            for raw, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                gone = repeats.covered(found, len(raw), LENGTH)
                removed.append(int(gone.sum()))
                n_spans.append(len(repeats.runs(gone)[0]))
                kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if found else raw)
            sizes = pa.array([len(x) for x in part.column(1).to_pylist()], pa.int64())
            columns = [part.column(0), sizes, pa.array(removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
    schema = T.StructType([*fields, T.StructField("kept", T.BinaryType())])
    return arrow_map(repeats.with_spans(rows, spans).select("doc_id", "raw", "spans"), batches, schema)
