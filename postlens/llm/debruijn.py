"""Substring dedup on a De Bruijn graph of words: words in 20-word strings that occur earlier are removed.

An edge of the graph is a k-mer of 20 words. A text is a path; the edges around one anchor (see
:mod:`postlens.llm.repeats`) are a piece of it. An anchor that always has the same surroundings doesn't branch: its
piece stands for all of its edges, and one join with the piece's first source coordinate settles every copy. Where
an anchor has several surroundings the graph branches, and there the edges are compared one by one, again by
source coordinate. Runs of removed edges with their coordinates are put together per document at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from postlens.llm import repeats
from postlens.llm.common import arrow_map

LENGTH, SEED = 20, 5


def word_codes(raw: bytes) -> np.ndarray:
    words = raw.split()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(w) for w in words), np.uint64, len(words))


def edges(raw: bytes, tokens: np.ndarray, starts: list[int], ns: list[int]) -> list[bytes]:
    """The edges of each piece, eight bytes each; hashed once per text."""
    codes = repeats.span_hashes(tokens, LENGTH).tobytes()
    return [codes[8 * a : 8 * (a + n)] for a, n in zip(starts, ns, strict=True)]


def compare(table: pa.Table) -> list[np.ndarray]:
    """Which edges of the pieces of a bucket have an equal one at an earlier coordinate."""
    n = table.column("n").to_numpy()
    keys = [(name, "ascending") for name in repeats.COORDINATE]
    rank = np.empty(len(n), np.int64)
    rank[pc.sort_indices(table, sort_keys=keys, null_placement="at_start").to_numpy()] = np.arange(len(n))
    codes = np.frombuffer(b"".join(table.column("payload").to_pylist()), np.uint64)
    owner = np.repeat(np.arange(len(n)), n)
    seeds = table.column("seed").to_numpy()[owner]
    order = np.lexsort((rank[owner], codes, seeds))
    code, seed = codes[order], seeds[order]
    flags = np.empty(len(codes), bool)
    flags[order] = np.concatenate(([False], (code[1:] == code[:-1]) & (seed[1:] == seed[:-1])))
    return np.split(flags, np.cumsum(n)[:-1])


TASK = repeats.Task(
    width=LENGTH,
    seed=SEED,
    keep_first=True,
    tokens=word_codes,
    payloads=edges,
    compare=compare,
    window=lambda payload, n: np.frombuffer(payload, np.uint64),
    deal=lambda left: left.repartition("seed"),
)


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs(doc_id, text)``: doc_id, n_words, n_removed and ``kept``, the remaining words with
    single spaces between them.

    Null texts have no words; texts of fewer than 20 words keep all. The first occurrence, by doc_id, then start,
    is kept; a null id comes before all others. Repeated rows (same id and text) are one document and don't
    remove each other's words; different texts under one id are ordered by a hash. Empty input gives no rows;
    further columns are not looked at.
    """
    rows = repeats.identified(docs)
    spans = repeats.spans_by_document(repeats.repeated(rows, TASK))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in repeats.slices(parts):
            n_words, removed, kept = [], [], []
            for raw, found in zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True):
                words = raw.split()
                gone = repeats.covered(found, len(words), LENGTH)
                n_words.append(len(words))
                removed.append(int(gone.sum()))
                left = [w for w, g in zip(words, gone.tolist(), strict=True) if not g] if found else words
                kept.append(b" ".join(left))
            counts = [pa.array(c, pa.int64()) for c in (n_words, removed)]
            yield pa.RecordBatch.from_arrays([part.column(0), *counts, pa.array(kept, pa.binary())], schema.names)

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("n_words", "n_removed")]
    schema = T.StructType([*fields, T.StructField("kept", T.BinaryType())])
    return arrow_map(repeats.with_spans(rows, spans).select("doc_id", "raw", "spans"), batches, schema)
