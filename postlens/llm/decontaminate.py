"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised to lower-case words. Windows of ten item words (or a shorter item as a
whole) are the patterns of an automaton over numbered words, which reads each text once; matches are mapped back to
words and to offsets in the original text. Row-local: documents are not shuffled.

An automaton has up to four states for each word of each window, about 50 bytes each; how many it may have is bounded. The benchmark is
read once, cut into parts that keep that bound and written; with several parts the documents are written between
them, so that no task has two automata at work.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import arrow_map
from postlens.session import shared_dir, written

WINDOW = 10
#: States that one automaton may have; 2 million are about 100 MB in a worker. A larger benchmark is dealt over
#: several automata, which read the documents one after the other.
AUTOMATON_STATES = 1 << 21
#: Signs of a word's code that are counted on: enough for 16 million words, more than so many states can hold.
CODE_WIDTH = 4
#: Windows of an item that stay together; a longer item is cut.
PIECE = 4096
#: Every byte of a word as it is but A-Z in lower case, every other byte a space.
FOLD = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20
    for c in range(256)
)
_AUTOMATA: dict[int, Machine] = {}


def folded_words(raw: bytes) -> list[bytes]:
    return raw.translate(FOLD).split()


@dataclass(frozen=True)
class Machine:
    """The automaton, the code of each word it knows, the codes' length, and per pattern its words and items.

    A word's number is written with 64 signs, other ones in each place: so a state has few successors, which are searched one
    by one, and no match begins within a word.
    """

    automaton: ahocorasick.Automaton
    codes: dict[bytes, str]
    width: int
    found: list[tuple[int, tuple[str, ...]]]

    @staticmethod
    def of(pieces: list[tuple[str, bytes]], window: int = WINDOW) -> Machine:
        """``pieces`` of items, words parted by single spaces."""
        known = dict.fromkeys(w for _, raw in pieces for w in raw.split())
        width = code_width(len(known))
        sign = lambda k, j: chr(1 + 64 * j + (k >> 6 * j & 63))
        codes = {w: "".join(sign(k, j) for j in range(width)) for k, w in enumerate(known)}
        owners = defaultdict(set)
        for item, raw in pieces:
            words = raw.split()
            for i in range(max(1, len(words) - window + 1) if words else 0):
                owners["".join(map(codes.__getitem__, words[i : i + window]))].add(item)
        automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for k, pattern in enumerate(owners):
            automaton.add_word(pattern, k)
        automaton.make_automaton()
        return Machine(automaton, codes, width, [(len(p) // width, tuple(sorted(items))) for p, items in owners.items()])


def code_width(words: int) -> int:
    """Signs that a code of one of so many words has."""
    return max(1, -(-max(1, words - 1).bit_length() // 6))


def cut(raw: bytes, window: int = WINDOW, piece: int = PIECE) -> list[bytes]:
    """An item as normalised pieces of at most ``piece`` windows, each window in one of them; none without words."""
    words = folded_words(raw)
    starts = range(0, max(1, len(words) - window + 1), piece) if words else ()
    return [b" ".join(words[i : i + piece + window - 1]) for i in starts]


def states(piece: bytes, window: int = WINDOW, width: int = CODE_WIDTH) -> int:
    """At most so many states does a piece add to an automaton whose codes have ``width`` signs."""
    n = piece.count(b" ") + 1
    return max(1, n - window + 1) * min(n, window) * width


def scan(machine: Machine, raw: bytes) -> tuple[int, list[tuple[int, int, tuple[str, ...]]]]:
    """Number of words, and ``(first word, end word, items)`` of each match."""
    words = folded_words(raw)
    if not words or not machine.found:
        return len(words), []
    code, width, found = machine.codes.get, machine.width, []
    other = "\0" * width
    for end, k in machine.automaton.iter("".join([code(w, other) for w in words])):
        n, items = machine.found[k]
        last = end // width
        found.append((last - n + 1, last + 1, items))
    return len(words), found


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def original_spans(raw: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of runs of words."""
    at = [m.span() for m in re.finditer(rb"[^ ]+", raw.translate(FOLD))]
    place = lambda b: len(raw[:b].decode("utf-8"))
    return [(place(at[a][0]), place(at[b - 1][1])) for a, b in runs]


def _scanner(shared, number: int, window: int):
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _AUTOMATA.get(number)
        if machine is None:
            _AUTOMATA.clear()
            machine = _AUTOMATA[number] = Machine.of(shared.value, window)
        for part in parts:
            texts = part.column("_raw").to_pylist()
            hits, items = part.column("_hits").to_pylist(), part.column("_items").to_pylist()
            counts, all_hits, all_items = [], [], []
            for raw, had, owned in zip(texts, hits, items, strict=True):
                n, found = scan(machine, raw or b"")
                runs = merged([*zip(had[::2], had[1::2], strict=True), *((a, b) for a, b, _ in found)]) if found else None
                counts.append(n)
                all_hits.append(had if runs is None else [x for run in runs for x in run])
                all_items.append(owned if not found else sorted({*owned, *(i for _, _, own in found for i in own)}))
            made = {
                "_n_words": pa.array(counts, pa.int64()),
                "_hits": pa.array(all_hits, pa.list_(pa.int32())),
                "_items": pa.array(all_items, pa.list_(pa.string())),
            }
            names = part.schema.names
            yield pa.RecordBatch.from_arrays([made.get(n, part.column(n)) for n in names], names=names)

    return batches


def _parts(benchmark: DataFrame, window: int, bound: int) -> tuple[DataFrame, int]:
    """``(part, item, piece)`` of ``benchmark``, written, and the number of parts: by hash, with room for uneven ones."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = [(i, p, states(p, window)) for i, raw in zip(*(c.to_pylist() for c in part.columns), strict=True) for p in cut(raw, window)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.binary(), pa.int64()))], ["item", "piece", "states"])

    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    items = benchmark.filter("text IS NOT NULL").select(item, F.col("text").cast("binary").alias("raw"))
    pieces = written(arrow_map(items, batches, "item string, piece binary, states long").distinct(), "benchmark-pieces")
    total = pieces.agg(F.coalesce(F.sum("states"), F.lit(0)).alias("n")).first().n
    parts = max(1, -(-5 * total // (4 * bound))) if total > bound else 1
    if parts == 1:
        return pieces.select(F.lit(0).alias("part"), "item", "piece"), 1
    path = shared_dir(benchmark.sparkSession, "benchmark-parts")
    pieces.select(F.pmod(F.xxhash64("item", "piece"), F.lit(parts)).cast("int").alias("part"), "item", "piece").write.partitionBy("part").parquet(path)
    return benchmark.sparkSession.read.schema("item string, piece binary, part int").parquet(path), parts


def scanned(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, bound: int = AUTOMATON_STATES) -> DataFrame:
    """``docs`` with _n_words, _hits (word runs as start, end, start, end, ...) and _items (ids, sorted).

    Null and empty texts have no words and no hits; null or wordless items have no window; items with one id
    count once; a null id counts as an empty one. Empty tables are allowed on both sides. Columns of ``docs``
    keep their names; the added ones start with ``_``. The driver holds one part of ``benchmark`` at a time, of about ``bound``
    states; each part is one automaton.
    """
    spark = docs.sparkSession
    pieces, parts = _parts(benchmark, window, bound)
    out = docs.withColumns(
        {
            "_raw": F.col("text").cast("binary"),
            "_n_words": F.lit(0).cast("long"),
            "_hits": F.array().cast("array<int>"),
            "_items": F.array().cast("array<string>"),
        }
    )
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in out.schema.fields])
    for k in range(parts):
        rows = pieces.filter(F.col("part") == k).select("item", "piece").collect()
        shared = spark.sparkContext.broadcast([(r.item, bytes(r.piece)) for r in rows])
        out = arrow_map(out, _scanner(shared, shared._jbroadcast.id(), window), schema)
        if k < parts - 1:
            out = written(out, "scanned")
    return out.drop("_raw")


def spans(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``(doc_id, start, end)``: character offsets of the hit runs in the original texts.

    doc_id keeps its type; rows with a null or repeated id give spans each. Documents without a hit, null and empty texts,
    and empty tables give none. Other columns are not looked at.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, starts, ends = [], [], []
            for key, raw, hits in zip(*(part.column(c).to_pylist() for c in ("doc_id", "_text", "_hits")), strict=True):
                for a, b in original_spans(raw, list(zip(hits[::2], hits[1::2], strict=True))):
                    ids.append(key), starts.append(a), ends.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, part.schema.field("doc_id").type), pa.array(starts, pa.int64()), pa.array(ends, pa.int64())],
                names=["doc_id", "start", "end"],
            )

    hit = scanned(docs.select("doc_id", "text"), benchmark, **options).filter("size(_hits) > 0")
    raw = hit.select("doc_id", F.col("text").cast("binary").alias("_text"), "_hits")
    return arrow_map(raw, batches, f"doc_id {dict(docs.dtypes)['doc_id']}, start long, end long")


def report(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """One row per document: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scanned(docs.select("doc_id", "text"), benchmark, **options)
    hit = F.aggregate(
        F.transform("_hits", lambda x, i: F.when(i % 2 == 0, -x).otherwise(x)), F.lit(0).cast("long"), lambda a, x: a + x
    )
    return found.select(
        "doc_id",
        F.col("_n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("_hits") > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit; same columns."""
    kept = scanned(docs, benchmark, **options).filter("size(_hits) = 0")
    return kept.select(*(kept[f"`{c}`"] for c in docs.columns))
