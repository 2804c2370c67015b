"""Language identification with bit-sliced Bloom filters of n-grams.

A language is learned as the set of n-grams of letters that are frequent in it and not much more frequent in another.
The sets of all languages are one table of bit masks: position p of the table has bit l set where the filter of language l
has its bit p. Three look-ups and an AND give every language that holds an n-gram, whatever their number. A
text's n-grams are counted per language; each count is corrected for what the filter lets pass by chance, and the
largest share decides.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import arrow_map
from postlens.llm.repeats import stirred
from postlens.session import written

ORDERS = (1, 2, 3, 4)
#: The fit looks at about so many distinct labelled texts of a language, chosen by hash, and learns the so many
#: languages that have most of them: one bit each of a long.
FIT_TEXTS, MAX_LANGUAGES = 2000, 64
#: An n-gram is a language's if it makes up this share of the language's n-grams of its length, and at least that part of
#: its share in any other language. So a language has at most 1 / LEAST n-grams of a length.
LEAST, PART = 1 / 20_000, 0.5
HASHES, POSITION_BITS, BITS_PER_GRAM = 3, 21, 16
UNKNOWN = "und"
#: Characters that are worked on at a time; bounds the arrays of a task whatever the length of a text.
SLICE = 1 << 18
_PRIME = np.uint64(0x9E3779B97F4A7C15)


def letters(text: Column) -> Column:
    """Runs of letters, lower-cased, with one space before, between and after; one space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), "[^\\p{L}]+", " ")


def gram_codes(points: np.ndarray, order: int) -> np.ndarray:
    """A 64-bit hash of each ``order`` consecutive code points."""
    n = max(0, len(points) - order + 1)
    with np.errstate(over="ignore"):
        code = points[:n].astype(np.uint64) + np.uint64(order)
        for k in range(1, order):
            code = code * _PRIME + points[k : k + n]
    return stirred(code)


def pieces(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts as code points, about SLICE at a time: the points, which text each piece is of, and where the pieces
    end. A piece of a longer text begins where the last n-gram that starts in the one before ends, so that an n-gram
    of any order starts in exactly one piece (see :func:`grams`)."""
    held, owner, size = [], [], 0
    for i, text in enumerate(texts):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        for at in range(0, max(1, len(points)), SLICE):
            piece = points[at : at + SLICE + ORDERS[-1] - 1]
            held.append(piece)
            owner.append(i)
            size += len(piece)
            if size >= SLICE:
                yield np.concatenate(held), np.array(owner), np.cumsum([len(p) for p in held])
                held, owner, size = [], [], 0
    if held:
        yield np.concatenate(held), np.array(owner), np.cumsum([len(p) for p in held])


def grams(points: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of a slice that lie within one piece and start in its own part, and their piece. A space alone is
    none."""
    begins = np.concatenate(([0], ends[:-1]))
    place = np.arange(max(0, len(points) - order + 1))
    piece = np.searchsorted(ends, place, side="right")
    counts = place <= np.minimum(ends - order, begins + SLICE - 1)[piece]
    if order == 1:
        counts &= points != ord(" ")
    return gram_codes(points, order)[counts], piece[counts]


def _counts(rows: DataFrame) -> DataFrame:
    """``(language, order, code, n)`` of ``rows(language int, text)``, added up within each batch only."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            spoken = part.column(0).to_numpy()
            for points, owner, ends in pieces(part.column(1).to_pylist()):
                for order in ORDERS:
                    codes, piece = grams(points, ends, order)
                    of = spoken[owner[piece]]
                    for language in np.unique(of):
                        found, n = np.unique(codes[of == language], return_counts=True)
                        same = [pa.array(np.full(len(found), v, np.int32)) for v in (language, order)]
                        yield pa.RecordBatch.from_arrays([*same, pa.array(found.view(np.int64)), pa.array(n)], ["language", "order", "code", "n"])

    return arrow_map(rows, batches, "language int, order int, code long, n long")


@dataclass(frozen=True)
class LanguageFilters:
    """The bit-sliced filters: ``masks[p]`` holds the languages whose filter has bit p; names in bit order."""

    names: tuple[str, ...]
    masks: np.ndarray

    @property
    def chance(self) -> np.ndarray:
        """Per language how often an n-gram that it doesn't hold passes its filter."""
        one = np.uint64(1)
        filled = np.array([float(((self.masks.astype(np.uint64) >> np.uint64(b)) & one).mean()) for b in range(len(self.names))])
        return filled**HASHES

    def holding(self, codes: np.ndarray) -> np.ndarray:
        """Masks of the languages that hold each n-gram."""
        last = np.uint64(len(self.masks) - 1)
        found = self.masks[(codes & last).astype(np.int64)]
        for k in range(1, HASHES):
            found = found & self.masks[((codes >> np.uint64(k * POSITION_BITS)) & last).astype(np.int64)]
        return found

    def counted(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text how many n-grams each language holds, and how many there are."""
        hits, totals = np.zeros((len(texts), len(self.names)), np.int64), np.zeros(len(texts), np.int64)
        kind = self.masks.dtype
        for points, owner, ends in pieces(texts):
            for order in ORDERS:
                codes, piece = grams(points, ends, order)
                found, of = self.holding(codes), owner[piece]
                totals += np.bincount(of, minlength=len(texts))
                if kind == np.uint8:
                    base = of.min() if len(of) else 0
                    table = np.bincount((of - base) * 256 + found, minlength=0)
                    table = np.pad(table, (0, -len(table) % 256)).reshape(-1, 256)
                    bits = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")[:, : len(self.names)]
                    hits[base : base + len(table)] += table @ bits.astype(np.int64)
                else:
                    for b in range(len(self.names)):
                        hits[:, b] += np.bincount(of[(found >> kind.type(b)) & kind.type(1) != 0], minlength=len(texts))
        return hits, totals

    def decide(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per text the position of the language, and its share of all corrected counts."""
        hits, totals = self.counted(texts)
        chance = self.chance
        held = np.maximum(hits - totals[:, None] * chance, 0) / np.maximum(1 - chance, 1e-9)
        whole = held.sum(axis=1)
        best = held.argmax(axis=1)
        return best, np.divide(held[np.arange(len(texts)), best], whole, out=np.zeros(len(texts)), where=whole > 0).clip(0, 1)


def fitted(labelled: DataFrame, texts: int = FIT_TEXTS) -> LanguageFilters | None:
    """Filters of ``labelled(language string, text)``; None without a labelled text that has letters.

    Rows with a null language or no letters teach nothing. Of each language about ``texts`` distinct texts are looked
    at, all if there are fewer. Copies count once, so no group of them outweighs the rest.
    """
    plain = labelled.filter("language IS NOT NULL AND text RLIKE '\\\\p{L}'").withColumn("rev", F.xxhash64("text"))
    known = plain.groupBy("language").agg(F.approx_count_distinct("rev", 0.02).alias("texts"))
    chosen = known.orderBy(F.desc("texts"), "language").limit(MAX_LANGUAGES).collect()
    if not chosen:
        return None
    names = tuple(sorted(r.language for r in chosen))
    rate = {r.language: min(1.0, texts / max(1, r.texts)) for r in chosen}
    quotas = [(n, i, int(rate[n] * (1 << 31))) for i, n in enumerate(names)]
    spark = labelled.sparkSession
    some = plain.join(F.broadcast(spark.createDataFrame(quotas, "language string, spot int, quota long")), "language")
    some = some.filter(F.pmod(F.xxhash64("rev"), F.lit(1 << 31)) < F.col("quota")).dropDuplicates(["spot", "rev"])
    counts = _counts(some.select(F.col("spot").alias("language"), letters(F.col("text")).alias("text")))
    counts = written(counts.groupBy("language", "order", "code").agg(F.sum("n").alias("n")), "n-grams")
    totals = counts.groupBy("language", "order").agg(F.sum("n").alias("total"))
    shares = counts.join(F.broadcast(totals), ["language", "order"]).withColumn("share", F.col("n") / F.col("total")).filter(F.col("share") >= LEAST)
    most = shares.groupBy("order", "code").agg(F.max("share").alias("most"))
    grams = written(shares.join(most, ["order", "code"]).filter(F.col("share") >= PART * F.col("most")).select("language", "code"), "features")
    largest = grams.groupBy("language").count().agg(F.max("count")).first()[0] or 1
    bits = min(POSITION_BITS, max(10, (BITS_PER_GRAM * largest - 1).bit_length()))
    last = (1 << bits) - 1
    spots = F.array(*(F.shiftrightunsigned("code", k * POSITION_BITS).bitwiseAND(last).cast("int") for k in range(HASHES)))
    bit = F.expr("shiftleft(1L, language)")
    rows = grams.select(F.explode(spots).alias("spot"), bit.alias("mask")).groupBy("spot").agg(F.bit_or("mask").alias("mask")).toArrow()
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if 8 * t().itemsize >= len(names))
    masks = np.zeros(1 << bits, kind)
    masks[rows.column("spot").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64).astype(kind)
    return LanguageFilters(names, masks)


def predicted(docs: DataFrame, filters: LanguageFilters | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of ``docs`` with lang_pred and score, from ``text`` alone.

    lang_pred is "und" with score 0 if the text is null or has no letter, or no language was learned. A text none of
    whose n-grams any language holds goes to the first language by name, with score 0; so do ties to the first of them.
    """
    kept = {f"_in_{i}": name for i, name in enumerate(keep)}
    rows = docs.select(*(F.col(name).alias(c) for c, name in kept.items()), letters(F.col("text")).alias("_text"))
    names = [*kept, "lang_pred", "score"]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(part.num_columns - 1).to_pylist()
            silent = np.array([not t.strip(" ") for t in texts], bool)
            spoken, score = np.array([UNKNOWN] * len(texts), object), np.zeros(len(texts))
            if filters and len(texts):
                best, share = filters.decide(texts)
                spoken = np.where(silent, UNKNOWN, np.array(filters.names, object)[best])
                score = np.where(silent, 0.0, share)
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(spoken, pa.string()), pa.array(score)], names)

    types = dict(rows.dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), "lang_pred string", "score double"])
    return arrow_map(rows, batches, schema).withColumnsRenamed(kept)


def held_out(doc_id: Column) -> Column:
    """A quarter of all ids, by crc32 of the id as text (a null id as empty text): never learned from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs(doc_id, text, lang)``.

    Learned from the rows that are not held out and have a language. Repeated rows and ids are rows of their
    own, predicted alike. No rows give no rows. Further columns are not looked at.
    """
    marked = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    filters = fitted(marked.filter(~F.col("held_out")).select(F.col("lang").alias("language"), "text"))
    return predicted(marked, filters, "doc_id", "held_out")
