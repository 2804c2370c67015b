"""Token-id files: documents in id order as range-coded blocks, and their reader.

Documents are dealt by range of their id (and of a hash of the text, so that one id, or none, may have any number of
them), tokenised, closed with an end id and packed into blocks of whole documents.
A block has its own model and checksums, so any block can be read alone and a damaged one is noticed. Blocks are
the rows of a Parquet data set, which Spark commits file by file: part, block, the documents' ids and lengths, the
number of ids, and the coded bytes. The position of a block in the whole corpus follows from the counts.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import partial
from itertools import chain, pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm import rangecoder
from postlens.llm.common import arrow_map, measured

END_ID, BLOCK_IDS = 2, 1 << 21
#: Words whose ids a worker keeps; when there are more it starts anew.
KEPT_WORDS = 1 << 20
#: A character set between words that are tokenised together; words that hold it are tokenised alone.
BETWEEN = "\x01"
#: Bytes of text split at once, words tokenised in one call, new letter words from which calls of their own pay.
SPLIT_BYTES, TOGETHER, OWN_CALL = 3 << 22, 250, 64
#: The normalizer and the splitter for which words are known by their letters: any letters are one piece, lower-cased.
NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Latin letters whose normal form is the letter itself and whose lower case is one letter (that of U+0130 is two).
LATIN = r"A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}"
LATIN_WORD = re.compile("[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f]+")
#: Signs that are pieces apart from a Latin letter or digit before them, whatever follows; not those of added tokens.
TAIL = "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"
LONGEST_TAIL = 4
HAS_TAIL = f"[{LATIN}0-9][{re.escape(TAIL)}]{{1,{LONGEST_TAIL}}}$"
_TOKENIZERS: dict[int, WordEncoder] = {}


def _by_letters(definition: dict) -> bool:
    """Whether the tokenizer normalises and splits as above, every piece has one last id, and no added token is
    of letters only or holds a sign of ``TAIL``."""
    from tokenizers.pre_tokenizers import ByteLevel

    split, *level = (definition["pre_tokenizer"] or {}).get("pretokenizers") or [{}]
    model, ends = definition["model"], definition["model"].get("end_of_word_suffix")
    return (
        (definition["normalizer"] or {}).get("normalizers") == NORMALIZERS
        and split == {"type": "Split", "pattern": {"Regex": SPLIT}, "behavior": "Removed", "invert": True}
        and [(x["type"], x["add_prefix_space"], x["use_regex"]) for x in level] == [("ByteLevel", False, False)]
        and bool(ends)
        and all(c + e in model["vocab"] for c in ByteLevel.alphabet() for e in ("", ends))
        and not any(x["content"].isalpha() or set(x["content"]) & set(TAIL) for x in definition["added_tokens"])
    )


def _cut(ids: np.ndarray, first: np.ndarray, last: np.ndarray) -> list[bytes]:
    raw = ids.tobytes()
    return [raw[a:b] for a, b in zip((4 * first).tolist(), (4 * last).tolist(), strict=True)]


class WordEncoder:
    """Ids of texts, word by word.

    A tokenizer whose pieces never span white space gives a text the ids of its words one after the other, so each
    word is tokenised once and looked up from then on. Words end at ASCII white space, where no normalisation
    joins them either. Texts are split many at once, so that only their different words are looked up. New words are
    tokenised many at once, as one text with a mark between them: as a list of texts they cost more, and the
    tokenizer's threads for a list add to it.

    Where the tokenizer is known to allow it, signs at the end are cut from a word, and a word of letters needs no mark:
    it is one piece, whose last id shows. If it is of Latin letters, it is lower-cased here and goes to the
    same tokenizer without normalizer and regular expression, which would do no more to it.
    """

    def __init__(self, definition: bytes):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_buffer(definition)
        self.vocabulary = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.known: dict[str, bytes] = {}
        mark = self._ids(self.tokenizer, BETWEEN)
        self.mark = mark[0] if len(mark) == 1 else None
        self.ascii = self.latin = None
        parsed = json.loads(definition)
        if _by_letters(parsed):
            self.ascii = Tokenizer(self.tokenizer.model)
            self.ascii.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
            self.latin = Tokenizer(self.tokenizer.model)
            level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.latin.pre_tokenizer = pre_tokenizers.Sequence([self.ascii.pre_tokenizer, level])
            self.ends = np.zeros(self.vocabulary, bool)
            self.ends[[k for token, k in parsed["model"]["vocab"].items() if token.endswith(parsed["model"]["end_of_word_suffix"])]] = True

    @staticmethod
    def _ids(tokenizer, text: str) -> list[int]:
        return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _marked(self, fresh: list[str]) -> list[bytes]:
        """The ids of each word."""
        if self.mark is not None:
            ids = np.array(self._ids(self.tokenizer, f" {BETWEEN} ".join(fresh)), "<u4")
            cuts = np.flatnonzero(ids == self.mark)
            # A mark of its own in a word, or one that is no piece here, shows in their number.
            if len(cuts) == len(fresh) - 1:
                return _cut(ids, np.append(0, cuts + 1), np.append(cuts, len(ids)))
        return [np.array(self._ids(self.tokenizer, w), "<u4").tobytes() for w in fresh]

    def _letters(self, tokenizer, fresh: list[str]) -> list[bytes]:
        """The ids of each word; words of letters have a piece or more, so as many pieces as words are one for each."""
        ids = np.array(self._ids(tokenizer, " ".join(fresh)), "<u4")
        last = np.flatnonzero(self.ends[ids]) + 1
        return _cut(ids, np.append(0, last[:-1]), last) if len(last) == len(fresh) else self._marked(fresh)

    def _learn(self, fresh: list[str]) -> None:
        ascii_letters, latin, letters, others = [], [], [], fresh
        if self.ascii is not None and len(fresh) >= OWN_CALL:
            others = []
            for word in fresh:
                if not word.isalpha():
                    others.append(word)
                elif word.isascii():
                    ascii_letters.append(word)
                else:
                    (latin if LATIN_WORD.fullmatch(word) else letters).append(word)
        by_letters = (self.ascii, ascii_letters), (self.latin, latin), (self.tokenizer, letters)
        kinds = *((partial(self._letters, tokenizer), words) for tokenizer, words in by_letters), (self._marked, others)
        for tokenised, words in kinds:
            for k in range(0, len(words), TOGETHER):
                some = words[k : k + TOGETHER]
                self.known.update(zip(some, tokenised(some), strict=True))

    def _looked_up(self, words: pa.Array) -> pa.Array:
        """The ids of each word."""
        each = words.dictionary_encode()
        different = each.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.known.get, different))
        fresh = [w for w, ids in zip(different, found, strict=True) if ids is None and w]
        if len(self.known) + len(fresh) > KEPT_WORDS:
            self.known, fresh = {}, [w for w in different if w]
        if fresh:
            self._learn(fresh)
            found = [self.known[w] if ids is None and w else ids for w, ids in zip(different, found, strict=True)]
        return pa.array(found, pa.large_binary()).fill_null(b"").take(each.indices)

    def _parted(self, words: pa.Array) -> pa.Array:
        """The ids of each of these different words, by what is before its last signs and these."""
        tailed = pc.match_substring_regex(words, HAS_TAIL)
        stems = pc.if_else(tailed, pc.ascii_rtrim(words, TAIL), words)
        size, raw = pc.subtract(pc.binary_length(words), pc.binary_length(stems)), words.cast(pa.binary())
        tails = pa.scalar(b"", pa.binary())
        for k in range(1, LONGEST_TAIL + 1):
            tails = pc.if_else(pc.equal(size, k), pc.binary_slice(raw, -k), tails)
        stems = pc.if_else(pc.match_substring_regex(stems, f"^[{LATIN}]+$"), pc.utf8_lower(stems), stems)
        ids = self._looked_up(stems), self._looked_up(tails.cast(pa.string()))
        return pc.binary_join_element_wise(*ids, pa.scalar(b"", pa.large_binary()))

    def encode_all(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers; ``texts`` are bytes of UTF-8, none null."""
        parts = pc.ascii_split_whitespace(texts.cast(pa.string()))
        words = parts.flatten().dictionary_encode()
        if not len(words):
            return []
        found = self._parted if self.ascii is not None else self._looked_up
        ids = found(words.dictionary).take(words.indices)
        _, places, raw = ids.buffers()
        bounds = np.frombuffer(places, np.int64)[parts.offsets.to_numpy()]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), [None, pa.py_buffer(bounds), raw]).to_pylist()

    def encode(self, raw: bytes) -> bytes:
        """The ids of one text."""
        return self.encode_all(pa.array([raw], pa.binary()))[0]


def _handfuls(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Rows whose texts, in the second column, have about ``SPLIT_BYTES`` together; a longer text is alone or the last."""
    before = np.cumsum(pc.binary_length(part.column(1)).to_numpy().astype(np.int64)) // SPLIT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(before)) + 1).tolist(), part.num_rows]
    yield from (part.slice(a, b - a) for a, b in pairwise(cuts))


def encoder(shared, number: int) -> WordEncoder:
    """The worker's encoder of the tokenizer that ``shared`` holds: it comes with the task, from no file of the machine."""
    if number not in _TOKENIZERS:
        _TOKENIZERS.clear()
        _TOKENIZERS[number] = WordEncoder(shared.value)
    return _TOKENIZERS[number]


def _shared(spark: SparkSession, tokenizer: str):
    """The tokenizer file, read by the driver, as a broadcast of its few MB, and the broadcast's number."""
    shared = spark.sparkContext.broadcast(Path(tokenizer).read_bytes())
    return shared, shared._jbroadcast.id()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Write ``docs(doc_id, text)`` below ``path``, in ascending doc_id order, null ids first.

    Null and empty texts are an end id alone. Rows with one doc_id follow each other, by a hash of their text;
    repeated rows are all written. No rows give a data set without blocks. A block closes with the document that
    makes it ``block_ids`` long, so a very long text is one block. Further columns are not looked at. An end id
    within a text is no end: lengths are stored. ``tokenizer`` is a file that the driver reads.
    """
    shared, number = _shared(docs.sparkSession, tokenizer)
    schema = T.StructType(
        [
            T.StructField("part", T.IntegerType()), T.StructField("block", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)), T.StructField("lengths", T.ArrayType(T.LongType())),
            T.StructField("n_ids", T.LongType()), T.StructField("coded", T.BinaryType()),
        ]
    )
    end = np.array([end_id], "<u4").tobytes()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(shared, number)
        place, block = TaskContext.get().partitionId(), 0
        doc_ids, pieces, size = [], [], 0

        def closed() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(pieces), "<u4")
            row = ([place], [block], [doc_ids], [[len(p) // 4 for p in pieces]], [len(ids)], [rangecoder.encode(ids, words.vocabulary)])
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)], schema.names)

        for part in chain.from_iterable(map(_handfuls, parts)):
            types = [pa.int32(), pa.int32(), pa.list_(part.schema.field(0).type), pa.list_(pa.int64()), pa.int64(), pa.binary()]
            for key, ids in zip(part.column(0).to_pylist(), words.encode_all(part.column(1)), strict=True):
                pieces.append(ids + end)
                doc_ids.append(key)
                size += len(pieces[-1]) // 4
                if size >= block_ids:
                    yield closed()
                    doc_ids, pieces, size, block = [], [], 0, block + 1
        if pieces:
            yield closed()

    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("raw")
    ranged = docs.select("doc_id", raw, F.xxhash64("text").alias("rev")).repartitionByRange("doc_id", "rev")
    ordered = ranged.sortWithinPartitions("doc_id", "rev").select("doc_id", "raw")
    arrow_map(ordered, batches, schema).write.mode("overwrite").parquet(path)


def _starts(blocks: DataFrame) -> DataFrame:
    """``(part, block, start)``: ids in all blocks before. Blocks are summed within their part, parts as a whole."""
    counts = blocks.select("part", "block", "n_ids")
    parts = counts.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    first = parts.select("part", F.coalesce(F.sum("n").over(before(Window.orderBy("part"))), F.lit(0)).alias("first"))
    within = F.coalesce(F.sum("n_ids").over(before(Window.partitionBy("part").orderBy("block"))), F.lit(0))
    return counts.withColumn("within", within).join(first, "part").select("part", "block", (F.col("first") + F.col("within")).alias("start"))


def read(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """One row per written document, from the files alone: doc_id, start (ids of all documents before), n_tokens,
    and ``ids``, its ids as little-endian unsigned 32-bit integers. Damaged blocks raise a checksum error."""
    blocks = spark.read.parquet(path)
    shared, number = _shared(spark, tokenizer)
    kind = blocks.schema["doc_ids"].dataType.elementType
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("start", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = encoder(shared, number).vocabulary
        for part in parts:
            for row in range(part.num_rows):
                keys, lengths, start, coded = (part.column(k)[row] for k in range(4))
                ids = rangecoder.decode(coded.as_py(), vocabulary).tobytes()
                ends = np.cumsum(lengths.values.to_numpy())
                first = ends - lengths.values.to_numpy()
                pieces = [ids[4 * a : 4 * b] for a, b in zip(first.tolist(), ends.tolist(), strict=True)]
                columns = [keys.values, pa.array(start.as_py() + first), pa.array(ends - first), pa.array(pieces, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    placed = blocks.join(measured(_starts(blocks), "block-starts"), ["part", "block"]).select("doc_ids", "lengths", "start", "coded")
    return arrow_map(placed, batches, schema)

