"""Corpus vocabulary jobs and vocabulary encoding."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from postlens.functions.stemming import stem_word
from postlens.operators.explode import items, positioned_items
from postlens.operators.lookup import replace_tokens, small_enough_to_broadcast
from postlens.session import shared_dir
from postlens.sources.dictionaries import LITERAL_LIMIT

# Fixed value: length of an encoded window.
SEQUENCE_LENGTH = 70
#: Most texts of a group that looks vectors up together, and ids whose vectors a task gathers at a time.
GROUP_TEXTS, LOOKED_UP = 8192, 1 << 16


def word_counts(df: DataFrame, words: str) -> DataFrame:
    """``(word, count)``; combined before the shuffle, so frequent words are cheap."""
    return items(df, words, "word").groupBy("word").agg(F.count("*").alias("count"))


def word_frequency(df: DataFrame, words: str) -> DataFrame:
    """``(word, count, probability)``; the total is a scalar subquery over the same counts."""
    counts = word_counts(df, words)
    total = counts.agg(F.sum("count")).scalar()
    return counts.withColumn("probability", F.col("count") / total)


def stem_vocabulary(df: DataFrame, words: str, roots: Iterable[str]) -> DataFrame:
    """``(word, stem, count)``: each distinct word is stemmed once."""
    return word_counts(df, words).select("word", stem_word("word", roots).alias("stem"), "count")


def token_ids(
    df: DataFrame, id_cols: Sequence[str], words: str, vocabulary: DataFrame, out: str = "ids",
    limit: int = LITERAL_LIMIT,
) -> DataFrame:
    """The vocabulary id of every token, 0 for an unknown one."""
    found = replace_tokens(df, id_cols, words, vocabulary, out, "word", "id", limit, lower=False, other="'0'")
    return found.withColumn(out, F.col(out).cast("array<bigint>"))


def encode_sequence(
    df: DataFrame, id_cols: Sequence[str], words: str, vocabulary: DataFrame, out: str = "ids",
    length: int = SEQUENCE_LENGTH, limit: int = LITERAL_LIMIT,
) -> DataFrame:
    """``(id_cols, window, out)``: the ids of a text in windows of ``length``, the model's fixed input size.

    Every token is in one window; the last window is padded with 0, and a text without tokens has one window
    of padding.
    """
    ids = token_ids(df.select(*id_cols, words), id_cols, words, vocabulary, "_ids", limit)
    count = f"greatest(cast(ceil(coalesce(size(_ids), 0) / {length}) AS int), 1)"
    padded = f"concat(coalesce(_ids, array()), array_repeat(0L, {length}))"
    windows = F.expr(
        f"get(transform(array({padded}), __p -> transform(sequence(0, {count} - 1), "
        f"__n -> slice(__p, __n * {length} + 1, {length}))), 0)"
    )
    return positioned_items(ids, windows, "window", out, id_cols)


def mean_by_group(df: DataFrame, by: Sequence[str], vector: str = "embedding") -> DataFrame:
    """Element-wise mean vector per group, merged map-side without exploding the elements."""
    mean = Summarizer.mean(array_to_vector(F.col(vector).cast("array<double>")))
    return df.groupBy(*by).agg(vector_to_array(mean).alias("mean"))


def pooled_embedding(
    df: DataFrame, id_cols: Sequence[str], ids: str, embeddings: DataFrame,
    vec_id: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``(id_cols, mean)``: mean embedding of each text's known ids, repeated ids counting each time; 0 is no
    word. A text without known ids has a null mean.

    Texts are written in groups of one file. Each distinct id of a group is looked up once and its vector sent to the group,
    where the texts are added up: what is shuffled grows with the groups, not with texts times vectors. A matrix of
    measured size is broadcast for the look-up, a larger one is joined.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, "pooled-ids")
    used = df.select(*id_cols, F.filter(F.col(ids).cast("array<bigint>"), lambda i: i != 0).alias("_ids"))
    used.write.option("maxRecordsPerFile", GROUP_TEXTS).parquet(path)
    texts = spark.read.schema(used.schema).parquet(path)
    grouped = texts.where(F.size("_ids") > 0).withColumn("_group", F.xxhash64("_metadata.file_path"))
    matrix = embeddings.select(F.col(vec_id).cast("bigint").alias("_id"), F.col(vector).alias("_vector")).where(F.col("_vector").isNotNull())
    small = small_enough_to_broadcast(matrix, F.size("_vector") * 8)
    wanted = items(grouped, "_ids", "_id", ["_group"]).distinct().join(F.broadcast(matrix) if small else matrix, "_id")
    wanted = wanted.select(F.col("_group").alias("_to"), "_id", "_vector")
    fields = [used.schema[c] for c in id_cols]
    schema = T.StructType([*fields, T.StructField("_mean", T.ArrayType(T.DoubleType())), T.StructField("_n", T.DoubleType())])
    sums = grouped.groupBy("_group").cogroup(wanted.groupBy("_to")).applyInArrow(_means(list(id_cols), to_arrow_schema(schema)), schema)
    # A group has one row for each of its texts; texts of one key may be in several.
    mean = Summarizer.mean(array_to_vector("_mean"), F.col("_n"))
    pooled = sums.groupBy(*id_cols).agg(vector_to_array(mean).alias("mean"))
    return texts.select(*id_cols).join(pooled, list(id_cols), "left")


def _means(id_cols: list[str], schema: pa.Schema) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """For one group: the mean vector of the ids of each text that has known ones, and how many."""

    def mean(texts: pa.Table, found: pa.Table) -> pa.Table:
        if not texts.num_rows or not found.num_rows:
            return schema.empty_table()
        lists = found["_vector"].combine_chunks()
        if lists.flatten().null_count:
            raise ValueError("vectors must not hold nulls")
        width = len(lists.flatten()) // len(lists)
        if pc.min_max(pc.list_value_length(lists)).as_py() != {"min": width, "max": width}:
            raise ValueError("vectors must be of one length")
        vectors = lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
        keys = found["_id"].to_numpy()
        order = np.argsort(keys, kind="stable")
        known, starts, copies = np.unique(keys[order], return_index=True, return_counts=True)
        vectors = np.add.reduceat(vectors[order], starts)
        lists = texts["_ids"].combine_chunks()
        rows = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        asked = lists.flatten().to_numpy(zero_copy_only=False)
        place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
        hit = known[place] == asked
        rows, place = rows[hit], place[hit]
        total = np.zeros((len(lists), width))
        for at in range(0, len(rows), LOOKED_UP):
            part = rows[at : at + LOOKED_UP]
            first = np.flatnonzero(np.diff(part, prepend=-1))
            total[part[first]] += np.add.reduceat(vectors[place[at : at + LOOKED_UP]], first)
        count = np.bincount(rows, weights=copies[place], minlength=len(lists))
        some = np.flatnonzero(count)
        means = (total[some] / count[some, None]).ravel()
        offsets = pa.array(np.arange(len(some) + 1) * width, pa.int32())
        columns = [texts[c].take(pa.array(some)).combine_chunks() for c in id_cols]
        return pa.Table.from_arrays([*columns, pa.ListArray.from_arrays(offsets, pa.array(means)), pa.array(count[some])], names=schema.names).cast(schema)

    return mean
