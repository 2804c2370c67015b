"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm import chat, debruijn, decontaminate, langid, mixing, negatives, quality, sharding, simhash, suffixes
from postlens.llm import tokenfiles, urls, whitening
from postlens.llm.common import table
from postlens.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SHARDS = 8
TOKENIZER = "word_bpe_49k.json"


def query(function):
    QUERIES[function.__name__] = function
    return function


@query
def op1_preference_format(spark, sf_dir):
    return chat.preferences(chat.contrasted(table(spark, sf_dir, "conversations")))


@query
def op2_quality_rules(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.judged(docs, labels).drop("n_lines", "lang")


@query
def op3_suffix_dedup(spark, sf_dir):
    found = suffixes.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op4_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = urls.judged(pages, urls.listed_by_host(pages, "url"))
    return found.select("page_id", "host", "path", "rule", "verdict")


@query
def op5_flow_sharding(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    path = shared_dir(spark, "shards")
    sharding.store(docs.withColumn("shard", sharding.source_shard(SHARDS)), path, SHARDS, 0)
    sharding.rewrite(sharding.read_layout(spark, path, 0, docs.schema), path, SHARDS, 1, previous=0)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    # What is asked of a text is worked out before rows are numbered, so that no text is shuffled for that.
    rows = sharding.read_layout(spark, path, 1, docs.schema).select(
        "doc_id", "text", "shard", sharding.row_bytes(F.col("text")).alias("size"), crc.alias("text_crc32"),
        sharding.source_shard(SHARDS).cast("int").alias("old_shard"),
    )
    return sharding.numbered(rows).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard",
    )


@query
def op6_simhash(spark, sf_dir):
    return simhash.groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op7_mix_sources(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.with_copies(docs)
    return mixed.select(
        "doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"), (F.col("_size") * F.col("_copies")).alias("taken"),
    )


@query
def op8_debruijn_dedup(spark, sf_dir):
    found = debruijn.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


@query
def op9_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_token_files(spark, sf_dir):
    import public_tokenizers

    path, tokenizer = shared_dir(spark, "token-files"), public_tokenizers.path(TOKENIZER)
    tokenfiles.write(table(spark, sf_dir, "documents").select("doc_id", "text"), path, tokenizer)
    return tokenfiles.read(spark, path, tokenizer).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op11_whiten(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op12_language_id(spark, sf_dir):
    return langid.identified(table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark, sf_dir):
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark, sf_dir):
    from corpus_pipeline import run

    return run(spark, sf_dir)
