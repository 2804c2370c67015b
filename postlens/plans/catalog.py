"""The registered queries: every operator over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import entities, jsons, sentiment, stemming, text
from postlens.operators import classify, counts, filters, keywords, linear, spelling, vocabulary
from postlens.operators.explode import items, positioned_items
from postlens.operators.latest import latest_by_key
from postlens.operators.lookup import replace_tokens
from postlens.plans import joined, landed, tables
from postlens.plans.enrich import enrich, slang_tokens, with_normalized, with_sentiment
from postlens.plans.samples import (
    DICTIONARIES, ENTITIES, EVENT_STEMS, GAZETTEER, NEGATIVE, POSITIVE, ROOTS, VOCABULARY, large_tables,
)
from postlens.session import shared_dir, written
from postlens.sources import archives, dictionaries, inference, offsets, posts, schemas, streams
from postlens.sources.scans import spread, table
from postlens.streaming import jobs, sinks
from postlens.streaming.latest_table import LatestTable

Query = Callable[[SparkSession, str], DataFrame]
BATCH_SIZE = 100
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", *(columns or ("text",))), "doc_id")


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "conversations").select("conv_id", "turn", "text"), "conv_id", "turn")


def _document_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text.with_word_tokens(_documents(spark, sf_dir), "text", "tokens").select("doc_id", "tokens")


def _joined(values: Column, name: str, separator: str = "|") -> Column:
    return F.array_join(values, separator).alias(name)


def _stamp(moment: Column) -> Column:
    """A moment as text in UTC, whatever the session's zone."""
    return F.date_format(F.to_utc_timestamp(moment, F.current_timezone()), "yyyy-MM-dd HH:mm:ss")


# Sources and dictionaries ------------------------------------------------------------------------


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Document lines in one total order, as a dictionary file would be read."""
    split = positioned_items(_documents(spark, sf_dir), F.split("text", "\n"), "n", "line", ["doc_id"])
    return split.select(F.struct("doc_id", "n").alias("line_no"), "line")


@query("lexicon_load")
def lexicon_load(spark, sf_dir):
    return dictionaries.word_set(_lines(spark, sf_dir))


@query("lexicon_load_raw")
def lexicon_load_raw(spark, sf_dir):
    return dictionaries.raw_word_set(_lines(spark, sf_dir))


@query("slang_dict")
def slang_dict(spark, sf_dir):
    return dictionaries.slang_table(_lines(spark, sf_dir))


@query("gazetteer_load")
def gazetteer_load(spark, sf_dir):
    return dictionaries.gazetteer(_lines(spark, sf_dir), sep=None)


@query("entity_dictionary_load")
def entity_dictionary_load(spark, sf_dir):
    named = _lines(spark, sf_dir).select(
        F.concat(F.lit("dir/"), F.when(F.col("line_no.n") % 2 == 0, "b_").otherwise("i_"),
                 F.element_at(F.array(*map(F.lit, ("person", "job_title", "company"))),
                              (F.col("line_no.doc_id") % 3 + 1).cast("int")), F.lit(".txt")).alias("path"),
        "line",
    )
    return dictionaries.entity_dictionary(named)


@query("ascii_strip")
def ascii_strip(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", text.ascii_strip(F.col("text")).alias("text_ascii"))


@query("ascii_replace")
def ascii_replace(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", text.ascii_replace(F.col("text")).alias("text_ascii"))


def _sent(record: Column) -> Column:
    """A record as it arrives: every second one encoded twice, every seventh cut, every thirteenth missing."""
    event, twice = F.col("event_id"), F.to_json(F.array(record))
    return (
        F.when(event % 13 == 12, None)
        .when(event % 7 == 6, F.substring(record, F.lit(1), F.length(record) - 1))
        .when(event % 2 == 1, F.substring(twice, F.lit(2), F.length(twice) - 2))
        .otherwise(record)
    )


def _props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.props`` as they arrive."""
    return table(spark, sf_dir, "events").select("event_id", "event_type", _sent(F.col("props")).alias("value"))


def _undeclared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose records disagree: k is a number, or a text beside a user; some hold an object with a number that
    is whole or not, some a null."""
    k = F.get_json_object("props", "$.k")
    named = F.to_json(F.struct(F.concat(F.lit("x"), k).alias("k"), F.col("user_id").alias("user")))
    nested = F.to_json(F.struct(k.cast("long").alias("k"), F.struct("event_type", F.floor("value").alias("v")).alias("of")))
    bare = F.concat(F.lit('{"k": null, "of": {"v": 1e1}, "tags": ["a", '), k, F.lit("]}"))
    record = F.element_at(F.array("props", named, nested, bare), (F.pmod("event_id", F.lit(4)) + 1).cast("int"))
    events = table(spark, sf_dir, "events").select("event_id", F.explode(F.array(record)).alias("record"))
    return events.select("event_id", _sent(F.col("record")).alias("value"))


@query("inferred_profile")
def inferred_profile(spark, sf_dir):
    """Paths of a feed without a declared schema, with the type all records fit."""
    return inference.profile(_undeclared(spark, sf_dir))


@query("inferred_profile_tweet")
def inferred_profile_tweet(spark, sf_dir):
    return inference.profile(landed.tweets(_all_documents(spark, sf_dir)))


@query("inferred_profile_facebook")
def inferred_profile_facebook(spark, sf_dir):
    return inference.profile(landed.facebook(_all_documents(spark, sf_dir)))


@query("inferred_rows")
def inferred_rows(spark, sf_dir):
    """The same feed as typed rows of the inferred schema."""
    rows = inference.read_inferred(_undeclared(spark, sf_dir), keep=["event_id"])
    return rows.select(
        "event_id", "post.k", "post.user", F.col("post.of.event_type").alias("event_type"), F.col("post.of.v").alias("v"),
        F.array_join("post.tags", "|").alias("tags"), F.col("post").isNotNull().alias("usable"),
    )


PROPS = schemas.record({"k": schemas.LONG})


@query("json_unwrap")
def json_unwrap(spark, sf_dir):
    decoded = posts.parsed(_props(spark, sf_dir), PROPS)
    return decoded.select("event_id", F.col("post.k").alias("k"))


@query("drop_malformed")
def drop_malformed(spark, sf_dir):
    return posts.drop_malformed(_props(spark, sf_dir), PROPS).select("event_id", F.col("post.k").alias("k"))


@query("required_fields")
def required_fields(spark, sf_dir):
    feed = posts.drop_malformed(landed.facebook(_all_documents(spark, sf_dir)), schemas.FACEBOOK)
    return posts.required(feed, posts.REQUIRED["facebook"]).select("doc_id", F.col("post.id").alias("id_fb"))


@query("quarantine")
def quarantine(spark, sf_dir):
    feed = landed.facebook(_all_documents(spark, sf_dir))
    _, bad = posts.route(feed, schemas.FACEBOOK, posts.REQUIRED["facebook"])
    return bad.select("doc_id", "reason")


@query("project_strings")
def project_strings(spark, sf_dir):
    feed = landed.flat_tweets(_all_documents(spark, sf_dir))
    fields = ["id", "text", "retweet_count", "truncated", "favorite_count"]
    return posts.project_strings(feed, fields, keep=["doc_id"])


@query("archive_split")
def archive_split(spark, sf_dir):
    """Three objects per row, one of them with a text that ends like a boundary, parted by nothing, a space or a
    line break, taken apart again."""
    docs = _documents(spark, sf_dir, "text", "lang")
    gap = F.element_at(F.array(*map(F.lit, ("", " ", "\n"))), (F.pmod("doc_id", F.lit(3)) + 1).cast("int"))
    tricky = F.to_json(F.struct(F.concat("lang", F.lit("}{")).alias("lang"), F.struct("doc_id").alias("of")))
    value = F.concat(F.to_json(F.struct("doc_id", "text")), gap, tricky, gap, F.lit("{}"), F.to_json(F.struct("doc_id")))
    parts = archives.split_archives(docs.withColumn("value", value), "value", ["doc_id"])
    return parts.select("doc_id", "pos", F.md5(F.get_json_object("value", "$.text")).alias("text_hash"),
                        F.get_json_object("value", "$.lang").alias("lang"),
                        F.get_json_object("value", "$.of.doc_id").alias("of_doc"))


@query("archive_files")
def archive_files(spark, sf_dir):
    """Documents as archive files without separators, in which many texts end like a boundary, read back."""
    docs = _documents(spark, sf_dir, "text", "lang")
    # Between two records stands an empty object, as the writer needs something to put there.
    record = F.to_json(F.struct("doc_id", F.concat("lang", F.lit("}{")).alias("lang"), F.when(F.col("doc_id") % 3 == 0, F.concat("text", F.lit("}{"))).otherwise(F.col("text")).alias("text"), F.array(F.lit("}{"), "lang").alias("tags")))
    path = shared_dir(spark, "archive")
    docs.select(record.alias("value")).write.option("lineSep", "{}").text(path)
    found = archives.archive_statuses(spark, path).where("value <> '{}'")
    return found.select(
        F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"), F.get_json_object("value", "$.lang").alias("lang"),
        F.md5(F.get_json_object("value", "$.text")).alias("text_hash"), F.get_json_object("value", "$.tags[0]").alias("tag"),
    )


# Flatteners --------------------------------------------------------------------------------------


def _all_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir, "text", "lang", "source", "n_chars")


def _usable(spark: SparkSession, sf_dir: str, source: str) -> DataFrame:
    feed = landed.FEEDS[source](_all_documents(spark, sf_dir))
    good, _ = posts.route(feed, posts.SCHEMAS[source], posts.REQUIRED[source])
    return good


def _flattened(source: str) -> Query:
    return lambda spark, sf_dir: posts.FLATTEN[source](_usable(spark, sf_dir, source), ["doc_id"])


for _source in landed.FEEDS:
    QUERIES[f"flatten_{_source}"] = _flattened(_source)


@query("flatten_tweet_ascii")
def flatten_tweet_ascii(spark, sf_dir):
    return posts.flatten_tweet(_usable(spark, sf_dir, "tweet"), ["doc_id"], ascii_only=True)


@query("list_join")
def list_join(spark, sf_dir):
    good = _usable(spark, sf_dir, "tweet")
    hashtags = F.col("post.raw.entities.hashtags")
    return good.select("doc_id", jsons.list_text(hashtags, ",").alias("comma"), jsons.list_text(hashtags, " ").alias("space"))


@query("compact_post")
def compact_post(spark, sf_dir):
    feed = landed.statuses(_all_documents(spark, sf_dir))
    return posts.compact_post(posts.drop_malformed(feed, schemas.STATUS), ["doc_id"])


@query("typed_row")
def typed_row(spark, sf_dir):
    flat = posts.flatten_flat_tweet(_usable(spark, sf_dir, "flat_tweet"), ["doc_id"])
    typed = posts.typed_tweets(flat, ["doc_id"])
    return typed.withColumn("created_at", _stamp(F.col("created_at")))


@query("post_times")
def post_times(spark, sf_dir):
    """The three ways posts carry a time, read as timestamps."""
    tweets = posts.flatten_tweet(_usable(spark, sf_dir, "tweet"), ["doc_id"])
    taken = F.col("doc_id") + 1523500000
    stamps = {
        "created": posts.created_timestamp(F.col("created_at")),
        "sent": posts.epoch_millis(F.col("timestamp_ms")),
        "taken": posts.epoch_seconds(taken),
    }
    return tweets.select("doc_id", *[_stamp(moment).alias(name) for name, moment in stamps.items()])


@query("typed_enriched_row")
def typed_enriched_row(spark, sf_dir):
    flat = posts.flatten_flat_tweet(_usable(spark, sf_dir, "flat_tweet"), ["doc_id"])
    typed = posts.typed_enriched(enrich(flat, DICTIONARIES), ["doc_id"])
    return typed.withColumn("created_at", _stamp(F.col("created_at")))


# Text --------------------------------------------------------------------------------------------


@query("clean_text")
def clean_text(spark, sf_dir):
    return _documents(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("tokenize_ws")
def tokenize_ws(spark, sf_dir):
    words = text.split_words(F.col("text"))
    by_space = text.split_on_space(F.col("text"))
    return _documents(spark, sf_dir).select(
        "doc_id", _joined(words, "tokens"), F.size(words).alias("n"), F.size(by_space).alias("n_by_space")
    )


@query("tokenize_words")
def tokenize_words(spark, sf_dir):
    tokens = _document_tokens(spark, sf_dir)
    return tokens.select("doc_id", _joined(F.col("tokens"), "joined", " "), F.size("tokens").alias("n"))


@query("regex_words")
def regex_words(spark, sf_dir):
    words = text.regex_words(F.col("text"))
    return _documents(spark, sf_dir).select("doc_id", _joined(words, "joined", " "), F.size(words).alias("n"))


@query("normalize_slang")
def normalize_slang(spark, sf_dir):
    words = _documents(spark, sf_dir).withColumn("words", text.split_words(F.col("text")))
    return words.select("doc_id", _joined(slang_tokens("words", DICTIONARIES.slang), "formal", " "))


@query("stem_tokens")
def stem_tokens(spark, sf_dir):
    words = _documents(spark, sf_dir).withColumn("words", stemming.stem_tokens_of(F.col("text")))
    return vocabulary.stem_vocabulary(words, "words", ROOTS)


@query("normalize_text")
def normalize_text(spark, sf_dir):
    return with_normalized(_documents(spark, sf_dir), "text", DICTIONARIES).select("doc_id", "normalized")


# Sentiment ---------------------------------------------------------------------------------------


def _cleaned_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(spark, sf_dir).withColumn("words", text.split_cleaned(text.clean_text(F.col("text"))))


@query("sentiment_label")
def sentiment_label(spark, sf_dir):
    pos, neg = sentiment.hit_counts("words", POSITIVE, NEGATIVE)
    return _cleaned_words(spark, sf_dir).select("doc_id", pos.alias("pos"), neg.alias("neg")).select(
        "doc_id", "pos", "neg", sentiment.label(F.col("pos"), F.col("neg")).alias("sentiment")
    )


@query("sentiment_score")
def sentiment_score(spark, sf_dir):
    return with_sentiment(_cleaned_words(spark, sf_dir), "words", DICTIONARIES).select(
        "doc_id", "sentiment", "total_score"
    )


@query("word_polarity")
def word_polarity(spark, sf_dir):
    counted = vocabulary.word_counts(_cleaned_words(spark, sf_dir), "words")
    return counted.select("word", "count", sentiment.word_polarity("word", POSITIVE, NEGATIVE).alias("polarity"))


# Entities ----------------------------------------------------------------------------------------


def _entities(*kinds: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        found = entities.with_types(_document_tokens(spark, sf_dir), "tokens", {k: ENTITIES[k] for k in kinds})
        return found.select("doc_id", *[_joined(F.col(kind), kind, ",") for kind in kinds])

    return run


for _kind in ("person", "company", "country", "location"):
    QUERIES[f"entities_{_kind}"] = _entities(_kind)
QUERIES["entities_all"] = _entities(*ENTITIES)


@query("entities_city_unigram")
def entities_city_unigram(spark, sf_dir):
    found = entities.single_tokens("tokens", GAZETTEER)
    return _document_tokens(spark, sf_dir).select("doc_id", _joined(found, "city", " "))


@query("entities_negative_event")
def entities_negative_event(spark, sf_dir):
    found = entities.by_stem("tokens", EVENT_STEMS, ROOTS)
    return _document_tokens(spark, sf_dir).select("doc_id", _joined(found, "eventNegatif", ","))


@query("geo_lookup")
def geo_lookup(spark, sf_dir):
    found = _document_tokens(spark, sf_dir).withColumn("found", entities.begin_inside("tokens", *ENTITIES["location"]))
    places = found.withColumn("places", entities.located("found", GAZETTEER))
    return places.select(
        "doc_id",
        _joined(F.col("places.place"), "city", ","),
        _joined(F.col("places.lat"), "lat_city", ","),
        _joined(F.col("places.long"), "long_city", ","),
    )


@query("enrich_posts")
def enrich_posts(spark, sf_dir):
    return enrich(_documents(spark, sf_dir), DICTIONARIES).drop("text")


def _more_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many further dictionary entries as the corpus has different words."""
    tokens = items(_documents(spark, sf_dir), text.split_words(F.col("text")), "word").distinct()
    return written(tokens.select(F.concat(F.lit("zq0"), F.md5("word")).alias("word")), "more-words")


@query("enrich_posts_large")
def enrich_posts_large(spark, sf_dir):
    """The enrichment with dictionaries too large for literals."""
    tables_ = large_tables(_more_words(spark, sf_dir))
    return enrich(_documents(spark, sf_dir), tables_, id_cols=["doc_id"]).drop("text")


@query("geo_lookup_large")
def geo_lookup_large(spark, sf_dir):
    found = _document_tokens(spark, sf_dir).withColumn("found", entities.begin_inside("tokens", *ENTITIES["location"]))
    tables_ = large_tables(_more_words(spark, sf_dir))
    places = joined.with_located(found.drop("tokens"), ["doc_id"], "found", tables_, "places")
    return places.select(
        "doc_id",
        _joined(F.col("places.place"), "city", ","),
        _joined(F.col("places.lat"), "lat_city", ","),
        _joined(F.col("places.long"), "long_city", ","),
    )


@query("normalize_slang_large")
def normalize_slang_large(spark, sf_dir):
    """A formal spelling for every word of the corpus of five letters or more."""
    docs = _documents(spark, sf_dir).withColumn("words", text.split_words(F.col("text")))
    known = items(docs, "words", "word").select(F.lower("word").alias("key")).where(F.length("key") >= 5).distinct()
    slang = written(known.withColumn("value", F.concat(F.lit("#"), "key", F.lit(" x"))), "large-slang")
    formal = replace_tokens(docs, ["doc_id"], "words", slang, "formal")
    return formal.select("doc_id", F.md5(F.array_join("formal", " ")).alias("formal_hash"))


# Vocabulary, spelling, model ---------------------------------------------------------------------


@query("word_frequency")
def word_frequency(spark, sf_dir):
    words = _documents(spark, sf_dir).select(text.regex_words(F.col("text")).alias("words"))
    return vocabulary.word_frequency(words, "words")


def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vocabulary.word_counts(_cleaned_words(spark, sf_dir), "words")


@query("spell_correct")
def spell_correct(spark, sf_dir):
    words = items(_turns(spark, sf_dir), text.split_cleaned(text.clean_text(F.col("text"))), "word")
    return spelling.correct_words(words, _frequencies(spark, sf_dir))


@query("corrected_sentiment")
def corrected_sentiment(spark, sf_dir):
    turns = _turns(spark, sf_dir).withColumn("words", text.split_cleaned(text.clean_text(F.col("text"))))
    corrected = spelling.correct_text(
        turns, ["conv_id", "turn"], "words", _frequencies(spark, sf_dir), "corrected"
    )
    normalized = with_normalized(corrected, "corrected", DICTIONARIES)
    scored = with_sentiment(
        normalized.withColumn("tokens", text.split_cleaned(F.col("normalized"))), "tokens", DICTIONARIES
    )
    return scored.select("conv_id", "turn", "corrected", "sentiment", "total_score")


def _vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(VOCABULARY.items()), "word STRING, id INT")


@query("encode_sequence")
def encode_sequence(spark, sf_dir):
    encoded = vocabulary.encode_sequence(_cleaned_words(spark, sf_dir), ["doc_id"], "words", _vocabulary(spark))
    return encoded.select("doc_id", "window", _joined(F.col("ids").cast("array<string>"), "ids", " "))


@query("encode_sequence_large")
def encode_sequence_large(spark, sf_dir):
    """Ids from a vocabulary of every word of the corpus; a word's id is a checksum of it."""
    words = written(_cleaned_words(spark, sf_dir).select("doc_id", "words"), "cleaned-words")
    counted = vocabulary.word_counts(words, "words")
    known = written(counted.select("word", F.conv(F.substring(F.md5("word"), 1, 8), 16, 10).cast("bigint").alias("id")), "large-vocabulary")
    encoded = vocabulary.encode_sequence(words, ["doc_id"], "words", known)
    return encoded.select("doc_id", "window", F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_hash"))


def _dimensions(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per vector element, rounded for comparison; ``+ 0`` turns a negative zero positive."""
    rows = positioned_items(df, "mean", "dim", "value", keys)
    return rows.select(*keys, "dim", (F.round("value", 6) + F.lit(0.0)).alias("mean"))


@query("embedding_mean")
def embedding_mean(spark, sf_dir):
    return _dimensions(vocabulary.mean_by_group(table(spark, sf_dir, "embeddings"), ["label"]), ["label"])


@query("embedding_pool")
def embedding_pool(spark, sf_dir):
    """Documents without a known word keep one row, without dimension and mean."""
    ids = vocabulary.token_ids(_cleaned_words(spark, sf_dir).select("doc_id", "words"), ["doc_id"], "words", _vocabulary(spark))
    pooled = vocabulary.pooled_embedding(ids, ["doc_id"], "ids", table(spark, sf_dir, "embeddings"))
    rows = pooled.select("doc_id", F.posexplode_outer("mean").alias("dim", "value"))
    return rows.select("doc_id", "dim", (F.round("value", 6) + F.lit(0.0)).alias("mean"))


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return _cleaned_words(spark, sf_dir).select("doc_id", "words").join(labels, "doc_id")


@query("classifier_score")
def classifier_score(spark, sf_dir):
    model = classify.fit(_labelled(spark, sf_dir), "words", "quality")
    docs = _cleaned_words(spark, sf_dir).select("doc_id", "words")
    return classify.with_sentiment(classify.score(model, docs, ["doc_id"], "words")).drop("words")


@query("classifier_accuracy")
def classifier_accuracy(spark, sf_dir):
    """Measured on the quarter of the labelled documents that the model hasn't seen."""
    part = F.pmod(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(4))
    labelled = _labelled(spark, sf_dir).withColumn("part", part)
    model = classify.fit(labelled.where("part <> 0"), "words", "quality")
    held = classify.score(model, labelled.where("part = 0"), ["doc_id"], "words")
    return classify.accuracy(held.withColumn("predicted", (F.col("positive") > F.col("negative")).cast("int")), "predicted", "quality")


def _pooled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mean embedding of each document's words, every word of the documents having a vector by its hash."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    size = vectors.agg(F.max("vec_id")).first()[0] or 0
    ids = F.transform("words", lambda w: F.pmod(F.xxhash64(w), F.lit(size)) + 1)
    docs = _cleaned_words(spark, sf_dir).select("doc_id", ids.alias("ids"))
    return written(vocabulary.pooled_embedding(docs, ["doc_id"], "ids", vectors), "pooled")


@query("linear_score")
def linear_score(spark, sf_dir):
    """Every document by a linear readout of its mean embedding."""
    pooled = _pooled(spark, sf_dir)
    model = linear.fit(pooled.join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id"), "mean", "quality")
    return classify.with_sentiment(linear.score(model, pooled, "mean")).drop("mean")


@query("linear_accuracy")
def linear_accuracy(spark, sf_dir):
    """The same on the quarter of the labelled documents that the readout hasn't seen."""
    part = F.pmod(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 8), 16, 10).cast("bigint"), F.lit(4))
    labelled = _pooled(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id").withColumn("part", part)
    model = linear.fit(labelled.where("part <> 0"), "mean", "quality")
    return linear.accuracy(linear.score(model, labelled.where("part = 0"), "mean"), "quality")


@query("label_accuracy")
def label_accuracy(spark, sf_dir):
    """Agreement of the two label columns: the accuracy measure on data that needs no model."""
    labels = table(spark, sf_dir, "labels").withColumn("clean", 1 - F.col("toxic"))
    return classify.accuracy(labels, "clean", "quality")


# Counts ------------------------------------------------------------------------------------------


@query("batch_counts")
def batch_counts(spark, sf_dir):
    per_batch = counts.per_interval(table(spark, sf_dir, "events").select("ts"), "ts", "10 seconds")
    return per_batch.select(F.date_format("batch_start", "yyyy-MM-dd HH:mm:ss").alias("batch_start"), "records")


def _batched_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a sequence of micro-batches, split the way the running job splits."""
    batch = F.floor(F.col("doc_id") / BATCH_SIZE).alias("batch_id")
    return _documents(spark, sf_dir).select(batch, text.split_on_space(F.col("text")).alias("words"))


@query("class_counts")
def class_counts(spark, sf_dir):
    return counts.class_totals(_batched_words(spark, sf_dir), "words", POSITIVE, NEGATIVE)


@query("class_counts_history")
def class_counts_history(spark, sf_dir):
    return counts.class_totals(
        _batched_words(spark, sf_dir), "words", POSITIVE, NEGATIVE, by=["batch_id"], records="records"
    )


@query("running_counts")
def running_counts(spark, sf_dir):
    history = counts.class_totals(_batched_words(spark, sf_dir), "words", POSITIVE, NEGATIVE, by=["batch_id"])
    return counts.running_totals(history, "batch_id")


@query("class_union")
def class_union(spark, sf_dir):
    tokens = items(_documents(spark, sf_dir), text.split_on_space(F.col("text")), "word")
    pairs = counts.class_union(tokens, "word", POSITIVE, NEGATIVE)
    return pairs.groupBy("label", "hit").agg(F.count("*").alias("pairs"))


@query("dedup_by_id")
def dedup_by_id(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    latest = latest_by_key(events, "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", "value")


@query("posts_by_datetime")
def posts_by_datetime(spark, sf_dir):
    per_hour = counts.per_datetime(table(spark, sf_dir, "events"), "ts", "hour", ["event_type"])
    return per_hour.withColumn("posted_at", F.date_format("posted_at", "yyyy-MM-dd HH:mm:ss"))


@query("keyword_filter")
def keyword_filter(spark, sf_dir):
    return filters.by_keyword(_documents(spark, sf_dir, "text", "lang"), "Attion", "en").select("doc_id")


@query("keywords_any")
def keywords_any(spark, sf_dir):
    return filters.by_any_keyword(_documents(spark, sf_dir), ["keit", "eaux", "ción"]).select("doc_id")


@query("keywords_table")
def keywords_table(spark, sf_dir):
    """Keywords of any number, from a table: names, endings of words, and phrases of benchmark items."""
    names = table(spark, sf_dir, "nation").select(F.col("n_name").alias("keyword"))
    items_ = table(spark, sf_dir, "benchmark").select(F.split("text", " ").alias("w"))
    phrases = items_.select(F.array_join(F.slice("w", 2, 3), " ").alias("keyword"))
    endings = items_.select(F.upper(F.substring(F.get("w", F.lit(4)), -4, 4)).alias("keyword"))
    return keywords.mentions(_documents(spark, sf_dir), ["doc_id"], names.unionByName(phrases).unionByName(endings))


@query("id_watermark")
def id_watermark(spark, sf_dir):
    return filters.id_marks(table(spark, sf_dir, "events"), ["event_type"], "event_id")


@query("id_backfill")
def id_backfill(spark, sf_dir):
    """Everything up to the mark all event types have reached."""
    events = table(spark, sf_dir, "events").select("event_id", "event_type")
    reached = filters.id_marks(events, ["event_type"], "event_id").agg(F.min("high_id"))
    return filters.up_to_id(events, reached.scalar(), "event_id")


@query("preview")
def preview(spark, sf_dir):
    enriched = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return counts.preview(enriched, [F.desc("n_chars"), F.col("doc_id")], 20)


# Sinks -------------------------------------------------------------------------------------------


def _table_rows(source: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        flat = tables.flatten_for_table(_usable(spark, sf_dir, source), source, ["doc_id"])
        words = flat.withColumn("_w", text.split_cleaned(text.clean_text(F.col(tables.text_column(source)))))
        model = classify.fit(_labelled(spark, sf_dir), "words", "quality")
        scored = classify.score(model, words, ["doc_id"], "_w").withColumnsRenamed({"positive": "_positive", "negative": "_negative"})
        return tables.table_rows(scored, source, DICTIONARIES, "_positive", "_negative", ["doc_id"])

    return run


for _source in tables.TABLES:
    QUERIES[f"db_row_{_source}"] = _table_rows(_source)


@query("pipe_row")
def pipe_row(spark, sf_dir):
    scored = with_sentiment(
        _cleaned_words(spark, sf_dir), "words", DICTIONARIES
    ).withColumn("length", F.size("words"))
    return tables.pipe_row(scored, ["doc_id", "text", "sentiment", "length"])


@query("to_topic_value")
def to_topic_value(spark, sf_dir):
    docs = _documents(spark, sf_dir, "text", "lang")
    sent = tables.topic_value(docs, "doc_id")
    return sent.select(
        F.col("key").alias("msg_key"),
        F.md5(F.get_json_object("value", "$.text")).alias("text_hash"),
        F.get_json_object("value", "$.lang").alias("lang"),
    )


@query("json_sink")
def json_sink(spark, sf_dir):
    """Flat rows written as JSON by source and batch, the batch written twice, read back."""
    out = shared_dir(spark, "json-sink")
    docs = _documents(spark, sf_dir, "text", "lang")
    for _ in range(2):
        sinks.write_json(docs, out, 7, "documents")
    return streams.read_json(spark, out, "doc_id BIGINT, text STRING, lang STRING, source_name STRING, batch_id INT")


@query("pipe_sink")
def pipe_sink(spark, sf_dir):
    out = shared_dir(spark, "pipe-sink")
    for _ in range(2):
        sinks.write_pipe(_documents(spark, sf_dir, "text", "lang"), out, 3)
    return streams.read_delimited(spark, out, "doc_id BIGINT, text STRING, lang STRING, batch_id INT", sep="|")


@query("post_csv_sink")
def post_csv_sink(spark, sf_dir):
    out = shared_dir(spark, "csv-sink")
    scored = with_sentiment(_cleaned_words(spark, sf_dir), "words", DICTIONARIES)
    rows = scored.select("doc_id", F.lit("user").alias("u"), F.lit("1").alias("i"),
                         text.ascii_replace(F.col("text")).alias("t"), "sentiment")
    for _ in range(2):
        sinks.write_post_csv(rows, out, rows.columns, 5)
    schema = "doc_id BIGINT, screen_name STRING, user_id STRING, sentence STRING, sentiment STRING, batch_id INT"
    return streams.read_delimited(spark, out, schema, header=True)


def _table_name(spark: SparkSession) -> str:
    return f"postlens_{uuid.uuid4().hex}"


@query("table_sink")
def table_sink(spark, sf_dir):
    """Two batches into a managed table, each written twice."""
    name, docs = _table_name(spark), table(spark, sf_dir, "documents").select("doc_id", "lang")
    for batch in (1, 1, 2, 2):
        sinks.append_table(docs.where(F.pmod("doc_id", F.lit(2)) + 1 == batch), name, batch)
    return spark.table(name)


@query("external_table_sink")
def external_table_sink(spark, sf_dir):
    """A table over a folder, replaced as a whole; read from the folder."""
    name, out = _table_name(spark), shared_dir(spark, "external-table")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang")
    sinks.overwrite_table(docs.where("doc_id < 10"), name, out)
    sinks.overwrite_table(docs, name, out)
    return spark.read.parquet(out)


@query("pipe_record")
def pipe_record(spark, sf_dir):
    """The compact post with its nine analysis columns as one delimited line."""
    posts_ = _documents(spark, sf_dir, "text", "lang", "source").select(
        F.col("doc_id").alias("id"), F.concat_ws("_", "lang", "source").alias("name"), "text"
    )
    enriched = enrich(posts_, DICTIONARIES)
    return tables.pipe_row(enriched, ["id", "name", "text", *schemas.ANALYSIS_COLUMNS])


# Streams -----------------------------------------------------------------------------------------


def _landed(df: DataFrame, purpose: str, key: str, batches: int = 4) -> DataFrame:
    """A stream of the rows in a few micro-batches, each landed in a file for every core, or for every split of its share of
    the input where that is more: a file is written by one task, and a small one is read by one."""
    path, spark = shared_dir(df.sparkSession, purpose), df.sparkSession
    splits = df.rdd.getNumPartitions()
    files = max(spark.sparkContext.defaultParallelism, -(-splits // batches)) if splits > 1 else 1
    df.repartition(batches * files, key).write.parquet(path)
    return streams.landed_stream(spark, path, df.schema, "parquet", files_per_trigger=files)


def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _landed(table(spark, sf_dir, "documents"), "landed-documents", "doc_id")


@query("stream_running_counts")
def stream_running_counts(spark, sf_dir):
    """The streaming aggregation run over the table, its last state read back."""
    base = shared_dir(spark, "running")
    words = _document_stream(spark, sf_dir).select(text.split_on_space(F.col("text")).alias("words"))
    totals = jobs.running_class_counts(words, "words", POSITIVE, NEGATIVE)

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{base}/state")

    jobs.start(totals, write, f"{base}/checkpoint", mode="complete").awaitTermination()
    return spark.read.parquet(f"{base}/state")


@query("stream_enrich")
def stream_enrich(spark, sf_dir):
    """Tweets through the enrichment job: judged, enriched, written as JSON per batch, read back."""
    base = shared_dir(spark, "enrich")
    arrived = F.timestamp_seconds(F.col("doc_id") * 3600).alias("timestamp")
    feed = landed.tweets(_document_stream(spark, sf_dir)).select("value", arrived)
    write = jobs.enrichment_writer("tweet", DICTIONARIES, f"{base}/out")
    jobs.start(feed, write, f"{base}/checkpoint").awaitTermination()
    schema = """id BIGINT, sentiment STRING, total_score DOUBLE, person STRING, city STRING, lat_city STRING,
        reason STRING, status STRING, arrival_date STRING"""
    back = streams.read_json(spark, f"{base}/out", schema)
    return back.select("id", "sentiment", "total_score", "person", "city", "lat_city", "reason", "status", F.col("arrival_date").alias("ingest_date"))


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of two topics with three partitions each; some never arrive, some come twice, and in one
    partition whole stretches are missing."""
    event = F.col("event_id")
    dealt = table(spark, sf_dir, "events").select(
        F.when(event % 2 == 0, "weblogs").otherwise("twitter-stream").alias("topic"), F.floor(event / 2 % 3).cast("int").alias("partition"),
        F.floor(event / 6).alias("offset"), event.alias("event_id"),
    )
    lost = (event % 97 == 5) | ((F.col("partition") == 2) & (F.floor(F.col("offset") / 50) % 3 == 1))
    times = F.when(event % 50 == 7, 2).when(event % 331 == 1, 4).otherwise(1)
    return dealt.where(~lost).withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).drop("_copy")


@query("offset_ledger")
def offset_ledger(spark, sf_dir):
    """What was read of each partition: ranges, repeats and gaps, kept batch by batch."""
    out, messages = shared_dir(spark, "ledger"), _messages(spark, sf_dir)
    write = jobs.ledger_writer(out)
    for batch in range(3):
        write(messages.where(F.floor(F.col("offset") / 40) % 3 == batch), batch)
    return jobs.read_ledger(spark, out)


@query("offset_resume")
def offset_resume(spark, sf_dir):
    return offsets.resume_points(offsets.ledger(offsets.ranges(_messages(spark, sf_dir))))


@query("compacted_output")
def compacted_output(spark, sf_dir):
    """Documents that seven batches wrote by language, in several files each, compacted across batches."""
    base = shared_dir(spark, "compacted")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    for batch in range(7):
        part = docs.where(F.pmod("doc_id", F.lit(7)) == batch)
        sinks.write_json(part, f"{base}/in", batch, "documents", ["lang", "batch_id"])
    sinks.compact(spark, f"{base}/in", f"{base}/out", "doc_id BIGINT, text STRING, lang STRING, batch_id INT", ["lang"])
    back = streams.read_json(spark, f"{base}/out", "doc_id BIGINT, text STRING, lang STRING, batch_id INT")
    return back.select("doc_id", "lang", "batch_id", F.md5("text").alias("text_hash"))


@query("latest_table")
def latest_table(spark, sf_dir):
    """The latest event of each user, kept over nine batches of events, of which one comes twice."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    kept = LatestTable(spark, shared_dir(spark, "latest"), "user_id", ["ts", "event_id"], buckets=4, fan=3)
    for batch in (*range(6), 2, *range(6, 9)):
        kept.apply(events.where(F.pmod("event_id", F.lit(9)) == batch), batch)
    return kept.read().select("user_id", "event_id", "event_type", _stamp(F.col("ts")).alias("at"))


@query("stream_raw_archive")
def stream_raw_archive(spark, sf_dir):
    """Texts as messages, archived unparsed."""
    base = shared_dir(spark, "raw")
    feed = _document_stream(spark, sf_dir).select(F.col("text").alias("value"))
    jobs.raw_archive(feed, f"{base}/out", f"{base}/checkpoint").awaitTermination()
    archived = streams.read_json(spark, f"{base}/out", "value STRING")
    return archived.select(F.md5("value").alias("value_hash"))


@query("stream_class_history")
def stream_class_history(spark, sf_dir):
    base = shared_dir(spark, "history")
    words = _document_stream(spark, sf_dir).select(text.split_on_space(F.col("text")).alias("words"))
    write = jobs.history_writer("words", POSITIVE, NEGATIVE, f"{base}/out")
    jobs.start(words, write, f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("label").agg(
        F.sum("count").alias("count"), F.sum("records").alias("records")
    )


@query("stream_first_seen")
def stream_first_seen(spark, sf_dir):
    """Texts seen for the first time; a year of event time covers all repeats here."""
    base = shared_dir(spark, "first")
    at = F.timestamp_seconds(F.col("doc_id") + 1_523_500_000).alias("at")
    fresh = jobs.first_seen(_document_stream(spark, sf_dir).select(F.md5("text").alias("post"), at), "post", "at", "365 days")

    def write(batch: DataFrame, batch_id: int) -> None:
        sinks.write_parquet(batch, f"{base}/out", batch_id)

    jobs.start(fresh, write, f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/out").select("post")


@query("stream_bounded_archive")
def stream_bounded_archive(spark, sf_dir):
    """The archive as a job at an interval, stopped after a while."""
    base = shared_dir(spark, "bounded")
    feed = _document_stream(spark, sf_dir).select(F.col("text").alias("value"))
    job = jobs.raw_archive(feed, f"{base}/out", f"{base}/checkpoint", "1 second")
    job.processAllAvailable()
    jobs.run_bounded(job, 1)
    return streams.read_json(spark, f"{base}/out", "value STRING").select(F.md5("value").alias("value_hash"))


@query("stream_latest")
def stream_latest(spark, sf_dir):
    """The latest event of each user over several micro-batches."""
    base = shared_dir(spark, "latest")
    events = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type", "value")
    write = jobs.latest_writer("user_id", ["ts", "event_id"], f"{base}/out")
    jobs.start(_landed(events, "landed-events", "event_id"), write, f"{base}/checkpoint").awaitTermination()
    latest = jobs.latest_posts(spark, f"{base}/out", "user_id", ["ts", "event_id"])
    return latest.select("user_id", "event_id", "event_type", "value")
