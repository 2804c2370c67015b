"""The given tables as the feeds would deliver them: JSON posts, some encoded twice, some broken."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TWEET_ID_BASE = 985_000_000_000_000_000


def unless(modulus: int, remainder: int, value: Column) -> Column:
    """``value``, missing for one residue class of the document id."""
    return F.when(F.col("doc_id") % modulus != remainder, value)


def delivered(record: Column) -> Column:
    """Every second record is encoded twice; every eleventh is cut short. The record is made once per row."""

    def sent(made: Column) -> Column:
        twice = F.to_json(F.array(made))
        encoded = F.when(F.col("doc_id") % 2 == 1, F.substring(twice, F.lit(2), F.length(twice) - 2)).otherwise(made)
        cut = F.substring(made, F.lit(1), F.length(made) - 2)
        return F.when(F.col("doc_id") % 11 == 10, cut).otherwise(encoded)

    return F.get(F.transform(F.array(record), sent), F.lit(0))


def _as(name: str, value: Column) -> Column:
    return value.alias(name)


def tweets(docs: DataFrame) -> DataFrame:
    """``(doc_id, value)`` nested tweets; hashtags are objects instead of strings for every fifth."""
    doc_id = F.col("doc_id")

    def raw(hashtags: Column) -> Column:
        return F.to_json(
            F.struct(
                F.struct(
                    _as("created_at", F.concat(F.lit("Mon Apr 16 03:"), F.lpad((doc_id % 60).cast("string"), 2, "0"), F.lit(":07 +0000 2018"))),
                    _as("source", F.col("source")),
                    _as("retweet_count", (F.col("n_chars") % 97).cast("int")),
                    _as("id_str", (doc_id + TWEET_ID_BASE).cast("string")),
                    _as("favorite_count", unless(3, 0, (F.col("n_chars") % 13).cast("int"))),
                    _as("id", doc_id + TWEET_ID_BASE),
                    _as("text", unless(7, 3, F.col("text"))),
                    _as("lang", F.col("lang")),
                    _as("quote_count", F.lit(0)),
                    _as("timestamp_ms", (doc_id * 1000 + 1523849790000).cast("string")),
                    _as("reply_count", (doc_id % 5).cast("int")),
                    _as("entities", F.struct(
                        _as("urls", F.array(F.concat(F.lit("http://example.org/"), doc_id), F.col("source"))),
                        _as("hashtags", hashtags),
                        _as("symbols", F.array().cast("array<string>")),
                    )),
                    _as("user", F.struct(
                        _as("screen_name", F.concat(F.col("lang"), F.lit("é_"), doc_id)),
                        _as("id_str", unless(4, 2, (doc_id * 7).cast("string"))),
                    )),
                ).alias("raw")
            )
        )

    tags = F.array(F.col("lang"), F.col("source"))
    objects = F.transform(tags, lambda tag: F.struct(tag.alias("text")))
    record = F.when(doc_id % 5 == 0, raw(objects)).otherwise(raw(tags))
    return docs.select("doc_id", delivered(record).alias("value"))


def flat_tweets(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    record = F.to_json(
        F.struct(
            _as("created_at", F.concat(F.lit("Thu Apr 26 10:46:"), F.lpad((doc_id % 60).cast("string"), 2, "0"), F.lit(" +0000 2018"))),
            _as("id", doc_id + TWEET_ID_BASE),
            _as("id_str", (doc_id + TWEET_ID_BASE).cast("string")),
            _as("text", F.col("text")),
            _as("truncated", F.col("n_chars") > 280),
            _as("source", F.col("source")),
            _as("is_quote_status", doc_id % 9 == 0),
            _as("quoted_status_id", F.when(doc_id % 9 == 0, doc_id + 5)),
            _as("quoted_status_id_str", F.when(doc_id % 9 == 0, (doc_id + 5).cast("string"))),
            _as("retweet_count", (F.col("n_chars") % 97).cast("int")),
            _as("favorite_count", unless(3, 0, (F.col("n_chars") % 13).cast("int"))),
            _as("favorited", F.lit(False)),
            _as("retweeted", doc_id % 4 == 0),
            _as("lang", F.col("lang")),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


def statuses(docs: DataFrame) -> DataFrame:
    record = F.to_json(
        F.struct(
            F.col("doc_id").alias("id"),
            F.col("text"),
            F.struct(F.col("source").alias("id_str"), F.concat("lang", F.lit("_"), "source").alias("name")).alias("user"),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


def facebook(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    record = F.to_json(
        F.struct(
            _as("created_time", F.concat(F.lit("2018-04-13T09:49:"), F.lpad((doc_id % 60).cast("string"), 2, "0"), F.lit("+0000"))),
            _as("comments", unless(8, 5, F.struct((doc_id % 17).cast("int").alias("count")))),
            _as("group_id", unless(6, 1, F.concat(F.lit("g"), doc_id % 31))),
            _as("from", F.struct(F.col("source").alias("name"), (doc_id * 3).cast("string").alias("id"))),
            _as("id", F.concat(F.lit("fb"), doc_id)),
            _as("type", F.when(doc_id % 2 == 0, "status").otherwise("link")),
            _as("likes", unless(5, 4, F.struct((doc_id % 23).cast("int").alias("count")))),
            _as("status_type", F.lit("mobile_status_update")),
            _as("name", unless(4, 1, F.col("lang"))),
            _as("link", F.concat(F.lit("http://example.org/p?id="), doc_id)),
            _as("message", unless(7, 3, F.col("text"))),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


def gplus(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    record = F.to_json(
        F.struct(
            _as("object", F.struct(F.col("text").alias("content"))),
            _as("actor", F.struct(
                (doc_id * 11).cast("string").alias("id"),
                F.concat("lang", F.lit(" "), "source").alias("displayName"),
                F.concat(F.lit("http://example.org/u/"), doc_id).alias("url"),
            )),
            _as("kind", F.lit("plus#activity")),
            _as("verb", F.when(doc_id % 3 == 0, "share").otherwise("post")),
            _as("etag", F.concat(F.lit('"'), F.col("source"), F.lit('/x"'))),
            _as("id", F.concat(F.lit("z"), doc_id)),
            _as("published", F.lit("2018-04-13T02:49:09.000Z")),
            _as("title", unless(7, 3, F.concat_ws("/", "lang", "source"))),
            _as("updated", F.lit("2018-04-13T02:50:09.000Z")),
            _as("url", F.concat(F.lit("http://example.org/a/"), doc_id)),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


def instagram(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    number = (F.col("n_chars") % 41).cast("int")
    record = F.to_json(
        F.struct(
            _as("owner", unless(6, 2, F.struct(
                F.concat("lang", F.lit(" "), "source").alias("full_name"),
                (doc_id * 13).cast("string").alias("id"),
                unless(5, 2, F.col("source")).alias("username"),
            ))),
            _as("hashtags", unless(4, 3, F.array("lang", "source"))),
            _as("post_like", number),
            _as("post_desc", F.col("text")),
            _as("crawling_date", F.lit("2018-04-13 09:49:09")),
            _as("post_id", (doc_id + 17).cast("string")),
            _as("post_date", F.lit("2018-04-12 10:00:00")),
            _as("post_code", F.concat(F.lit("B"), doc_id)),
            _as("post_comment", (doc_id % 19).cast("int")),
            _as("raw_data", unless(7, 3, F.struct(
                F.struct((doc_id % 19).cast("int").alias("count")).alias("edge_media_tp_comment"),
                F.concat(F.lit("tok"), doc_id).alias("tracking_token"),
                F.concat(F.lit("B"), doc_id).alias("shortcode"),
                F.struct(number.alias("count")).alias("edge_media_preview_like"),
                (doc_id + 1523500000).alias("taken_at_timestamp"),
                (doc_id % 10).cast("string").alias("keyword_id"),
            ))),
            _as("post_picture", F.concat(F.lit("http://example.org/i/"), doc_id)),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


def news(docs: DataFrame) -> DataFrame:
    doc_id = F.col("doc_id")
    record = F.to_json(
        F.struct(
            _as("media_category", F.col("source")),
            _as("n_id", doc_id.cast("string")),
            _as("file_content", unless(7, 3, F.concat(F.lit("<br />"), F.col("text")))),
            _as("file_name", F.concat(F.lit("n"), doc_id, F.lit(".html"))),
            _as("n_link", F.concat(F.lit("http://example.org/n/"), doc_id)),
            _as("tablename", F.concat(F.lit("t_"), F.col("lang"))),
            _as("news_date", F.lit("2018-04-13")),
            _as("worker_id", (doc_id % 8).cast("string")),
            _as("result_content", unless(4, 2, F.col("text"))),
        )
    )
    return docs.select("doc_id", delivered(record).alias("value"))


FEEDS = {
    "tweet": tweets, "flat_tweet": flat_tweets, "facebook": facebook, "gplus": gplus,
    "instagram": instagram, "news": news,
}
