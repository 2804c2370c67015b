"""JSON posts to flat rows, and what to do with the ones that do not parse."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import jsons, text
from postlens.sources import schemas

REASON_MALFORMED = "malformed"
REASON_MISSING = "missing"


def parsed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """Adds the struct column ``post``; an unusable record has a null ``post``.

    Both decoding levels are undone, so records encoded once and twice mix freely. The parsed record goes
    through ``explode`` of a one-element array: filters on its fields would otherwise be pushed below the
    parse by repeating it.
    """
    decoded = df.select("*", F.explode(F.array(jsons.unwrap(F.col(value)))).alias("_json"))
    attempt = decoded.select("*", F.explode(F.array(jsons.parse(F.col("_json"), schema))).alias("_post"))
    usable = jsons.is_usable(F.col("_json"), F.col("_post"))
    judged = attempt.select("*", F.explode(F.array(usable)).alias("_usable"))
    post = F.when(F.col("_usable"), F.col("_post").dropFields(jsons.CORRUPT))
    return judged.withColumn("post", post).drop("_json", "_post", "_usable")


def drop_malformed(df: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    return parsed(df, schema, value).where("post IS NOT NULL")


def required(df: DataFrame, paths: Sequence[str]) -> DataFrame:
    """Only the rows where every path is present."""
    for path in paths:
        df = df.where(F.col(path).isNotNull())
    return df


def failure_reason(paths: Sequence[str]) -> Column:
    """Why a parsed row cannot be used; null for a good row."""
    reason = F.when(F.col("post").isNull(), REASON_MALFORMED)
    for path in paths:
        reason = reason.when(F.col(path).isNull(), f"{REASON_MISSING} {path.removeprefix('post.')}")
    return reason


def judged(df: DataFrame, schema: T.StructType, paths: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Every row with ``post`` and, if it cannot be used, a ``reason``."""
    return parsed(df, schema, value).withColumn("reason", failure_reason(paths))


def route(
    df: DataFrame, schema: T.StructType, paths: Sequence[str] = (), value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows with a ``reason``)."""
    rows = judged(df, schema, paths, value)
    return rows.where("reason IS NULL").drop("reason"), rows.where("reason IS NOT NULL").drop("post")


def _columns(prefix: str, names: Mapping[str, str]) -> list[Column]:
    return [F.col(f"{prefix}.{path}").alias(name) for name, path in names.items()]


# Output column -> path in the record, per source.
TWEET_FIELDS = (
    "created_at", "source", "retweet_count", "id_str", "favorite_count", "id", "text", "lang",
    "quote_count", "timestamp_ms", "reply_count",
)
TWEET_LISTS = ("urls", "hashtags", "symbols")
FACEBOOK_FIELDS = {
    "created_time": "created_time", "comments_count": "comments.count", "group_id": "group_id",
    "from_name": "from.name", "from_id": "from.id", "id_fb": "id", "type_fb": "type",
    "likes_count": "likes.count", "status_type": "status_type", "name": "name", "link": "link",
    "message_fb": "message",
}
GPLUS_FIELDS = {
    "actor_id": "actor.id", "actor_display_name": "actor.displayName", "actor_url": "actor.url",
    "kind": "kind", "verb": "verb", "etag": "etag", "id_gplus": "id", "published": "published",
    "title": "title", "updated": "updated", "url_post": "url", "content": "object.content",
}
INSTAGRAM_FIELDS = {
    "full_name": "owner.full_name", "id_user": "owner.id", "username": "owner.username",
    "post_like": "post_like", "post_desc": "post_desc", "crawling_date": "crawling_date",
    "post_id": "post_id", "post_date": "post_date", "post_code": "post_code",
    "post_comment": "post_comment", "edge_media_tp_comment": "raw_data.edge_media_tp_comment.count",
    "tracking_token": "raw_data.tracking_token", "shortcode": "raw_data.shortcode",
    "edge_media_preview_like": "raw_data.edge_media_preview_like.count",
    "taken_at_timestamp": "raw_data.taken_at_timestamp", "keyword_id": "raw_data.keyword_id",
    "post_picture": "post_picture",
}
NEWS_FIELDS = {
    "media_category": "media_category", "news_id": "n_id", "file_content": "file_content",
    "file_name": "file_name", "news_link": "n_link", "table_name": "tablename",
    "news_date": "news_date", "worker_id": "worker_id", "result_content": "result_content",
}
REQUIRED = {
    "tweet": ("post.raw.text",),
    "facebook": ("post.message", "post.comments", "post.from"),
    "gplus": (
        "post.object.content", "post.actor.id", "post.actor.displayName", "post.actor.url", "post.kind",
        "post.verb", "post.etag", "post.id", "post.published", "post.title", "post.updated", "post.url",
    ),
    "instagram": ("post.post_desc", "post.raw_data"),
    "news": ("post.file_content",),
    "flat_tweet": ("post.text",),
    "compact": ("post.text",),
}
SCHEMAS = {
    "tweet": schemas.TWEET, "facebook": schemas.FACEBOOK, "gplus": schemas.GPLUS,
    "instagram": schemas.INSTAGRAM, "news": schemas.NEWS, "flat_tweet": schemas.FLAT_TWEET,
    "compact": schemas.COMPACT_POST,
}
TEXT_COLUMN = {
    "tweet": "text", "facebook": "message_fb", "gplus": "content", "instagram": "post_desc",
    "news": "news_text", "flat_tweet": "text", "compact": "text",
}


def _keep(df: DataFrame, keep: Sequence[str]) -> list[Column]:
    return [F.col(name) for name in keep]


def flatten_tweet(df: DataFrame, keep: Sequence[str] = (), separator: str = ",", ascii_only: bool = False) -> DataFrame:
    """Nested tweets; ``ascii_only`` drops non-ASCII characters from the text fields."""
    lists = [
        jsons.list_text(F.col(f"post.raw.entities.{name}"), separator).alias(name) for name in TWEET_LISTS
    ]
    flat = df.select(
        *_keep(df, keep),
        *_columns("post.raw", {name: name for name in TWEET_FIELDS}),
        *lists,
        F.col("post.raw.user.screen_name").alias("user_screen_name"),
        F.col("post.raw.user.id_str").alias("user_id"),
    )
    if ascii_only:
        texts = [f.name for f in flat.schema if f.dataType == T.StringType() and f.name not in keep]
        flat = flat.withColumns({name: text.ascii_strip(F.col(name)) for name in texts})
    return flat


def flatten_facebook(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*_keep(df, keep), *_columns("post", FACEBOOK_FIELDS))


def flatten_gplus(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*_keep(df, keep), *_columns("post", GPLUS_FIELDS))


def flatten_instagram(df: DataFrame, keep: Sequence[str] = (), separator: str = ",") -> DataFrame:
    hashtags = jsons.list_text(F.col("post.hashtags"), separator).alias("hashtags")
    return df.select(*_keep(df, keep), *_columns("post", INSTAGRAM_FIELDS), hashtags)


def flatten_news(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``news_text`` is the column to analyse: the extracted content, else the whole file."""
    analysed = F.coalesce("post.result_content", "post.file_content").alias("news_text")
    return df.select(*_keep(df, keep), *_columns("post", NEWS_FIELDS), analysed)


def flatten_flat_tweet(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*_keep(df, keep), "post.*")


def flatten_compact(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    return df.select(*_keep(df, keep), "post.*")


FLATTEN = {
    "tweet": flatten_tweet, "facebook": flatten_facebook, "gplus": flatten_gplus,
    "instagram": flatten_instagram, "news": flatten_news, "flat_tweet": flatten_flat_tweet,
    "compact": flatten_compact,
}


def compact_post(statuses: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``(id, name, text)`` of a status: the user's id and name, the text limited to ASCII."""
    return statuses.select(
        *_keep(statuses, keep),
        F.col("post.user.id_str").alias("id"),
        F.col("post.user.name").alias("name"),
        text.ascii_replace(F.col("post.text")).alias("text"),
    )


def project_strings(df: DataFrame, fields: Sequence[str], keep: Sequence[str] = (), value: str = "value") -> DataFrame:
    """A fixed list of top-level fields, all as text; malformed records are dropped."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    usable = drop_malformed(df, schema, value)
    return usable.select(*_keep(df, keep), *[F.col(f"post.{name}").alias(name) for name in fields])


def created_timestamp(created_at: Column) -> Column:
    """``Mon Apr 16 03:36:07 +0000 2018`` as a timestamp; the weekday is not needed to read it."""
    return F.try_to_timestamp(F.substring(created_at, 5, 26), F.lit("MMM dd HH:mm:ss Z yyyy"))


def epoch_millis(value: Column) -> Column:
    """A millisecond count kept as text, as a timestamp; null when it is no number."""
    return F.timestamp_millis(value.try_cast("bigint"))


def epoch_seconds(value: Column) -> Column:
    return F.timestamp_seconds(value.try_cast("bigint"))


def typed_tweets(flat: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Flat tweets cast to the typed table layout; a value that does not fit becomes null."""
    columns = []
    for field in schemas.TWEET_TABLE:
        source = F.col(field.name)
        value = created_timestamp(source) if field.name == "created_at" else source.try_cast(field.dataType)
        columns.append(value.alias(field.name))
    return flat.select(*_keep(flat, keep), *columns)


def typed_enriched(enriched: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """The 23-column typed row: tweet ids renamed, flags, counts and score cast."""
    typed = typed_tweets(enriched, [*keep, *schemas.ANALYSIS_COLUMNS])
    return typed.withColumnsRenamed({"id": "id_twitter", "id_str": "id_str_twitter"}).withColumn(
        "total_score", F.col("total_score").try_cast("double")
    )
