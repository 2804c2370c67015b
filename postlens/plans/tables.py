"""Rows as the per-source result tables hold them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import entities, text
from postlens.plans.enrich import Dictionaries
from postlens.sources import posts

# Table names and their columns in order, each with the flattened column it holds.
TABLES = {"facebook": "FB_NLP1", "gplus": "GPLUS_NLP", "instagram": "INSTAGRAM_NLP", "news": "NEWS_NLP", "tweet": "TWITTER_NLP1"}
SOURCE_COLUMNS = {
    "facebook": {
        "CREATED_TIME": "created_time", "COMMENTS_COUNT": "comments_count", "GROUP_ID": "group_id",
        "FROM_NAME": "from_name", "FROM_ID": "from_id", "ID": "id_fb", "TYPE": "type_fb",
        "LIKES_COUNT": "likes_count", "STATUS_TYPE": "status_type", "NAME": "name", "LINK": "link",
        "MESSAGE": "message_fb",
    },
    "gplus": {
        "ACTOR_DISPLAY_NAME": "actor_display_name", "ACTOR_ID": "actor_id", "ACTOR_URL": "actor_url",
        "KIND": "kind", "VERB": "verb", "ETAG": "etag", "ID": "id_gplus", "PUBLISHED": "published",
        "TITLE": "title", "UPDATED": "updated", "URL_POST": "url_post",
    },
    "instagram": {
        "FULL_NAME": "full_name", "ID_USER": "id_user", "USERNAME": "username", "HASHTAG": "hashtags",
        "POST_LIKE": "post_like", "POST_DESC": "post_desc", "CRAWLING_DATE": "crawling_date",
        "POST_ID": "post_id", "POST_DATE": "post_date", "POST_CODE": "post_code",
        "POST_COMMENT": "post_comment", "EDGE_MEDIA_TP_COMMENT": "edge_media_tp_comment",
        "TRACKING_TOKEN": "tracking_token", "SHORTCODE": "shortcode",
        "EDGE_MEDIA_PREVIEW_LIKE": "edge_media_preview_like",
        "TAKEN_AT_TIMESTAMP": "taken_at_timestamp", "KEYWORD_ID": "keyword_id",
        "POST_PICTURE": "post_picture",
    },
    "news": {
        "MEDIA_CATEGORY": "media_category", "NEWS_ID": "news_id", "FILE_CONTENT": "file_content",
        "FILE_NAME": "file_name", "NEWS_LINK": "news_link", "TABLE_NAME": "table_name",
        "NEWS_DATE": "news_date", "WORKER_ID": "worker_id", "RESULT_CONTENT": "result_content",
    },
    "tweet": {
        "CREATED_AT": "created_at", "SOURCE": "source", "RETWEET_COUNT": "retweet_count",
        "ID_STR": "id_str", "FAVORITE_COUNT": "favorite_count", "ID": "id", "TEXT": "text",
        "LANGUAGE": "lang", "QUOTE_COUNT": "quote_count", "TIMESTAMP_MS": "timestamp_ms",
        "REPLY_COUNT": "reply_count", "ENTITIES_URLS": "urls", "ENTITIES_HASHTAGS": "hashtags",
        "ENTITIES_SYMBOLS": "symbols", "USER_SCREEN_NAME": "user_screen_name", "USER_ID": "user_id",
    },
}
LABEL_POSITIVE = "Positive"
LABEL_NEGATIVE = "Negative"


def class_label(positive: Column, negative: Column) -> Column:
    """Two classes only: a tie is negative."""
    return F.when(positive > negative, LABEL_POSITIVE).otherwise(LABEL_NEGATIVE)


def flatten_for_table(parsed: DataFrame, source: str, keep: Sequence[str] = ()) -> DataFrame:
    """Flattened rows with lists joined by a space, as the tables want them."""
    flatten = posts.FLATTEN[source]
    if source in ("tweet", "instagram"):
        return flatten(parsed, keep, separator=" ")
    return flatten(parsed, keep)


def text_column(source: str) -> str:
    return "file_content" if source == "news" else posts.TEXT_COLUMN[source]


def table_rows(
    flat: DataFrame, source: str, dicts: Dictionaries, positive: str, negative: str, keep: Sequence[str] = ()
) -> DataFrame:
    """Columns of the source's table. ``positive`` and ``negative`` name the score columns of ``flat``."""
    words = text.with_word_tokens(flat, text_column(source), "_tokens")

    kinds = {kind: dicts.entities.get(kind, ((), ())) for kind in ("person", "company", "country")}
    places = entities.joined(entities.single_tokens("_tokens", dicts.gazetteer), " ")
    events = entities.joined(entities.by_stem("_tokens", dicts.event_stems, dicts.roots), " ")
    return entities.with_types(words, "_tokens", kinds, "_").select(
        *keep,
        *[F.col(name).alias(column) for column, name in SOURCE_COLUMNS[source].items()],
        F.format_string("%.6f", positive).alias("POSITIVE_SCORES"),
        F.format_string("%.6f", negative).alias("NEGATIVE_SCORES"),
        class_label(F.col(positive), F.col(negative)).alias("SENTIMENT"),
        places.alias("ENTITAS_CITY"),
        entities.joined(F.col("_person"), " ").alias("ENTITAS_PERSON"),
        entities.joined(F.col("_company"), " ").alias("ENTITAS_COMPANY"),
        events.alias("ENTITAS_EVENT_NEGATIF"),
        entities.joined(F.col("_country"), " ").alias("ENTITAS_COUNTRY"),
    )


def topic_value(df: DataFrame, key: str | None = None) -> DataFrame:
    """``(key, value)`` rows ready for a topic sink: the whole row as JSON."""
    value = F.to_json(F.struct(*[c for c in df.columns])).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def pipe_row(df: DataFrame, columns: Sequence[str], escape_breaks: bool = True) -> DataFrame:
    """One delimited line per row. Fields with a pipe, quote or line break are quoted, so every line
    reads back as exactly these columns."""
    cells = []
    for name in columns:
        cell = F.coalesce(F.col(name).cast("string"), F.lit(""))
        if escape_breaks:
            quoted = F.concat(F.lit('"'), F.replace(cell, F.lit('"'), F.lit('""')), F.lit('"'))
            cell = F.when(cell.rlike(r'[|"\r\n]'), quoted).otherwise(cell)
        cells.append(cell)
    return df.select(F.concat_ws("|", *cells).alias("line"))
