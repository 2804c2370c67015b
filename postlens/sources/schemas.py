"""Declared record types per source. Nothing is inferred at run time."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import types as T

TEXT, INT, LONG, FLAG, TIME = T.StringType(), T.IntegerType(), T.LongType(), T.BooleanType(), T.TimestampType()


def record(fields: Mapping[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def texts(*names: str) -> dict[str, T.DataType]:
    return {name: TEXT for name in names}


COUNT = record({"count": INT})

# Field names and nesting as the feeds deliver them. Lists are declared as text so that
# their JSON survives whatever the elements are.
TWEET = record({
    "raw": record({
        "created_at": TEXT, "source": TEXT, "retweet_count": INT, "id_str": TEXT, "favorite_count": INT,
        "id": LONG, "text": TEXT, "lang": TEXT, "quote_count": INT, "timestamp_ms": TEXT,
        "reply_count": INT, "entities": record(texts("urls", "hashtags", "symbols")),
        "user": record(texts("screen_name", "id_str")),
    }),
})
FLAT_TWEET = record({
    "created_at": TEXT, "id": LONG, "id_str": TEXT, "text": TEXT, "truncated": FLAG, "source": TEXT,
    "is_quote_status": FLAG, "quoted_status_id": LONG, "quoted_status_id_str": TEXT,
    "retweet_count": INT, "favorite_count": INT, "favorited": FLAG, "retweeted": FLAG, "lang": TEXT,
})
STATUS = record({"id": LONG, "text": TEXT, "user": record(texts("id_str", "name"))})
COMPACT_POST = record(texts("id", "name", "text"))
FACEBOOK = record({
    "created_time": TEXT, "comments": COUNT, "group_id": TEXT, "from": record(texts("name", "id")),
    "id": TEXT, "type": TEXT, "likes": COUNT, "status_type": TEXT, "name": TEXT, "link": TEXT,
    "message": TEXT,
})
GPLUS = record({
    "object": record(texts("content")), "actor": record(texts("id", "displayName", "url")),
    **texts("kind", "verb", "etag", "id", "published", "title", "updated", "url"),
})
INSTAGRAM = record({
    "owner": record(texts("full_name", "id", "username")), "hashtags": TEXT, "post_like": INT,
    "post_desc": TEXT, "crawling_date": TEXT, "post_id": TEXT, "post_date": TEXT, "post_code": TEXT,
    "post_comment": INT,
    "raw_data": record({
        "edge_media_tp_comment": COUNT, "tracking_token": TEXT, "shortcode": TEXT,
        "edge_media_preview_like": COUNT, "taken_at_timestamp": LONG, "keyword_id": TEXT,
    }),
    "post_picture": TEXT,
})
NEWS = record(texts(
    "media_category", "n_id", "file_content", "file_name", "n_link", "tablename", "news_date",
    "worker_id", "result_content",
))
TOPIC_MESSAGE = record({
    "key": T.BinaryType(), "value": T.BinaryType(), "topic": TEXT, "partition": INT, "offset": LONG,
    "timestamp": TIME,
})
# The typed table: as the flat tweet, with a real timestamp and ids as text.
TWEET_TABLE = record({
    **{field.name: field.dataType for field in FLAT_TWEET},
    "created_at": TIME, "id": TEXT, "quoted_status_id": TEXT,
})

# Topic -> source, and the columns analysis appends to every post.
TOPICS = {
    "weblogs": "compact",
    "twitter-stream": "flat_tweet",
    "enh-twitter-post": "tweet",
    "enh-facebook-post": "facebook",
    "enh-gplus-post": "gplus",
    "enh-instagram-post": "instagram",
    "raw-news": "news",
}
ANALYSIS_COLUMNS = (
    "sentiment", "total_score", "person", "company", "eventNegatif", "country", "city", "lat_city",
    "long_city",
)
