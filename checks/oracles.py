"""DuckDB SQL stating the result of each registered query independently of Spark.

Dictionaries are inlined from the same samples. Long expressions are assembled from small text helpers;
each helper states one rule.
"""

from __future__ import annotations

from postlens.plans.samples import (
    ENTITIES, EVENT_STEMS, GAZETTEER, NEGATIVE, POSITIVE, ROOTS, SLANG, VOCABULARY,
)

ORACLES: dict[str, str] = {}

# Stated here once more and in other terms than in the package, so that a wrong rule there shows.
# White space: the controls from tab to carriage return, the four separators, next line, and every separator.
WHITE_SPACE = r"[\t-\r\x1c-\x1f\x{85}\p{Z}]+"
# A word: letters and digits of any script, and the underscore.
WORD = r"[\p{L}\p{N}_]+"
# Treebank tokenisation: opening quotes; colon and comma unless before a digit; the last full stop of a line or
# before a space; dots, dashes and single signs; closing quotes; then contractions.
TREEBANK = (
    (r'(^|[\x20(\x5B{<])"', r"\1 `` "),
    (r"([,:])(\D|\z)", r" \1 \2"),
    (r"([^.])[.]([\x5D)}>\"']*)([\x20\t\r\n]|\z)", r"\1 . \2 "),
    (r"([.]{3}|-{2}|[][;@#$%&?!(){}<>])", r" \1 "),
    (r'"', r" '' "),
    (r"([^'\x20])('(?:s|m|d|ll|re|ve)|n't|')(\x20|\z)", r"\1 \2 "),
)


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def among(item: str, members) -> str:
    return f"{item} IN ({', '.join(q(m) for m in sorted(set(members)))})"


def mapped(item: str, mapping) -> str:
    cases = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {item} {cases} END"


def replaced(expression: str, pattern: str, replacement: str) -> str:
    return f"regexp_replace({expression}, {q(pattern)}, {q(replacement)}, 'g')"


def clean(expression: str) -> str:
    return replaced(f"replace(lower({expression}), '<br />', ' ')", "[^A-Za-z ]+", " ")


def words(expression: str) -> str:
    return f"list_filter(regexp_split_to_array({expression}, {q(WHITE_SPACE)}), lambda t: t <> '')"


def tokens(expression: str) -> str:
    padded = f"lower({expression})"
    for pattern, replacement in TREEBANK:
        padded = replaced(padded, pattern, replacement)
    return words(padded)


def joined(values: str, separator: str) -> str:
    return f"array_to_string({values}, {q(separator)})"


def first_seen(values: str) -> str:
    """Distinct in first-seen order, on a column name."""
    return f"list_filter({values}, lambda e, i: list_position({values}, e) = i)"


def count_in(values: str, members) -> str:
    return f"len(list_filter({values}, lambda w: {among('w', members)}))"


POS_ONLY = sorted(set(POSITIVE) - set(NEGATIVE))
LABEL = "CASE WHEN neg > pos THEN 'negatif' WHEN pos > neg THEN 'positif' ELSE 'netral' END"
SCORE = "CASE WHEN pos + neg > 0 THEN (pos - neg) / (pos + neg) ELSE 0.0 END"


LONG_PREFIX = "^(meng|meny|mem|men|me|peng|peny|pem|pen|per|pel|pe|ber|bel|be|ter|te|di|ke|se)"
SHORT_PREFIX = "^(me|pe|be|te|di|ke|se)"


def stem(word: str) -> str:
    def strip(expression: str, pattern: str, put: str = "") -> str:
        return f"regexp_replace({expression}, {q(pattern)}, {q(put)})"

    bare = [word]
    for pattern in ("(lah|kah|tah|pun)$", "(ku|mu|nya)$", "(kan|an|i)$"):
        bare.append(strip(bare[-1], pattern))
    forms = list(bare)
    for base in (bare[3], bare[2], bare[1], bare[0]):
        once = strip(base, LONG_PREFIX)
        forms.append(once)
        for pattern, sound in (("^(me|pe)ny", "s"), ("^(me|pe)ng", "k"), ("^(me|pe)m", "p"), ("^(me|pe)n", "t")):
            forms.append(strip(base, pattern, sound))
        forms.append(strip(base, SHORT_PREFIX))
        forms.append(strip(once, LONG_PREFIX))
        forms.append(strip(once, SHORT_PREFIX))
    found = f"list_filter([{', '.join(forms)}], lambda f: {among('f', set(ROOTS) | set(EVENT_STEMS) if word == 'ev' else ROOTS)})[1]"
    return f"coalesce({found}, {word})"


# Shared relations: every oracle starts with the ones it needs.
STEMMED_VOCABULARY = f"""
vocab AS (SELECT DISTINCT unnest({words(replaced('lower(text)', '[^a-z0-9 -]+', ' '))}) AS w FROM {{source}}),
stems AS (SELECT w, {stem('w')} AS stem FROM vocab),
pieces AS (SELECT {{keys}}, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT {{keys}}, {words(replaced('lower(text)', '[^a-z0-9 -]+', ' '))} AS ws FROM {{source}})),
formal AS (SELECT {{keys}}, string_agg(coalesce({mapped('stem', SLANG)}, stem), ' ' ORDER BY i) AS t
  FROM pieces JOIN stems USING (w) GROUP BY ALL),
normalized AS (SELECT {{keys}}, {clean("coalesce(t, '')")} AS normalized FROM {{source}} LEFT JOIN formal USING ({{keys}}))
"""


def normalized(source: str = "documents", keys: str = "doc_id") -> str:
    return STEMMED_VOCABULARY.replace("{source}", source).replace("{keys}", keys)


def begin_inside(kind: str) -> str:
    begin, inside = ENTITIES[kind]
    return (
        f"list_filter(list_transform(tk, lambda w, i: CASE WHEN {among('w', begin)} THEN "
        f"CASE WHEN {among('tk[i + 1]', inside)} THEN w || ' ' || tk[i + 1] ELSE w END END), "
        f"lambda e: e IS NOT NULL)"
    )


DOC_TOKENS = f"tok AS (SELECT doc_id, {tokens('text')} AS tk FROM documents)"
DOC_WORDS = f"dw AS (SELECT doc_id, {words(clean('text'))} AS ws FROM documents)"
EVENT_WORDS = f"""
ev_vocab AS (SELECT DISTINCT unnest(tk) AS ev FROM tok),
ev_hit AS (SELECT ev FROM (SELECT ev, {stem('ev')} AS st FROM ev_vocab)
  WHERE {among('st', EVENT_STEMS)}),
ev_doc AS (SELECT doc_id, string_agg(ev, '{{sep}}' ORDER BY p) AS events FROM (
  SELECT doc_id, ev, min(p) AS p FROM (SELECT doc_id, unnest(tk) AS ev, unnest(range(len(tk))) AS p FROM tok)
  JOIN ev_hit USING (ev) GROUP BY ALL) GROUP BY doc_id)
"""


def event_words(separator: str) -> str:
    return EVENT_WORDS.replace("{sep}", separator)


# Sources -----------------------------------------------------------------------------------------

LINES = """lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS n
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents))"""
LINE_PARTS = f"parts AS (SELECT doc_id, n, {words('line')} AS p FROM lines)"

ORACLES["lexicon_load"] = f"""WITH {LINES}
SELECT DISTINCT lower(trim(line, ' ')) AS word FROM lines WHERE trim(line, ' ') <> ''"""
ORACLES["lexicon_load_raw"] = f"WITH {LINES} SELECT DISTINCT line AS word FROM lines WHERE line <> ''"
ORACLES["slang_dict"] = f"""WITH {LINES}, {LINE_PARTS},
ranked AS (SELECT p[1] AS key, array_to_string(p[2:], ' ') AS value,
  row_number() OVER (PARTITION BY p[1] ORDER BY doc_id DESC, n DESC) AS r FROM parts WHERE len(p) > 0)
SELECT key, value FROM ranked WHERE r = 1"""
ORACLES["gazetteer_load"] = f"""WITH {LINES}, {LINE_PARTS},
ranked AS (SELECT lower(p[1]) AS place, p[2] AS latitude, p[3] AS longitude,
  row_number() OVER (PARTITION BY lower(p[1]) ORDER BY doc_id DESC, n DESC) AS r FROM parts WHERE len(p) > 2)
SELECT place, latitude, longitude FROM ranked WHERE r = 1"""
ORACLES["entity_dictionary_load"] = f"""WITH {LINES}
SELECT DISTINCT ['person', 'job_title', 'company'][doc_id % 3 + 1] AS entity_type,
  CASE WHEN n % 2 = 0 THEN 'B' ELSE 'I' END AS role, lower(trim(line, ' ')) AS token
FROM lines WHERE trim(line, ' ') <> ''"""
ORACLES["ascii_strip"] = rf"SELECT doc_id, {replaced('text', r'[^\x00-\x7F]', '')} AS text_ascii FROM documents"
ORACLES["ascii_replace"] = rf"SELECT doc_id, {replaced('text', r'[^\x00-\x7F]', '?')} AS text_ascii FROM documents"
EVENT_OK = "event_id % 13 <> 12 AND event_id % 7 <> 6"
K_VALUE = "CAST(json_extract(props, '$.k') AS BIGINT)"
ORACLES["json_unwrap"] = f"SELECT event_id, CASE WHEN {EVENT_OK} THEN {K_VALUE} END AS k FROM events"
ORACLES["drop_malformed"] = f"SELECT event_id, {K_VALUE} AS k FROM events WHERE {EVENT_OK}"
FACEBOOK_OK = "doc_id % 11 <> 10 AND doc_id % 7 <> 3 AND doc_id % 8 <> 5"
ORACLES["required_fields"] = f"SELECT doc_id, 'fb' || doc_id AS id_fb FROM documents WHERE {FACEBOOK_OK}"
ORACLES["quarantine"] = """SELECT doc_id, CASE WHEN doc_id % 11 = 10 THEN 'malformed'
  WHEN doc_id % 7 = 3 THEN 'missing message' ELSE 'missing comments' END AS reason
FROM documents WHERE doc_id % 11 = 10 OR doc_id % 7 = 3 OR doc_id % 8 = 5"""
ORACLES["project_strings"] = """SELECT doc_id, CAST(doc_id + 985000000000000000 AS VARCHAR) AS id, text,
  CAST(n_chars % 97 AS VARCHAR) AS retweet_count, CASE WHEN n_chars > 280 THEN 'true' ELSE 'false' END AS truncated,
  CASE WHEN doc_id % 3 <> 0 THEN CAST(n_chars % 13 AS VARCHAR) END AS favorite_count
FROM documents WHERE doc_id % 11 <> 10"""
ORACLES["archive_split"] = """SELECT doc_id, 0 AS pos, md5(text) AS text_hash, NULL AS lang, NULL AS of_doc FROM documents
UNION ALL SELECT doc_id, 1, NULL, lang || '}{', CAST(doc_id AS VARCHAR) FROM documents
UNION ALL SELECT doc_id, 2, NULL, NULL, NULL FROM documents UNION ALL SELECT doc_id, 3, NULL, NULL, NULL FROM documents"""

ORACLES["archive_files"] = """SELECT doc_id, lang || '}{' AS lang, md5(text || CASE WHEN doc_id % 3 = 0 THEN '}{' ELSE '' END) AS text_hash, '}{' AS tag
FROM documents"""

# Inferred schemas --------------------------------------------------------------------------------


def profiled(fields: list[tuple[str, str, str]], table: str, usable: str) -> str:
    """Per path, type and condition: how many usable rows of ``table`` meet it."""
    counts = ", ".join(f"count(*) FILTER (({usable}) AND ({there})) AS n{i}" for i, (_, _, there) in enumerate(fields))
    rows = " UNION ALL ".join(
        f"SELECT '{path}' AS path, '{kind}' AS type, n{i} AS present, 1 - n{i} / {'total' if path == '$' else 'n0'} AS null_share FROM c"
        for i, (path, kind, _) in enumerate(fields)
    )
    return f"WITH c AS (SELECT count(*)::DOUBLE AS total, {counts} FROM {table}) {rows}"


ARRIVED = "event_id % 13 <> 12 AND event_id % 7 <> 6"
ORACLES["inferred_profile"] = profiled(
    [
        ("$", "struct", "true"), ("k", "string", "event_id % 4 <> 3"), ("of", "struct", "event_id % 4 >= 2"),
        ("of.event_type", "string", "event_id % 4 = 2"), ("of.v", "double", "event_id % 4 >= 2"),
        ("tags", "array<string>", "event_id % 4 = 3"), ("user", "bigint", "event_id % 4 = 1"),
    ],
    "events", ARRIVED,
)
ORACLES["inferred_rows"] = f"""SELECT event_id, {ARRIVED} AS usable,
  CASE WHEN {ARRIVED} AND event_id % 4 <> 3 THEN CASE WHEN event_id % 4 = 1 THEN 'x' ELSE '' END || CAST(json_extract_string(props, '$.k') AS VARCHAR) END AS k,
  CASE WHEN {ARRIVED} AND event_id % 4 = 1 THEN user_id END AS user,
  CASE WHEN {ARRIVED} AND event_id % 4 = 2 THEN event_type END AS event_type,
  CASE WHEN {ARRIVED} AND event_id % 4 = 2 THEN floor(value) WHEN {ARRIVED} AND event_id % 4 = 3 THEN 10.0 END::DOUBLE AS v,
  CASE WHEN {ARRIVED} AND event_id % 4 = 3 THEN 'a|' || json_extract_string(props, '$.k') END AS tags
FROM events"""

INTACT_DOCUMENT = "doc_id % 11 <> 10"
ORACLES["inferred_profile_tweet"] = profiled(
    [
        ("$", "struct", "true"), ("raw", "struct", "true"), ("raw.created_at", "string", "true"), ("raw.entities", "struct", "true"),
        ("raw.entities.hashtags", "array<string>", "true"), ("raw.entities.symbols", "array<string>", "true"),
        ("raw.entities.urls", "array<string>", "true"), ("raw.favorite_count", "bigint", "doc_id % 3 <> 0"), ("raw.id", "bigint", "true"),
        ("raw.id_str", "string", "true"), ("raw.lang", "string", "lang IS NOT NULL"), ("raw.quote_count", "bigint", "true"),
        ("raw.reply_count", "bigint", "true"), ("raw.retweet_count", "bigint", "true"), ("raw.source", "string", "source IS NOT NULL"),
        ("raw.text", "string", "doc_id % 7 <> 3 AND text IS NOT NULL"), ("raw.timestamp_ms", "string", "true"), ("raw.user", "struct", "true"),
        ("raw.user.id_str", "string", "doc_id % 4 <> 2"), ("raw.user.screen_name", "string", "lang IS NOT NULL"),
    ],
    "documents", INTACT_DOCUMENT,
)
ORACLES["inferred_profile_facebook"] = profiled(
    [
        ("$", "struct", "true"), ("comments", "struct", "doc_id % 8 <> 5"), ("comments.count", "bigint", "doc_id % 8 <> 5"),
        ("created_time", "string", "true"), ("from", "struct", "true"), ("from.id", "string", "true"), ("from.name", "string", "source IS NOT NULL"),
        ("group_id", "string", "doc_id % 6 <> 1"), ("id", "string", "true"), ("likes", "struct", "doc_id % 5 <> 4"),
        ("likes.count", "bigint", "doc_id % 5 <> 4"), ("link", "string", "true"), ("message", "string", "doc_id % 7 <> 3 AND text IS NOT NULL"),
        ("name", "string", "doc_id % 4 <> 1 AND lang IS NOT NULL"), ("status_type", "string", "true"), ("type", "string", "true"),
    ],
    "documents", INTACT_DOCUMENT,
)

# Flatteners --------------------------------------------------------------------------------------


def minute(text: str) -> str:
    return f"{text} || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0')"


def unless(modulus: int, remainder: int, value: str) -> str:
    return f"CASE WHEN doc_id % {modulus} <> {remainder} THEN {value} END"


INTACT = "doc_id % 11 <> 10"
TWEET = {
    "created_at": minute("'Mon Apr 16 03:'") + " || ':07 +0000 2018'",
    "source": "source",
    "retweet_count": "CAST(n_chars % 97 AS INT)",
    "id_str": "CAST(doc_id + 985000000000000000 AS VARCHAR)",
    "favorite_count": unless(3, 0, "CAST(n_chars % 13 AS INT)"),
    "id": "doc_id + 985000000000000000",
    "text": "text",
    "lang": "lang",
    "quote_count": "0",
    "timestamp_ms": "CAST(doc_id * 1000 + 1523849790000 AS VARCHAR)",
    "reply_count": "CAST(doc_id % 5 AS INT)",
    "urls": "'http://example.org/' || doc_id || '{sep}' || source",
    "hashtags": unless(5, 0, "lang || '{sep}' || source"),
    "symbols": "''",
    "user_screen_name": "lang || 'é_' || doc_id",
    "user_id": unless(4, 2, "CAST(doc_id * 7 AS VARCHAR)"),
}
TWEET_OK = f"{INTACT} AND doc_id % 7 <> 3"
FLAT_TWEET = {
    "created_at": minute("'Thu Apr 26 10:46:'") + " || ' +0000 2018'",
    "id": "doc_id + 985000000000000000",
    "id_str": "CAST(doc_id + 985000000000000000 AS VARCHAR)",
    "text": "text",
    "truncated": "n_chars > 280",
    "source": "source",
    "is_quote_status": "doc_id % 9 = 0",
    "quoted_status_id": "CASE WHEN doc_id % 9 = 0 THEN doc_id + 5 END",
    "quoted_status_id_str": "CASE WHEN doc_id % 9 = 0 THEN CAST(doc_id + 5 AS VARCHAR) END",
    "retweet_count": "CAST(n_chars % 97 AS INT)",
    "favorite_count": unless(3, 0, "CAST(n_chars % 13 AS INT)"),
    "favorited": "FALSE",
    "retweeted": "doc_id % 4 = 0",
    "lang": "lang",
}
FACEBOOK = {
    "created_time": minute("'2018-04-13T09:49:'") + " || '+0000'",
    "comments_count": "CAST(doc_id % 17 AS INT)",
    "group_id": unless(6, 1, "'g' || (doc_id % 31)"),
    "from_name": "source",
    "from_id": "CAST(doc_id * 3 AS VARCHAR)",
    "id_fb": "'fb' || doc_id",
    "type_fb": "CASE WHEN doc_id % 2 = 0 THEN 'status' ELSE 'link' END",
    "likes_count": unless(5, 4, "CAST(doc_id % 23 AS INT)"),
    "status_type": "'mobile_status_update'",
    "name": unless(4, 1, "lang"),
    "link": "'http://example.org/p?id=' || doc_id",
    "message_fb": "text",
}
GPLUS = {
    "actor_id": "CAST(doc_id * 11 AS VARCHAR)",
    "actor_display_name": "lang || ' ' || source",
    "actor_url": "'http://example.org/u/' || doc_id",
    "kind": "'plus#activity'",
    "verb": "CASE WHEN doc_id % 3 = 0 THEN 'share' ELSE 'post' END",
    "etag": "'\"' || source || '/x\"'",
    "id_gplus": "'z' || doc_id",
    "published": "'2018-04-13T02:49:09.000Z'",
    "title": "lang || '/' || source",
    "updated": "'2018-04-13T02:50:09.000Z'",
    "url_post": "'http://example.org/a/' || doc_id",
    "content": "text",
}
INSTAGRAM = {
    "full_name": unless(6, 2, "lang || ' ' || source"),
    "id_user": unless(6, 2, "CAST(doc_id * 13 AS VARCHAR)"),
    "username": unless(6, 2, f"({unless(5, 2, 'source')})"),
    "post_like": "CAST(n_chars % 41 AS INT)",
    "post_desc": "text",
    "crawling_date": "'2018-04-13 09:49:09'",
    "post_id": "CAST(doc_id + 17 AS VARCHAR)",
    "post_date": "'2018-04-12 10:00:00'",
    "post_code": "'B' || doc_id",
    "post_comment": "CAST(doc_id % 19 AS INT)",
    "edge_media_tp_comment": "CAST(doc_id % 19 AS INT)",
    "tracking_token": "'tok' || doc_id",
    "shortcode": "'B' || doc_id",
    "edge_media_preview_like": "CAST(n_chars % 41 AS INT)",
    "taken_at_timestamp": "doc_id + 1523500000",
    "keyword_id": "CAST(doc_id % 10 AS VARCHAR)",
    "post_picture": "'http://example.org/i/' || doc_id",
    "hashtags": unless(4, 3, "lang || '{sep}' || source"),
}
NEWS = {
    "media_category": "source",
    "news_id": "CAST(doc_id AS VARCHAR)",
    "file_content": "'<br />' || text",
    "file_name": "'n' || doc_id || '.html'",
    "news_link": "'http://example.org/n/' || doc_id",
    "table_name": "'t_' || lang",
    "news_date": "'2018-04-13'",
    "worker_id": "CAST(doc_id % 8 AS VARCHAR)",
    "result_content": unless(4, 2, "text"),
    "news_text": "CASE WHEN doc_id % 4 <> 2 THEN text ELSE '<br />' || text END",
}
FEEDS = {
    "tweet": (TWEET, TWEET_OK),
    "flat_tweet": (FLAT_TWEET, INTACT),
    "facebook": (FACEBOOK, FACEBOOK_OK),
    "gplus": (GPLUS, TWEET_OK),
    "instagram": (INSTAGRAM, TWEET_OK),
    "news": (NEWS, TWEET_OK),
}


def selected(columns: dict[str, str], separator: str = ",") -> str:
    return ", ".join(f"{value.replace('{sep}', separator)} AS {name}" for name, value in columns.items())


for _name, (_columns, _where) in FEEDS.items():
    ORACLES[f"flatten_{_name}"] = f"SELECT doc_id, {selected(_columns)} FROM documents WHERE {_where}"
TEXT_FIELDS = ("created_at", "source", "id_str", "text", "lang", "timestamp_ms", "urls", "hashtags", "symbols",
               "user_screen_name", "user_id")
ORACLES["flatten_tweet_ascii"] = "SELECT doc_id, " + selected(
    {n: replaced(v, r"[^\x00-\x7F]", "") if n in TEXT_FIELDS else v for n, v in TWEET.items()}
) + f" FROM documents WHERE {TWEET_OK}"
ORACLES["list_join"] = f"""SELECT doc_id, {unless(5, 0, "lang || ',' || source")} AS comma,
  {unless(5, 0, "lang || ' ' || source")} AS space FROM documents WHERE {TWEET_OK}"""
ORACLES["compact_post"] = rf"""SELECT doc_id, source AS id, lang || '_' || source AS name,
  {replaced('text', r'[^\x00-\x7F]', '?')} AS text FROM documents WHERE {INTACT}"""
TYPED = {
    **FLAT_TWEET,
    "created_at": minute("'2018-04-26 10:46:'"),
    "id": "CAST(doc_id + 985000000000000000 AS VARCHAR)",
    "quoted_status_id": "CASE WHEN doc_id % 9 = 0 THEN CAST(doc_id + 5 AS VARCHAR) END",
}
ORACLES["typed_row"] = f"SELECT doc_id, {selected(TYPED)} FROM documents WHERE {INTACT}"

ORACLES["post_times"] = f"""SELECT doc_id, '2018-04-16 03:' || lpad(CAST(doc_id % 60 AS VARCHAR), 2, '0') || ':07' AS created,
  strftime(make_timestamp((doc_id * 1000 + 1523849790000) * 1000), '%Y-%m-%d %H:%M:%S') AS sent,
  strftime(make_timestamp((doc_id + 1523500000) * 1000000), '%Y-%m-%d %H:%M:%S') AS taken
FROM documents WHERE {TWEET_OK}"""

# Text --------------------------------------------------------------------------------------------

ORACLES["clean_text"] = f"SELECT doc_id, {clean('text')} AS cleaned FROM documents"
ORACLES["tokenize_ws"] = f"""SELECT doc_id, {joined(words('text'), '|')} AS tokens,
  CAST(len({words('text')}) AS INT) AS n, CAST(len(string_split(text, ' ')) AS INT) AS n_by_space FROM documents"""
ORACLES["tokenize_words"] = f"""WITH {DOC_TOKENS}
SELECT doc_id, {joined('tk', ' ')} AS joined, CAST(len(tk) AS INT) AS n FROM tok"""
REGEX_WORDS = f"regexp_extract_all(lower(text), {q(WORD)})"
ORACLES["regex_words"] = f"""SELECT doc_id, {joined(REGEX_WORDS, ' ')} AS joined,
  CAST(len({REGEX_WORDS}) AS INT) AS n FROM documents"""
ORACLES["normalize_slang"] = f"""SELECT doc_id, array_to_string(list_transform({words('text')},
  lambda w: coalesce({mapped('lower(w)', SLANG)}, w)), ' ') AS formal FROM documents"""
ORACLES["stem_tokens"] = f"""WITH counted AS (SELECT w AS word, count(*) AS count FROM (
  SELECT unnest({words(replaced('lower(text)', '[^a-z0-9 -]+', ' '))}) AS w FROM documents) GROUP BY w)
SELECT word, {stem('word')} AS stem, count FROM counted"""
ORACLES["normalize_text"] = f"WITH {normalized()} SELECT doc_id, normalized FROM normalized"

# Sentiment ---------------------------------------------------------------------------------------

SCORED = f"""{DOC_WORDS}, scored AS (SELECT doc_id, {count_in('ws', POS_ONLY)} AS pos,
  {count_in('ws', NEGATIVE)} AS neg, len(ws) AS n FROM dw)"""
ORACLES["sentiment_label"] = f"""WITH {SCORED} SELECT doc_id, CAST(pos AS INT) AS pos, CAST(neg AS INT) AS neg,
  {LABEL} AS sentiment FROM scored"""
ORACLES["sentiment_score"] = f"WITH {SCORED} SELECT doc_id, {LABEL} AS sentiment, {SCORE} AS total_score FROM scored"
ORACLES["word_polarity"] = f"""WITH {DOC_WORDS}, counted AS (
  SELECT w AS word, count(*) AS count FROM (SELECT unnest(ws) AS w FROM dw) GROUP BY w)
SELECT word, count, CASE WHEN {among('word', POSITIVE)} THEN 'positive'
  WHEN {among('word', NEGATIVE)} THEN 'negative' END AS polarity FROM counted"""

# Entities ----------------------------------------------------------------------------------------


def entity_columns(kinds, separator: str = ",") -> tuple[str, str]:
    """(found lists relation, select list)"""
    lists = ", ".join(f"{begin_inside(kind)} AS {kind}_l" for kind in kinds)
    shown = ", ".join(f"{joined(first_seen(f'{kind}_l'), separator)} AS {kind}" for kind in kinds)
    return f"found AS (SELECT doc_id, tk, {lists} FROM tok)", shown


for _kinds, _key in [((k,), f"entities_{k}") for k in ("person", "company", "country", "location")] + [
    (tuple(ENTITIES), "entities_all")
]:
    _found, _shown = entity_columns(_kinds)
    ORACLES[_key] = f"WITH {DOC_TOKENS}, {_found} SELECT doc_id, {_shown} FROM found"

CITY_LIST = f"list_filter(tk, lambda w: {among('w', GAZETTEER)})"
ORACLES["entities_city_unigram"] = f"""WITH {DOC_TOKENS}, c AS (SELECT doc_id, {CITY_LIST} AS city_l FROM tok)
SELECT doc_id, {joined(first_seen('city_l'), ' ')} AS city FROM c"""
ORACLES["entities_negative_event"] = f"""WITH {DOC_TOKENS}, {event_words(',')}
SELECT doc_id, coalesce(events, '') AS "eventNegatif" FROM documents LEFT JOIN ev_doc USING (doc_id)"""
PLACES = f"""places AS (SELECT doc_id, list_filter({first_seen('location_l')}, lambda p: {among('p', GAZETTEER)}) AS pl FROM found)"""
LATS = {k: v[0] for k, v in GAZETTEER.items()}
LONGS = {k: v[1] for k, v in GAZETTEER.items()}
PLACE_COLUMNS = f"""{joined('pl', ',')} AS city,
  array_to_string(list_transform(pl, lambda p: {mapped('p', LATS)}), ',') AS lat_city,
  array_to_string(list_transform(pl, lambda p: {mapped('p', LONGS)}), ',') AS long_city"""
_found, _ = entity_columns(("location",))
ORACLES["geo_lookup"] = f"WITH {DOC_TOKENS}, {_found}, {PLACES} SELECT doc_id, {PLACE_COLUMNS} FROM places"

_found, _shown = entity_columns(("person", "company", "country", "location"))
_shown = entity_columns(("person", "company", "country"))[1]
ENRICHED = f"""{normalized()}, {DOC_TOKENS}, {event_words(',')}, {_found}, {PLACES},
nw AS (SELECT doc_id, {words('normalized')} AS ws FROM normalized),
sc AS (SELECT doc_id, {count_in('ws', POS_ONLY)} AS pos, {count_in('ws', NEGATIVE)} AS neg FROM nw),
enriched AS (SELECT doc_id, {LABEL} AS sentiment, {SCORE} AS total_score, {_shown},
  coalesce(events, '') AS "eventNegatif", {PLACE_COLUMNS}
  FROM sc JOIN found USING (doc_id) JOIN places USING (doc_id) LEFT JOIN ev_doc USING (doc_id))"""
ORACLES["enrich_posts"] = f"WITH {ENRICHED} SELECT * FROM enriched"
# Larger dictionaries of entries that occur in no text don't change the result.
ORACLES["enrich_posts_large"] = ORACLES["enrich_posts"]
ORACLES["geo_lookup_large"] = ORACLES["geo_lookup"]
ORACLES["normalize_slang_large"] = f"""SELECT doc_id, md5(array_to_string(list_transform({words('text')},
  lambda w: CASE WHEN length(lower(w)) >= 5 THEN '#' || lower(w) || ' x' ELSE w END), ' ')) AS formal_hash FROM documents"""
_typed = {**TYPED}
_typed["id_twitter"] = _typed.pop("id")
_typed["id_str_twitter"] = _typed.pop("id_str")
ORACLES["typed_enriched_row"] = f"""WITH {ENRICHED} SELECT {selected(_typed)}, enriched.*
FROM documents JOIN enriched USING (doc_id) WHERE {INTACT}"""

# Vocabulary, spelling, vectors -------------------------------------------------------------------

ORACLES["word_frequency"] = f"""WITH counted AS (SELECT w AS word, count(*) AS count FROM (
  SELECT unnest({REGEX_WORDS}) AS w FROM documents) GROUP BY w)
SELECT word, count, count / (SELECT sum(count) FROM counted) AS probability FROM counted"""
# Brute force over all pairs. Bits mark which letters a word has once and twice; an edit adds at most one
# bit and takes at most one away, so most pairs need no distance.
LETTER_BITS = """list_sum(list_transform(range(52), lambda i: CASE WHEN
  length(w) - length(replace(w, chr(97 + (i % 26)::INT), '')) > i // 26 THEN 1::BIGINT << i::INT ELSE 0 END))::BIGINT"""
FIXES = f"""{DOC_WORDS}, known AS MATERIALIZED (SELECT w, n, {LETTER_BITS} AS m, length(w)::INT AS l FROM (
  SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM dw) GROUP BY w)),
probe AS (SELECT DISTINCT unnest({words(clean('text'))}) AS w FROM conversations),
unknown AS MATERIALIZED (SELECT w, {LETTER_BITS} AS m, length(w)::INT AS l FROM probe WHERE w NOT IN (SELECT w FROM known)),
pairs AS (SELECT u.w, k.w AS c, k.n, CASE WHEN bit_count(xor(u.m & k.m, u.m)) <= 2
  AND bit_count(xor(u.m & k.m, k.m)) <= 2 THEN damerau_levenshtein(u.w, k.w) END AS d
  FROM unknown u JOIN known k ON k.l BETWEEN u.l - 2 AND u.l + 2),
best AS (SELECT w, c, row_number() OVER (PARTITION BY w ORDER BY d, n DESC, c) AS r FROM pairs WHERE d <= 2),
fixes AS (SELECT probe.w AS word, coalesce(c, probe.w) AS correction FROM probe LEFT JOIN best
  ON best.w = probe.w AND r = 1)"""
ORACLES["spell_correct"] = f"WITH {FIXES} SELECT word, correction FROM fixes"
CORRECTED = f"""{FIXES},
cw AS (SELECT conv_id, turn, unnest(ws) AS w, unnest(range(len(ws))) AS i
  FROM (SELECT conv_id, turn, {words(clean('text'))} AS ws FROM conversations)),
ct AS (SELECT conv_id, turn, string_agg(correction, ' ' ORDER BY i) AS text FROM cw JOIN fixes ON word = w GROUP BY ALL),
corrected AS (SELECT c.conv_id, c.turn, coalesce(ct.text, '') AS text FROM conversations c
  LEFT JOIN ct ON ct.conv_id = c.conv_id AND ct.turn = c.turn)"""
ORACLES["corrected_sentiment"] = f"""WITH {CORRECTED}, {normalized('corrected', 'conv_id, turn')},
nw AS (SELECT conv_id, turn, {words('normalized')} AS ws FROM normalized),
sc AS (SELECT conv_id, turn, {count_in('ws', POS_ONLY)} AS pos, {count_in('ws', NEGATIVE)} AS neg FROM nw)
SELECT conv_id, turn, text AS corrected, {LABEL} AS sentiment, {SCORE} AS total_score
FROM sc JOIN corrected USING (conv_id, turn)"""
ENCODED = f"""{DOC_WORDS}, enc AS (SELECT doc_id, list_transform(ws,
  lambda w: coalesce({mapped('w', {k: str(v) for k, v in VOCABULARY.items()})}, '0')) AS ids FROM dw)"""


def windows(ids: str) -> str:
    """Ids in windows of 70, the last one padded with 0."""
    return f"""win AS (SELECT doc_id, unnest(range(greatest((len({ids}) + 69) // 70, 1))) AS n, {ids} AS ids FROM enc),
cut AS (SELECT doc_id, CAST(n AS INT) AS "window", list_transform(range(1, 71), lambda i: coalesce(ids[n * 70 + i], '0')) AS ids FROM win)"""


ORACLES["encode_sequence"] = f"WITH {ENCODED}, {windows('ids')} SELECT doc_id, \"window\", {joined('ids', ' ')} AS ids FROM cut"
ORACLES["encode_sequence_large"] = f"""WITH {DOC_WORDS}, enc AS (SELECT doc_id, list_transform(ws,
  lambda w: CAST(CAST('0x' || substr(md5(w), 1, 8) AS BIGINT) AS VARCHAR)) AS ids FROM dw), {windows('ids')}
SELECT doc_id, \"window\", md5({joined('ids', ' ')}) AS ids_hash FROM cut"""
ORACLES["embedding_mean"] = """WITH el AS (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings)
SELECT label, CAST(dim AS INT) AS dim, round(avg(CAST(x AS DOUBLE)), 6) + 0.0 AS mean FROM el GROUP BY label, dim"""
ORACLES["embedding_pool"] = f"""WITH {ENCODED}, pos AS (SELECT doc_id, CAST(unnest(ids) AS BIGINT) AS id FROM enc),
el AS (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS dim FROM embeddings),
used AS (SELECT doc_id, id, count(*) AS n FROM pos WHERE id <> 0 GROUP BY ALL),
pooled AS (SELECT doc_id, CAST(dim AS INT) AS dim, round(sum(n * CAST(x AS DOUBLE)) / sum(n), 6) + 0.0 AS mean
  FROM used JOIN el ON vec_id = id GROUP BY doc_id, dim)
SELECT doc_id, dim, mean FROM documents LEFT JOIN pooled USING (doc_id)"""


def bayes(train: str, texts: str) -> str:
    """Relations ``model`` to ``posterior(doc_id, p)``: counts raised by one, words of the training texts only.

    ``train`` selects (doc_id, ws, quality), ``texts`` (doc_id, ws).
    """
    return f"""train AS MATERIALIZED ({train}), texts AS MATERIALIZED ({texts}),
seen AS (SELECT unnest(ws) AS w, quality FROM train),
per_word AS (SELECT w, sum(quality) AS n1, sum(1 - quality) AS n0 FROM seen GROUP BY w),
sums AS (SELECT coalesce(sum(n1), 0) + count(*) AS t1, coalesce(sum(n0), 0) + count(*) AS t0 FROM per_word),
prior AS (SELECT ln((coalesce(sum(quality), 0) + 1) / (coalesce(sum(1 - quality), 0) + 1)) AS odds FROM train),
evidence AS (SELECT doc_id, sum(ln((n1 + 1) / t1) - ln((n0 + 1) / t0)) AS odds
  FROM (SELECT doc_id, unnest(ws) AS w FROM texts) JOIN per_word USING (w), sums GROUP BY doc_id),
posterior AS (SELECT texts.doc_id, 1 / (1 + exp(-(prior.odds + coalesce(evidence.odds, 0)))) AS p
  FROM texts LEFT JOIN evidence USING (doc_id), prior)"""


TRAINING = "SELECT doc_id, ws, quality FROM dw JOIN labels USING (doc_id) WHERE quality IN (0, 1)"
SHOWN = "printf('%.6f', p) AS positive_scores, printf('%.6f', 1 - p) AS negative_scores"
CLASS = "CASE WHEN p > 1 - p THEN 'Positive' ELSE 'Negative' END"
ORACLES["classifier_score"] = f"""WITH {DOC_WORDS}, {bayes(TRAINING, 'SELECT doc_id, ws FROM dw')}
SELECT doc_id, {SHOWN}, {CLASS} AS sentiment FROM posterior"""
PART = "CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) % 4"
ORACLES["classifier_accuracy"] = f"""WITH {DOC_WORDS},
{bayes(f'{TRAINING} AND {PART} <> 0', f'SELECT doc_id, ws FROM dw JOIN labels USING (doc_id) WHERE {PART} = 0')}
SELECT avg(CASE WHEN (p > 1 - p) = (quality = 1) THEN 1.0 ELSE 0.0 END) AS accuracy, count(*) AS scored
FROM posterior JOIN labels USING (doc_id)"""
ORACLES["label_accuracy"] = """SELECT avg(CASE WHEN 1 - toxic = quality THEN 1.0 ELSE 0.0 END) AS accuracy,
  count(*) AS scored FROM labels"""

# Counts ------------------------------------------------------------------------------------------

STAMP = "'%Y-%m-%d %H:%M:%S'"
ORACLES["batch_counts"] = f"""SELECT strftime(time_bucket(INTERVAL '10 seconds', ts), {STAMP}) AS batch_start,
  count(*) AS records FROM events GROUP BY 1"""
BATCHED = f"""per_doc AS (SELECT CAST(doc_id // 100 AS BIGINT) AS batch_id,
  {count_in("string_split(text, ' ')", POSITIVE)} AS pos, {count_in("string_split(text, ' ')", NEGATIVE)} AS neg FROM documents),
history AS (SELECT batch_id, 'Positive' AS label, CAST(sum(pos) AS BIGINT) AS count, count(*) AS records FROM per_doc GROUP BY 1
  UNION ALL SELECT batch_id, 'Negative', CAST(sum(neg) AS BIGINT), count(*) FROM per_doc GROUP BY 1)"""
TOTALS = f"WITH {BATCHED} SELECT label, CAST(sum(count) AS BIGINT) AS count FROM history GROUP BY label"
ORACLES["class_counts"] = TOTALS
ORACLES["class_counts_history"] = f"WITH {BATCHED} SELECT batch_id, label, count, records FROM history"
ORACLES["running_counts"] = f"""WITH {BATCHED} SELECT batch_id, label,
  CAST(sum(count) OVER (PARTITION BY label ORDER BY batch_id) AS BIGINT) AS running_count FROM history"""
ORACLES["class_union"] = f"""WITH t AS (SELECT unnest(string_split(text, ' ')) AS w FROM documents)
SELECT label, hit, count(*) AS pairs FROM (
  SELECT 'Positive' AS label, CASE WHEN {among('w', POSITIVE)} THEN 1 ELSE 0 END AS hit FROM t
  UNION ALL SELECT 'Negative', CASE WHEN {among('w', NEGATIVE)} THEN 1 ELSE 0 END FROM t) GROUP BY ALL"""
ORACLES["dedup_by_id"] = """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1"""
ORACLES["posts_by_datetime"] = f"""SELECT strftime(date_trunc('hour', ts), {STAMP}) AS posted_at, event_type,
  count(*) AS posts FROM events GROUP BY ALL"""
ORACLES["keyword_filter"] = "SELECT doc_id FROM documents WHERE lang = 'en' AND contains(lower(text), 'attion')"
ORACLES["keywords_any"] = """SELECT doc_id FROM documents WHERE contains(lower(text), 'keit')
  OR contains(lower(text), 'eaux') OR contains(lower(text), 'ción')"""
ORACLES["id_watermark"] = """SELECT event_type, min(event_id) AS low_id, max(event_id) AS high_id
FROM events GROUP BY event_type"""
ORACLES["id_backfill"] = """SELECT event_id, event_type FROM events WHERE event_id <= (
  SELECT min(high_id) FROM (SELECT max(event_id) AS high_id FROM events GROUP BY event_type))"""
ORACLES["preview"] = "SELECT doc_id, lang, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20"

# Sinks -------------------------------------------------------------------------------------------

TABLE_COLUMNS = {
    "tweet": (TWEET, TWEET_OK, "text", ("created_at", "source", "retweet_count", "id_str", "favorite_count", "id",
              "text", "lang AS LANGUAGE", "quote_count", "timestamp_ms", "reply_count", "urls AS ENTITIES_URLS",
              "hashtags AS ENTITIES_HASHTAGS", "symbols AS ENTITIES_SYMBOLS", "user_screen_name", "user_id")),
    "facebook": (FACEBOOK, FACEBOOK_OK, "message_fb", ("created_time", "comments_count", "group_id", "from_name",
                 "from_id", "id_fb AS ID", "type_fb AS TYPE", "likes_count", "status_type", "name", "link",
                 "message_fb AS MESSAGE")),
    "gplus": (GPLUS, TWEET_OK, "content", ("actor_display_name", "actor_id", "actor_url", "kind", "verb", "etag",
              "id_gplus AS ID", "published", "title", "updated", "url_post")),
    "instagram": (INSTAGRAM, TWEET_OK, "post_desc", ("full_name", "id_user", "username", "hashtags AS HASHTAG",
                  "post_like", "post_desc", "crawling_date", "post_id", "post_date", "post_code", "post_comment",
                  "edge_media_tp_comment", "tracking_token", "shortcode", "edge_media_preview_like",
                  "taken_at_timestamp", "keyword_id", "post_picture")),
    "news": (NEWS, TWEET_OK, "file_content", ("media_category", "news_id", "file_content", "file_name", "news_link",
             "table_name", "news_date", "worker_id", "result_content")),
}
for _name, (_columns, _where, _text, _shown_columns) in TABLE_COLUMNS.items():
    _found, _shown = entity_columns(("person", "company", "country"), " ")
    _upper = ", ".join(
        f"f.{c.split(' AS ')[0]} AS {(c.split(' AS ') + [c])[1].upper()}" for c in _shown_columns
    )
    _entity = ", ".join(
        f"{joined(first_seen(f'{kind}_l'), ' ')} AS ENTITAS_{kind.upper()}" for kind in ("person", "company", "country")
    )
    ORACLES[f"db_row_{_name}"] = f"""WITH f AS (SELECT doc_id, {selected(_columns, ' ')} FROM documents WHERE {_where}),
tok AS (SELECT doc_id, {tokens(_text)} AS tk FROM f), {event_words(' ')}, {_found},
cities AS (SELECT doc_id, {CITY_LIST} AS city_l FROM tok),
{DOC_WORDS}, dbw AS (SELECT doc_id, {words(clean(_text))} AS ws FROM f),
{bayes(TRAINING, 'SELECT doc_id, ws FROM dbw')}
SELECT f.doc_id, {_upper}, {SHOWN.upper().replace("PRINTF('%.6F'", "printf('%.6f'")}, {CLASS} AS SENTIMENT,
  {joined(first_seen('city_l'), ' ')} AS ENTITAS_CITY, {_entity}, coalesce(events, '') AS ENTITAS_EVENT_NEGATIF
FROM f JOIN posterior USING (doc_id) JOIN found USING (doc_id) JOIN cities USING (doc_id) LEFT JOIN ev_doc USING (doc_id)"""

QUOTED = """CASE WHEN regexp_matches(text, '[|"\\r\\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END"""
ORACLES["pipe_row"] = f"""WITH {SCORED} SELECT doc_id || '|' || {QUOTED} || '|' || {LABEL} || '|' || n AS line
FROM scored JOIN documents USING (doc_id)"""
ORACLES["to_topic_value"] = "SELECT CAST(doc_id AS VARCHAR) AS msg_key, md5(text) AS text_hash, lang FROM documents"
ORACLES["json_sink"] = "SELECT doc_id, text, lang, 'documents' AS source_name, 7 AS batch_id FROM documents"
ORACLES["pipe_sink"] = "SELECT doc_id, text, lang, 3 AS batch_id FROM documents"
ORACLES["post_csv_sink"] = rf"""WITH {SCORED} SELECT doc_id, 'user' AS screen_name, '1' AS user_id,
  {replaced('text', r'[^\x00-\x7F]', '?')} AS sentence, {LABEL} AS sentiment, 5 AS batch_id
FROM scored JOIN documents USING (doc_id)"""
ORACLES["table_sink"] = "SELECT doc_id, lang, CAST(doc_id % 2 + 1 AS INT) AS batch_id FROM documents"
ORACLES["external_table_sink"] = "SELECT doc_id, lang FROM documents"
ORACLES["pipe_record"] = f"""WITH {ENRICHED} SELECT doc_id || '|' || lang || '_' || source || '|' || {QUOTED} || '|' || sentiment || '|' ||
  total_score || '|' || person || '|' || company || '|' || "eventNegatif" || '|' || country || '|' || city || '|' || lat_city || '|' || long_city AS line
FROM enriched JOIN documents USING (doc_id)"""

# Streams -----------------------------------------------------------------------------------------

ORACLES["stream_running_counts"] = TOTALS
ORACLES["stream_class_history"] = f"""WITH {BATCHED} SELECT label, CAST(sum(count) AS BIGINT) AS count,
  CAST(sum(records) AS BIGINT) AS records FROM history GROUP BY label"""
INGESTED = "strftime(make_timestamp(doc_id * 3600 * 1000000), '%Y-%m-%d')"
ORACLES["stream_enrich"] = f"""WITH {ENRICHED} SELECT doc_id + 985000000000000000 AS id, sentiment, total_score,
  person, city, lat_city, NULL AS reason, 'good' AS status, {INGESTED} AS ingest_date FROM enriched WHERE {TWEET_OK}
UNION ALL SELECT CASE WHEN {INTACT} THEN doc_id + 985000000000000000 END, NULL, NULL, NULL, NULL, NULL,
  CASE WHEN {INTACT} THEN 'missing raw.text' ELSE 'malformed' END, 'quarantined', {INGESTED} FROM documents WHERE NOT ({TWEET_OK})"""
ORACLES["stream_raw_archive"] = "SELECT md5(text) AS value_hash FROM documents"
ORACLES["stream_first_seen"] = "SELECT DISTINCT md5(text) AS post FROM documents"
ORACLES["stream_bounded_archive"] = ORACLES["stream_raw_archive"]
ORACLES["stream_latest"] = ORACLES["dedup_by_id"]

ORACLES["latest_table"] = """SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
ORACLES["compacted_output"] = """SELECT doc_id, lang, CAST(doc_id % 7 AS INT) AS batch_id, md5(text) AS text_hash FROM documents"""

LEDGER = """dealt AS (
  SELECT CASE WHEN event_id % 2 = 0 THEN 'weblogs' ELSE 'twitter-stream' END AS topic, CAST(event_id // 2 % 3 AS INT) AS partition,
    event_id // 6 AS "offset", CASE WHEN event_id % 50 = 7 THEN 2 WHEN event_id % 331 = 1 THEN 4 ELSE 1 END AS n, event_id FROM events
), kept AS (
  SELECT topic, partition, "offset", n, "offset" - row_number() OVER (PARTITION BY topic, partition ORDER BY "offset") AS run
  FROM dealt WHERE event_id % 97 <> 5 AND NOT (partition = 2 AND "offset" // 50 % 3 = 1)
), islands AS (
  SELECT topic, partition, min("offset") AS first, max("offset") AS last, sum(n)::BIGINT AS messages FROM kept GROUP BY topic, partition, run
)"""
ORACLES["offset_ledger"] = f"""WITH {LEDGER} SELECT *, messages - (last - first + 1) AS repeats,
  coalesce(lead(first) OVER (PARTITION BY topic, partition ORDER BY first) - last - 1, 0) AS missing FROM islands"""
ORACLES["offset_resume"] = f"""WITH {LEDGER} SELECT topic, partition, arg_min(last, first) + 1 AS safe, max(last) + 1 AS seen FROM islands
GROUP BY topic, partition"""

ORACLES["keywords_table"] = """WITH w AS (SELECT string_split(text, ' ') AS w FROM benchmark), asked AS (
  SELECT lower(n_name) AS keyword FROM nation UNION SELECT lower(array_to_string(w[2:4], ' ')) FROM w
  UNION SELECT lower(right(w[5], 4)) FROM w)
SELECT doc_id, keyword FROM documents JOIN asked ON contains(lower(text), keyword) WHERE trim(keyword) <> ''"""
