"""DuckDB SQL for the training-data queries that SQL can express on whole tables.

Not here: op3 (every 200-byte string of every text), op5 (a flow problem), op6 (XXH64 and reachability), op10 (a
tokenizer), op11 (eigenvectors), op12 (hashed filters), pipeline (contains op6). The tests hold those against plain
Python, op12 against the languages of held-out documents as well.
"""

from __future__ import annotations

ORACLES: dict[str, str] = {}

_GAP = "[\\x20\\x09-\\x0D]+"
_RULES = [
    ("example.net/en/", "example.net", "/en/", "allow"),
    ("example.com/de/", "example.com", "/de/", "block"),
    ("org/fr/", "org", "/fr/", "allow"),
    ("net/", "net", "/", "block"),
]


def _words(text: str) -> str:
    return f"list_filter(string_split_regex(coalesce({text}, ''), '{_GAP}'), lambda w: w <> '')"


def _lower(text: str) -> str:
    return f"translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


ORACLES["op1_preference_format"] = """
WITH turns AS (
  SELECT *, max(CASE WHEN role = 'assistant' THEN turn END) OVER (PARTITION BY conv_id) AS final
  FROM conversations WHERE conv_id IS NOT NULL
), sides AS (
  SELECT conv_id AS pair_id, 'chosen' AS side, turn, role, text FROM turns
  UNION ALL SELECT conv_id, 'rejected', turn, role, text FROM turns WHERE final IS NULL OR turn < final
  UNION ALL SELECT xor(conv_id, 1), 'rejected', 4611686018427387904, role, text FROM turns
    WHERE role = 'assistant' AND turn = final AND xor(conv_id, 1) IN (SELECT conv_id FROM conversations)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS spot,
    '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS shown
  FROM sides
), matched AS (
  SELECT coalesce(c.pair_id, r.pair_id) AS pair_id, coalesce(c.spot, r.spot) AS spot,
    c.role IS NOT DISTINCT FROM r.role AND c.text IS NOT DISTINCT FROM r.text AND c.spot = r.spot AS same
  FROM (SELECT * FROM placed WHERE side = 'chosen') c
  FULL JOIN (SELECT * FROM placed WHERE side = 'rejected') r ON c.pair_id = r.pair_id AND c.spot = r.spot
), prefix AS (
  SELECT pair_id, coalesce(min(CASE WHEN coalesce(same, false) THEN NULL ELSE spot END) - 1, max(spot)) AS n FROM matched GROUP BY pair_id
), parts AS (
  SELECT p.*, n, spot <= n AS shared,
    coalesce(sum(length(shown)) OVER (PARTITION BY p.pair_id, side, spot <= n ORDER BY spot ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM placed p JOIN prefix USING (pair_id)
)
SELECT pair_id, any_value(n)::BIGINT AS n_prompt_turns,
  count(*) FILTER (NOT shared AND side = 'chosen') AS n_chosen_turns,
  count(*) FILTER (NOT shared AND side = 'rejected') AS n_rejected_turns,
  coalesce(string_agg(shown, '' ORDER BY spot) FILTER (shared AND side = 'chosen'), '') AS prompt,
  coalesce(string_agg(shown, '' ORDER BY spot) FILTER (NOT shared AND side = 'chosen'), '') AS chosen,
  coalesce(string_agg(shown, '' ORDER BY spot) FILTER (NOT shared AND side = 'rejected'), '') AS rejected,
  coalesce(string_agg((start + 5 + length(role)) || '-' || (start + length(shown) - 1), ',' ORDER BY spot)
    FILTER (NOT shared AND side = 'chosen' AND role = 'assistant'), '') AS chosen_trained,
  coalesce(string_agg((start + 5 + length(role)) || '-' || (start + length(shown) - 1), ',' ORDER BY spot)
    FILTER (NOT shared AND side = 'rejected' AND role = 'assistant'), '') AS rejected_trained
FROM parts GROUP BY pair_id
"""

ORACLES["op2_quality_rules"] = f"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS text, {_words("text")} AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 7) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM texts WHERE len(words) >= 8)
), repeated AS (
  SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS following
  FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT doc_id, sum(least(8, coalesce(following - i, 8)))::BIGINT AS n FROM repeated GROUP BY doc_id
), counted AS (
  SELECT doc_id, lang, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM texts LEFT JOIN covered USING (doc_id)
), measured AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), scores AS (
  SELECT doc_id, lang, base_failed, unnest(['symbols', 'dup_lines', 'repeats']) AS rule,
    unnest([1000 * n_symbols // greatest(n_words, 1), 1000 * n_dup_lines // greatest(n_lines, 1), 1000 * n_repeat_words // greatest(n_words, 1)]) AS score
  FROM measured
), good AS (
  SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1
), tried AS (
  SELECT lang, rule, cutoff, count(*) AS n, count(*) FILTER (score > cutoff) AS k
  FROM scores JOIN good USING (doc_id),
    unnest([0, 1, 2, 5, 10, 20, 50, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900]) AS c(cutoff)
  WHERE NOT base_failed GROUP BY ALL
), tails AS (
  SELECT lang, rule, cutoff, sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.02 / 3) + (n - j) * ln(1 - 0.02 / 3))) AS p
  FROM (SELECT *, unnest(range(0, k + 1)) AS j FROM tried WHERE k < n * 0.02 / 3) GROUP BY ALL
), chosen AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM tails
  WHERE p <= 0.05 / (3 * greatest(1, (SELECT count(*) FROM (SELECT DISTINCT lang FROM tried)))) GROUP BY ALL
), rejected AS (
  SELECT DISTINCT doc_id FROM scores s JOIN chosen c ON s.rule = c.rule AND s.lang IS NOT DISTINCT FROM c.lang AND s.score > c.cutoff
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM rejected) AS kept
FROM measured
"""

_RULE_OF = "CASE " + " ".join(
    f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{rule}'"
    for rule, host, path, _ in _RULES
) + " END"
_VERDICT = "CASE rule " + " ".join(f"WHEN '{rule}' THEN '{verdict}'" for rule, _, _, verdict in _RULES) + " END"

ORACLES["op4_url_filter"] = f"""
WITH parts AS (
  SELECT page_id, url, {_lower("coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), spelled AS (
  SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '(\\.html?|/+)$', '') AS place,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\\?([^#]*)', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=|$)'))) AS query
  FROM parts
), named AS (
  SELECT *, CASE WHEN regexp_replace(host, '^(www|m)\\.', '') <> ''
    THEN place || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END END AS canonical
  FROM spelled
), listed AS (
  SELECT DISTINCT canonical FROM named
  WHERE canonical IS NOT NULL AND list_has_any(string_split_regex(host, '[.-]'), ['ads', 'adult', 'bets', 'casino'])
), ruled AS (
  SELECT page_id, host, path, {_RULE_OF} AS rule, canonical FROM named
)
SELECT page_id, host, path, rule,
  coalesce({_VERDICT}, CASE WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END) AS verdict
FROM ruled
"""

ORACLES["op7_mix_sources"] = f"""
WITH sized AS (
  SELECT doc_id, source, text, len({_words("text")})::BIGINT AS size FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1] AS weight, 2 * source_size AS most FROM sources
), levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (rising ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
    / sum(weight) OVER (rising ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed WINDOW rising AS (ORDER BY most / weight, source ASC NULLS LAST)
), goals AS (
  SELECT source, source_size, least(most::DOUBLE, weight * (SELECT level FROM levels WHERE level * weight <= most ORDER BY most / weight, source ASC NULLS LAST LIMIT 1)) AS target FROM levels
), rated AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS draw
  FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, source_size, target, (size * (floor(rate) + (draw < rate - floor(rate))::INT))::BIGINT AS taken FROM rated
"""

ORACLES["op8_debruijn_dedup"] = f"""
WITH texts AS (
  SELECT doc_id, {_words("text")} AS words FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 19) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 18)) AS i FROM texts WHERE len(words) >= 20)
), later AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY w ORDER BY doc_id, i) AS n FROM windows) WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS spot FROM later
), words AS (
  SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS spot FROM texts
), kept AS (
  SELECT w.doc_id, count(*) FILTER (g.spot IS NOT NULL) AS n_removed, string_agg(word, ' ' ORDER BY w.spot) FILTER (g.spot IS NULL) AS text
  FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.spot = g.spot GROUP BY w.doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (doc_id)
"""

_FOLDED = f"list_filter(string_split_regex({_lower('coalesce(text, chr(32))')}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

ORACLES["op9_decontaminate"] = f"""
WITH items AS (
  SELECT item_id, {_FOLDED} AS words FROM benchmark WHERE text IS NOT NULL
), patterns AS (
  SELECT DISTINCT item_id, list_slice(words, i, i + 9) AS w
  FROM (SELECT item_id, words, unnest(range(1, greatest(2, len(words) - 8))) AS i FROM items WHERE len(words) > 0)
), lengths AS (
  SELECT DISTINCT len(w) AS n FROM patterns
), texts AS (
  SELECT doc_id, {_FOLDED} AS words FROM documents
), windows AS (
  SELECT doc_id, n, i, list_slice(words, i, i + n - 1) AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM texts, lengths WHERE len(words) >= n)
), found AS (
  SELECT doc_id, item_id, i, n FROM windows JOIN patterns USING (w)
), hits AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM found) GROUP BY doc_id
), owners AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, coalesce(item_id::VARCHAR, '') AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

ORACLES["op13_hard_negatives"] = """
WITH good AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * c::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id, b.label, list_inner_product(a.x, b.x)::BIGINT AS score
  FROM (SELECT * FROM good WHERE vec_id % 100 = 0) a CROSS JOIN good b
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = own AND vec_id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, rank::INT AS rank, negative_id, positive_score, negative_score FROM (
  SELECT p.anchor_id, positive_id, s.vec_id AS negative_id, positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND s.label <> s.own
    AND 80 * positive_score <= 100 * s.score AND 100 * s.score <= 100 * positive_score
) WHERE rank <= 5
"""
