"""URL filter: rules by host and path, then a list of canonical URLs.

The list goes into a blocked Bloom filter of bounded size, which is broadcast. Only rows it lets pass as
possible hits are joined exactly with the list, which removes its false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import ascii_lower
from postlens.session import written

#: A block has eight 64-bit words with one bit each per entry. At most so many blocks (4 MB) are broadcast; a
#: list beyond that passes more rows on to the exact join, which stays right.
WORDS, MAX_BLOCKS, BITS_PER_ENTRY = 8, 65_536, 16

# Fixed values: (host and path, verdict).
RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
# Words of a host that put a page's URL on the list.
LISTED_HOST_WORDS = ("ads", "adult", "bets", "casino")
# Query parameters that don't change the page.
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host, up to ``?`` or ``#``; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule that fits, else null."""
    longest = None
    for rule, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        longest = F.when(fits, F.lit(rule)).otherwise(F.lit(None).cast("string") if longest is None else longest)
    return longest


def canonical(url: Column) -> Column:
    """One spelling for the URLs of one page: no scheme, no leading ``www.`` or ``m.``, no fragment, no
    tracking parameters, the others sorted, no ``.html`` and no ``/`` at the end of the path.

    Null for a URL without host, which so is never listed.
    """
    name = F.regexp_replace(host(url), "^(www|m)\\.", "")
    place = F.regexp_replace(path(url), "(\\.html?|/+)$", "")
    query = F.regexp_extract(url, "(?s)^[^?#]*\\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")
    return F.when(name != "", F.concat(name, place, tail))


@dataclass(frozen=True)
class BlockedBloom:
    """One row per block that is not empty: _block and the words _w0 to _w7."""

    blocks: DataFrame
    n_blocks: int

    @staticmethod
    def _block(key: Column, n_blocks: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")

    @staticmethod
    def _bit(key: Column, word: int) -> Column:
        spot = F.shiftrightunsigned(F.xxhash64(F.lit("bit"), key), 6 * word).bitwiseAND(63)
        return F.call_function("shiftleft", F.lit(1).cast("long"), spot.cast("int"))

    @classmethod
    def of(cls, keys: DataFrame, column: str, entries: int) -> BlockedBloom:
        """Built where the list lies; bits of one block are combined before and after the shuffle."""
        n_blocks = min(MAX_BLOCKS, max(1, -(-entries * BITS_PER_ENTRY // (64 * WORDS))))
        key = F.col(column)
        bits = keys.select(
            cls._block(key, n_blocks).alias("_block"), *(cls._bit(key, w).alias(f"_w{w}") for w in range(WORDS))
        )
        combined = bits.groupBy("_block").agg(*(F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)))
        return cls(combined, n_blocks)

    def passes(self, rows: DataFrame, column: str, out: str) -> DataFrame:
        """``rows`` with boolean ``out``: false only if ``column`` is surely not on the list."""
        key = F.col(column)
        looked = rows.withColumn("_block", self._block(key, self.n_blocks)).join(
            F.broadcast(self.blocks), "_block", "left"
        )
        hit = F.lit(True)
        for w in range(WORDS):
            hit = hit & (F.col(f"_w{w}").bitwiseAND(self._bit(key, w)) != 0)
        return looked.withColumn(out, F.coalesce(hit, F.lit(False)) & key.isNotNull()).drop(
            "_block", *(f"_w{w}" for w in range(WORDS))
        )


def on_list(rows: DataFrame, url: str, listed: DataFrame, out: str) -> DataFrame:
    """``rows`` with boolean ``out``: whether the canonical form of ``url`` is in ``listed(canonical)``.

    Repeated entries count once, null entries and null URLs never match, an empty list matches nothing. Rows
    that the filter rules out are not shuffled.
    """
    entries = written(listed.filter("canonical IS NOT NULL").distinct(), "url-list")
    bloom = BlockedBloom.of(entries, "canonical", entries.count())
    bloom = BlockedBloom(written(bloom.blocks, "url-bloom"), bloom.n_blocks)
    sieved = bloom.passes(rows.withColumn("_canonical", canonical(F.col(url))), "_canonical", "_maybe")
    exact = entries.select(F.col("canonical").alias("_canonical"), F.lit(True).alias(out)).hint("shuffle_hash")
    hits = sieved.filter("_maybe").join(exact, "_canonical", "left").withColumn(out, F.coalesce(out, F.lit(False)))
    rest = sieved.filter("NOT _maybe").withColumn(out, F.lit(False))
    return hits.unionByName(rest).drop("_canonical", "_maybe")


def listed_by_host(pages: DataFrame, url: str, names: Sequence[str] = LISTED_HOST_WORDS) -> DataFrame:
    """``(canonical)``: the URLs whose host has one of ``names`` as a part between dots and hyphens."""
    found = F.arrays_overlap(F.split(host(F.col(url)), "[.-]"), F.array(*map(F.lit, names)))
    return pages.filter(found).select(canonical(F.col(url)).alias("canonical"))


def judged(pages: DataFrame, listed: DataFrame, url: str = "url", rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the rule's, else block if the URL is listed, else allow."""
    verdicts = F.create_map(*(F.lit(x) for rule in rules for x in rule))
    parts = pages.withColumns({"host": host(F.col(url)), "path": path(F.col(url))})
    ruled = on_list(parts.withColumn("rule", rule_for(F.col("host"), F.col("path"), rules)), url, listed, "_listed")
    method = F.when(F.col("_listed"), "block").otherwise("allow")
    return ruled.withColumn("verdict", F.coalesce(F.try_element_at(verdicts, F.col("rule")), method)).drop("_listed")
