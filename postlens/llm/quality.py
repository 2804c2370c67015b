"""Quality rules with risk-controlled thresholds.

Each rule rejects documents whose score exceeds a cutoff. Cutoffs are not set by hand: labelled documents give,
per stratum, rule and candidate cutoff, the number of good documents the rule would reject. The exact binomial
tail decides whether that proves a false rejection rate below the allowed one, corrected for the number of
strata and rules tested. The lowest cutoff that is proven is used; where none is, the rule rejects nothing.

Everything is column expressions and aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import let, measured, words
from postlens.session import written

WINDOW = 8
# Characters that count as symbols.
SYMBOLS = "[#*$%&|<>]"
#: Scores: the expression's value per thousand. Cutoffs are tried from the top down.
SCORES = {
    "symbols": "1000 * n_symbols div greatest(n_words, 1)",
    "dup_lines": "1000 * n_dup_lines div greatest(n_lines, 1)",
    "repeats": "1000 * n_repeat_words div greatest(n_words, 1)",
}
CUTOFFS = (0, 1, 2, 5, 10, 20, 50, 100, 150, 200, 300, 400, 500, 600, 700, 800, 900)


@dataclass(frozen=True)
class Risk:
    """At most ``rejected`` of a stratum's good documents may be rejected, split evenly over the rules, with
    probability 1 - ``error`` for all strata and rules together."""

    rejected: float = 0.02
    error: float = 0.05


def repeated_words(tokens: Column, window: int = WINDOW) -> Column:
    """Words in windows that occur twice or more in the text, first occurrences included.

    Linear but for a sort: window hashes are compared by a hash set, and only if some are equal they are
    sorted with their positions; the covered words are the sum of the gaps between starts, cut at the window.
    """

    def covered(starts: Column) -> Column:
        gap = lambda p, i: F.least(F.coalesce(F.get(starts, i + 1) - p, F.lit(window)), F.lit(window))
        return F.aggregate(F.transform(starts, gap), F.lit(0).cast("long"), lambda a, x: a + x)

    def starts(pairs: Column) -> Column:
        same = lambda p, i: (p.h == F.get(pairs, i - 1).h) | (p.h == F.get(pairs, i + 1).h)
        return F.array_sort(F.transform(F.filter(pairs, lambda p, i: F.coalesce(same(p, i), F.lit(False))), lambda p: p.i))

    def repeats(hashes: Column) -> Column:
        pairs = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        found = let(F.sort_array(pairs), lambda sorted_pairs: let(starts(sorted_pairs), covered))
        return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), found).otherwise(F.lit(0).cast("long"))

    def hashed(codes: Column) -> Column:
        at = lambda i: F.xxhash64(*(F.get(codes, i + k) for k in range(window)))
        return let(F.transform(F.sequence(F.lit(0), F.size(codes) - window), at), repeats)

    enough = F.size(tokens) >= window
    return F.when(enough, let(F.transform(tokens, lambda w: F.xxhash64(w)), hashed)).otherwise(F.lit(0).cast("long"))


def measures(text: Column) -> Column:
    """A struct of the base counts; all 0 for null and for empty texts."""
    full = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(full, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))
    of_lines = let(
        lines,
        lambda ls: F.struct(F.size(ls).alias("n"), (F.size(ls) - F.size(F.array_distinct(ls))).alias("dup")),
    )
    of_words = let(
        words(full),
        lambda ws: F.struct(
            F.size(ws).alias("n"), F.length(F.array_join(ws, "")).alias("chars"), repeated_words(ws).alias("repeats")
        ),
    )
    symbols = F.length(full) - F.length(F.regexp_replace(full, SYMBOLS, ""))
    return F.struct(of_words.alias("words"), of_lines.alias("lines"), symbols.cast("long").alias("symbols"))


def with_measures(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base_failed.

    The one-element explode keeps later projections from computing the struct again for each of its fields.
    """
    measured_ = docs.withColumn("_m", F.explode(F.array(measures(F.col("text")))))
    named = {
        "n_words": "_m.words.n", "word_chars": "_m.words.chars", "n_symbols": "_m.symbols", "n_lines": "_m.lines.n",
        "n_dup_lines": "_m.lines.dup", "n_repeat_words": "_m.words.repeats",
    }
    counted = measured_.withColumns({name: F.col(of).cast("long") for name, of in named.items()}).drop("_m")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p), exactly, in logarithms; 1 where k is not below n * p, as such counts
    prove nothing. The work is k steps, and k is at most n * p."""
    odds = math.log(p / (1 - p))
    first = n * F.lit(math.log1p(-p))
    add = lambda a, b: F.greatest(a, b) + F.log1p(F.exp(-F.abs(a - b)))

    def step(acc: Column, j: Column) -> Column:
        term = acc.term + F.log((n - j + 1) / j) + F.lit(odds)
        return F.struct(term.alias("term"), add(acc.total, term).alias("total"))

    start = F.struct(first.alias("term"), first.alias("total"))
    summed = F.aggregate(F.sequence(F.lit(1).cast("long"), k), start, step, lambda acc: F.exp(acc.total))
    return F.when(k >= n * p, F.lit(1.0)).when(k == 0, F.exp(first)).otherwise(summed)


def good_labels(labels: DataFrame) -> DataFrame:
    """``(doc_id)`` of good documents; a document with contradicting labels isn't good, null labels say nothing."""
    return labels.groupBy("doc_id").agg(F.min("quality").alias("_q")).filter("_q = 1").select("doc_id")


def cutoffs(
    counted: DataFrame, labels: DataFrame, stratum: str, risk: Risk = Risk(),
    scores: Mapping[str, str] = SCORES, candidates: Sequence[int] = CUTOFFS,
) -> DataFrame:
    """``(stratum, rule, cutoff, n_good, n_rejected)``: the lowest proven cutoff of each stratum and rule.

    ``counted`` has doc_id, the stratum (null is one) and what the scores need. Only labelled good documents
    that pass the base rules are counted. Fewer good documents reach a higher cutoff, so testing from the top
    down until one fails is a fixed sequence and costs no correction of its own; strata times rules do
    (Bonferroni). Counts need one row per stratum, rule and cutoff, combined before the shuffle.
    """
    good = counted.filter("NOT base_failed").join(good_labels(labels), "doc_id")
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.expr(e).cast("long").alias("score")) for r, e in scores.items()))
    tried = F.array(*map(F.lit, candidates))
    rows = good.select(F.col(stratum).alias("_s"), F.explode(rules).alias("r"))
    steps = rows.select("_s", "r.rule", F.explode(tried).alias("cutoff"), F.col("r.score").alias("score"))
    counts = steps.groupBy("_s", "rule", "cutoff").agg(
        F.count("*").alias("n_good"), F.sum((F.col("score") > F.col("cutoff")).cast("long")).alias("n_rejected")
    )
    kept = written(counts, "quality-counts")
    tests = max(1, kept.select("_s").distinct().count()) * len(scores)
    allowed, level = risk.rejected / len(scores), risk.error / tests
    proven = kept.filter(binomial_tail(F.col("n_good"), F.col("n_rejected"), allowed) <= F.lit(level))
    best = proven.groupBy("_s", "rule").agg(F.min(F.struct("cutoff", "n_good", "n_rejected")).alias("b"))
    return best.select(F.col("_s").alias("stratum"), "rule", "b.*")


def with_verdict(
    counted: DataFrame, chosen: DataFrame, stratum: str, scores: Mapping[str, str] = SCORES
) -> DataFrame:
    """``counted`` with boolean ``kept``: neither the base rules nor a proven cutoff rejects the row."""
    by_stratum = chosen.groupBy("stratum").agg(
        F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cutoffs")
    )
    joined = counted.join(
        measured(by_stratum.withColumnRenamed("stratum", "_s"), "quality-cutoffs"),
        F.col(stratum).eqNullSafe(F.col("_s")), "left",
    )
    rejects = F.lit(False)
    for rule, score in scores.items():
        over = F.expr(score).cast("long") > F.try_element_at("_cutoffs", F.lit(rule))
        rejects = rejects | F.coalesce(over, F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~rejects).drop("_s", "_cutoffs")


def judged(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """One row per document: doc_id, the stratum, the counts, base_failed, kept. Repeated rows are judged each.

    Texts are read once; the counts are written, as both the cutoffs and the verdicts need them. Empty tables
    are allowed: without labels only the base rules reject. Extra columns of either table are not looked at.
    """
    counted = written(with_measures(docs.select("doc_id", stratum, "text")).drop("text"), "quality-measures")
    return with_verdict(counted, cutoffs(counted, labels, stratum, **options), stratum)


def kept(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The documents that pass; same columns. Texts are measured twice rather than shuffled."""
    narrow = with_measures(docs.select("doc_id", stratum, "text")).drop("text")
    chosen = cutoffs(written(narrow, "quality-measures"), labels, stratum, **options)
    clashing = [f"_in_{i}" for i in range(len(docs.columns))]
    plain = docs.toDF(*clashing)
    of = dict(zip(docs.columns, clashing, strict=True))
    rows = plain.withColumns({"doc_id": F.col(of["doc_id"]), stratum: F.col(of[stratum]), "text": F.col(of["text"])})
    passed = with_verdict(with_measures(rows), chosen, stratum).filter("kept")
    return passed.select(*(F.col(c).alias(name) for name, c in of.items()))
