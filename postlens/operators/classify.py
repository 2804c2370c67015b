"""Two-class sentiment model: multinomial naive Bayes over the exact words.

The model is a table with a weight per word, fitted by counting: any number of words, no iterations and no
approximation, so a second implementation gives the same scores.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.explode import items
from postlens.operators.lookup import frequent
from postlens.plans.tables import class_label
from postlens.session import written


@dataclass(frozen=True)
class Model:
    """``weights(word, weight, n)``: logarithm of how much more likely the word is in the positive class, and how often
    it was seen; ``prior``: the same for the classes themselves."""

    weights: DataFrame
    prior: float


def fit(labelled: DataFrame, words: str, label: str) -> Model:
    """From rows with an array of words and a label 0 or 1. Every count is raised by one, so that a word seen in
    one class only has a finite weight. Counts combine before the shuffle; the driver sees five sums."""
    kept = labelled.where(F.col(label).isin(0, 1))
    counts = written(
        items(kept, words, "word", [label])
        .groupBy("word")
        .agg(F.sum(F.col(label)).alias("n1"), F.sum(1 - F.col(label)).alias("n0")),
        "class-words",
    )
    total = counts.agg(F.coalesce(F.sum("n1"), F.lit(0)), F.coalesce(F.sum("n0"), F.lit(0)), F.count("*")).first()
    texts = kept.agg(F.coalesce(F.sum(label), F.lit(0)), F.coalesce(F.sum(1 - F.col(label)), F.lit(0))).first()
    likely = lambda n, all_: F.log((F.col(n) + 1) / F.lit(float(all_ + total[2])))
    weights = counts.select("word", (likely("n1", total[0]) - likely("n0", total[1])).alias("weight"), (F.col("n1") + F.col("n0")).alias("n"))
    return Model(weights, math.log((texts[0] + 1) / (texts[1] + 1)))


def score(model: Model, df: DataFrame, id_cols: Sequence[str], words: str) -> DataFrame:
    """Adds ``positive`` and ``negative``, probabilities that add up to 1. Words the model hasn't seen say nothing; a
    text without known words has the prior. ``id_cols`` must identify a row."""
    used = items(df, words, "word", id_cols)
    added = F.sum("weight").alias("_sum")
    often = frequent(model.weights, F.octet_length("word") + 8, "n")
    if often is None:
        sums = used.join(F.broadcast(model.weights), "word").groupBy(*id_cols).agg(added)
    else:
        # Most words are among the frequent ones, whose weights are added up before any shuffle.
        hot, rest = model.weights.where(F.col("n") >= often), model.weights.where(F.col("n") < often)
        rare = used.join(F.broadcast(hot.select("word")), "word", "left_anti").groupBy(*id_cols, "word").agg(F.count("*").alias("_n"))
        parts = [
            used.join(F.broadcast(hot), "word").groupBy(*id_cols).agg(added),
            rare.join(rest, "word").groupBy(*id_cols).agg(F.sum(F.col("_n") * F.col("weight")).alias("_sum")),
        ]
        sums = parts[0].unionByName(parts[1]).groupBy(*id_cols).agg(F.sum("_sum").alias("_sum"))
    odds = F.coalesce("_sum", F.lit(0.0)) + F.lit(model.prior)
    scored = df.join(sums, list(id_cols), "left").withColumn("positive", 1 / (1 + F.exp(-odds)))
    return scored.withColumn("negative", 1 - F.col("positive")).drop("_sum")


def shown(probability: Column) -> Column:
    """A probability as the result tables hold it."""
    return F.format_string("%.6f", probability)


def with_sentiment(scored: DataFrame) -> DataFrame:
    """``positive_scores``, ``negative_scores`` (text) and ``sentiment`` in place of the probabilities."""
    return scored.withColumns(
        {
            "positive_scores": shown(F.col("positive")),
            "negative_scores": shown(F.col("negative")),
            "sentiment": class_label(F.col("positive"), F.col("negative")),
        }
    ).drop("positive", "negative")


def accuracy(predicted: DataFrame, prediction: str, label: str) -> DataFrame:
    hit = (F.col(prediction) == F.col(label)).cast("double")
    return predicted.agg(F.avg(hit).alias("accuracy"), F.count("*").alias("scored"))
