"""Two-class readout of pooled embeddings: a linear score fitted by least squares.

The normal equations need one pass that adds up outer products of bounded width, and are solved on the driver, which sees
a matrix of width by width whatever the number of rows. No iterations, so a second solution gives the same scores.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Widest vector that the normal equations are solved for; the matrix is that squared.
MAX_WIDTH = 4096


@dataclass(frozen=True)
class Readout:
    """score = intercept + weights * vector; above 0 is the positive class."""

    weights: tuple[float, ...]
    intercept: float


def fit(labelled: DataFrame, vector: str, label: str, ridge: float = 1e-3) -> Readout:
    """From rows with a vector and a label 0 or 1, fitted to -1 and 1 with ``ridge`` times the squared weights per row.

    Rows with a null vector or another label teach nothing. Without any row, or with one class only, the readout
    is that class's mean label for every vector, 0 without rows. Vectors must be of one length.
    """
    kept = labelled.where(F.col(label).isin(0, 1) & F.col(vector).isNotNull())
    rows = kept.select(array_to_vector(F.col(vector).cast("array<double>")).alias("x"), (2.0 * F.col(label) - 1).alias("y"), F.size(vector).alias("d"))
    seen = rows.agg(F.max("d").alias("d"), F.min("y").alias("low"), F.max("y").alias("high")).first()
    if seen.d is None or seen.low == seen.high:
        return Readout((), float(seen.low or 0))
    if seen.d > MAX_WIDTH:
        raise ValueError(f"vectors of {seen.d} entries; the normal equations are solved for {MAX_WIDTH} at most")
    solver = LinearRegression(featuresCol="x", labelCol="y", solver="normal", regParam=ridge, elasticNetParam=0.0, standardization=False)
    model = solver.fit(rows)
    return Readout(tuple(map(float, model.coefficients)), float(model.intercept))


def score(readout: Readout, df: DataFrame, vector: str) -> DataFrame:
    """Adds ``positive`` and ``negative``, shares that add up to 1: the score's place between -1 and 1. A null vector, a text
    without known words, has 0.5 each. Row-local."""
    weights = F.array(*(F.lit(w) for w in readout.weights)).cast("array<double>")
    products = F.zip_with(F.col(vector).cast("array<double>"), weights, lambda x, w: x * w)
    total = F.aggregate(products, F.lit(readout.intercept), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    place = F.greatest(F.lit(0.0), F.least(F.lit(1.0), (total + 1) / 2))
    scored = df.withColumn("positive", F.when(F.col(vector).isNotNull(), place).otherwise(0.5))
    return scored.withColumn("negative", 1 - F.col("positive"))


def accuracy(scored: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """``(by, accuracy, scored)``: the share of rows with label 0 or 1 whose larger share is that of their class."""
    hit = ((F.col("positive") > F.col("negative")).cast("int") == F.col(label)).cast("double")
    return scored.where(F.col(label).isin(0, 1)).groupBy(*by).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("scored"))
