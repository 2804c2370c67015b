"""The linear readout against numpy, its queries, and odd rows."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from postlens.operators import linear
from postlens.plans.catalog import QUERIES

ROW = "id int, v array<double>, label int"


def solved(x, y, ridge):
    """Weights and intercept by the normal equations, the intercept free of the ridge."""
    a, b = x - x.mean(axis=0), y - y.mean()
    w = np.linalg.solve(a.T @ a / len(a) + ridge * np.eye(x.shape[1]), a.T @ b / len(a))
    return w, y.mean() - w @ x.mean(axis=0)


def test_agrees_with_numpy(spark):
    make = np.random.default_rng(2)
    x = make.normal(size=(200, 5))
    label = (x @ [1, -2, 0, 0.5, 0] + make.normal(size=200) * 0.3 > 0).astype(int)
    df = spark.createDataFrame([(i, x[i].tolist(), int(label[i])) for i in range(200)] + [(900, None, 1), (901, [9.0] * 5, None), (902, [9.0] * 5, 7)], ROW)
    model = linear.fit(df, "v", "label")
    weights, intercept = solved(x, 2.0 * label - 1, 1e-3)
    assert np.allclose(model.weights, weights, atol=1e-8) and model.intercept == pytest.approx(intercept, abs=1e-8)
    rows = {r.id: r for r in linear.score(model, df, "v").collect()}
    expected = np.clip((x @ weights + intercept + 1) / 2, 0, 1)
    assert np.allclose([rows[i].positive for i in range(200)], expected, atol=1e-8)
    assert rows[900].positive == rows[900].negative == 0.5
    got = linear.accuracy(linear.score(model, df.where("v IS NOT NULL"), "v"), "label").first()
    assert got.accuracy == pytest.approx(((expected > 0.5) == label).mean()) and got.scored == 200 and got.accuracy > 0.9


def test_without_both_classes(spark):
    one = spark.createDataFrame([(1, [1.0, 2.0], 1), (2, [0.0, 1.0], 1)], ROW)
    assert linear.fit(one, "v", "label") == linear.Readout((), 1.0)
    assert [r.positive for r in linear.score(linear.fit(one, "v", "label"), one, "v").collect()] == [1.0, 1.0]
    assert linear.fit(one.limit(0), "v", "label") == linear.Readout((), 0.0)
    constant = spark.createDataFrame([(i, [1.0, float(i)], i % 2) for i in range(6)], ROW)
    assert linear.fit(constant, "v", "label").weights[0] == pytest.approx(0, abs=1e-9)


def test_queries(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = QUERIES["linear_score"](spark, sf_dir).collect()
    assert len(rows) == docs.count() and all(0 <= float(r.positive_scores) <= 1 for r in rows)
    held = QUERIES["linear_accuracy"](spark, sf_dir).first()
    labelled = spark.read.parquet(f"{sf_dir}/labels.parquet").where(F.col("quality").isin(0, 1))
    assert 0 < held.scored < labelled.count() and held.accuracy > 0.5
