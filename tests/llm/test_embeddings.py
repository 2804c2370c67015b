"""Whitening and hard negatives against plain numpy, and their edge cases."""

from __future__ import annotations

import numpy as np
import pytest

from postlens.llm import negatives, vectors, whitening
from postlens.llm.queries import QUERIES

ROW = "vec_id long, embedding array<float>, label int, n string, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, label, "x", "y") for i, v, label in rows], ROW)


def integers(matrix):
    return np.floor(64 * np.array(matrix, np.float32).astype(float)).astype(np.int64) + 1_000_000


def plain(matrix, k=16):
    """x, per row deviation, whitened up to sign and shares, by one decomposition of the exact covariance."""
    x = integers(matrix)
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(axis=0)
    away = fit - sums / n
    values, basis = np.linalg.eigh(away.T @ away / n)
    values, basis = values[::-1], basis[:, ::-1]
    return n, ((n * x - sums) ** 2).sum(axis=1), ((x - sums / n) @ basis[:, :k]) / np.sqrt(values[:k]), values[:k] / values.sum()


def collected(df, k=16):
    rows = sorted(df.collect(), key=lambda r: (r.vec_id, r.component))
    return rows, np.array([r.whitened for r in rows]).reshape(-1, k)


def test_query_agrees_with_numpy(spark, sf_dir):
    rows, got = collected(QUERIES["op11_whiten"](spark, sf_dir))
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").orderBy("vec_id").collect()
    n, deviations, expected, shares = plain([r.embedding for r in table])
    assert [r.deviation for r in rows[::16]] == deviations.tolist() and {r.n for r in rows} == {n}
    signs = np.sign((got * expected).sum(axis=0))
    assert np.abs(got * signs - expected).max() < 1e-8
    assert np.allclose([r.explained for r in rows[:16]], shares, rtol=1e-9)
    assert max(r.identity_error for r in rows) < 1e-9


@pytest.mark.parametrize("seed", range(4))
def test_updates_follow_the_scatter(seed):
    """Ties, repeated vectors, few directions: roots stay in order and vectors at right angles."""
    make = np.random.default_rng(seed)
    width = int(make.integers(1, 24))
    data = np.floor(make.normal(size=(120, width)) * 3)
    if seed % 2:
        data[:, width // 2 :] = 0
        data[40:80] = data[0]
    parts = []
    for part in (data[:50], data[50:]):
        spectrum = whitening.Spectrum(1, part[0])
        for vector in part[1:]:
            spectrum.add(vector)
        parts.append(spectrum)
    parts[0].merge(parts[1])
    away = data - data.mean(axis=0)
    scatter = away.T @ away
    found = parts[0]
    assert found.n == 120 and np.allclose(found.mean, data.mean(axis=0))
    assert np.abs(found.basis.T @ found.basis - np.eye(width)).max() < 1e-11
    assert np.abs(found.basis * found.values @ found.basis.T - scatter).max() <= 1e-10 * max(1, np.abs(scatter).max())
    assert (np.diff(found.values) >= 0).all()


def test_secular_roots():
    make = np.random.default_rng(3)
    poles, weights = np.sort(make.random(40)), make.random(40) ** 8 + 1e-30
    origin, t = whitening.secular_roots(poles, weights)
    exact = np.linalg.eigvalsh(np.diag(poles) + np.outer(np.sqrt(weights), np.sqrt(weights)))
    assert np.abs(poles[origin] + t - exact).max() < 1e-13


def test_whitening_edges(spark):
    make = np.random.default_rng(5)
    good = make.normal(size=(40, 3)).astype(np.float32).tolist()
    good[7] = good[6]
    bad = [(90, None, 1), (91, [1.0, None, 2.0], 1), (92, [1.0, float("nan"), 2.0], 1), (93, [float("inf"), 0.0, 0.0], 1), (94, [1.0, 2.0], 1), (95, [], 1)]
    df = frame(spark, [(i, v, None) for i, v in enumerate(good)] + bad)
    rows, got = collected(whitening.whitened(df), 3)
    n, deviations, expected, _ = plain(good, 3)
    assert len(rows) == 120 and n == 39 and [r.deviation for r in rows[::3]] == deviations.tolist()
    assert np.abs(np.abs(got) - np.abs(expected)).max() < 1e-9
    twice = whitening.whitened(df.unionByName(df)).collect()
    assert len(twice) == 240 and {r.n for r in twice} == {39}
    assert whitening.whitened(df.limit(0)).collect() == []
    assert whitening.whitened(frame(spark, [(1, [], 0)])).collect() == []
    same = whitening.whitened(frame(spark, [(None, [0.5, -0.5], 0), (2, [0.5, -0.5], 1)])).collect()
    assert len(same) == 4 and {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same} == {(1, 0, 0.0, 0.0, 0.0)}
    huge = whitening.whitened(frame(spark, [(1, [3e38], 0), (2, [-3e38], 0), (3, [0.0], 0)])).collect()
    assert len(huge) == 3 and huge[0].deviation == (3 * (1 << 40)) ** 2 if (3 * (1 << 40)) ** 2 < 1 << 63 else huge[0].deviation is None


def test_deviations_beyond_a_long_are_exact_until_null():
    centre = whitening.Centre.of(3, [10, 1 << 61])
    x = np.array([[3, (1 << 61) // 3], [4, 1 << 59]])
    exact = [sum((3 * v - s) ** 2 for v, s in zip(row, (10, 1 << 61), strict=True)) for row in x.tolist()]
    assert centre.deviations(x) == [v if v < 1 << 63 else None for v in exact]


def mined(rows):
    """Brute force with ids as given; (id, vector, label), anchors by hundreds."""
    moved = [(i, np.floor(256 * np.array(v, np.float32).astype(float)).astype(int), (label + 1) % 10 if i is not None and i % 7 == 0 else label) for i, v, label in rows]
    order = lambda r: (-r[1], r[0] is None, r[0] or 0)
    found = []
    for a, x, label in moved:
        if a is None or a % 100:
            continue
        scores = [(i, int(x @ y), other) for i, y, other in moved]
        for p, score, _ in sorted((s for s in scores if s[2] == label and s[0] != a), key=order)[:5]:
            hard = sorted((s for s in scores if s[2] != label and 80 * score <= 100 * s[1] <= 100 * score), key=order)[:5]
            found += [(a, p, k + 1, i, score, s) for k, (i, s, _) in enumerate(hard)]
    return sorted(found, key=repr)


@pytest.mark.parametrize("width", [3, 20, 130])
def test_negatives_agree_with_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(negatives, "CHUNK_BYTES", 2 * 8 * width)
    make = np.random.default_rng(width)
    near = make.normal(size=width)
    rows = [(i, (make.normal(size=width) * 0.3 + near * (i % 3)).astype(np.float32).tolist(), int(i % 4)) for i in range(0, 700, 3)]
    rows += [(1000 + i, rows[5][1], i % 2) for i in range(30)] + [(None, rows[5][1], 1), rows[3], rows[3]]
    bad = [(2000, None, 1), (2100, [None] * width, 1), (2200, [float("nan")] * width, 1), (2300, rows[0][1], None), (2400, [1.0], 1)]
    found = negatives.hard_negatives(frame(spark, rows + bad))
    assert sorted((tuple(r) for r in found.collect()), key=repr) == mined(rows)


def test_negatives_edges(spark):
    some = frame(spark, [(100, [1.0, 0.0], 3), (1, [1.0, 0.0], 3), (2, [0.9, 0.0], 4)])
    assert [tuple(r) for r in negatives.hard_negatives(some).collect()] == [(100, 1, 1, 2, 65536, 256 * 230)]
    for none in (some.limit(0), some.filter("vec_id = 1"), frame(spark, [(100, [], 1), (200, [], 1)]), frame(spark, [(100, None, None)])):
        assert negatives.hard_negatives(none).collect() == []
    huge = frame(spark, [(100, [3e38], 3), (1, [3e38], 3), (2, [2e38], 4)])
    assert [r.negative_score for r in negatives.hard_negatives(huge).collect()] == [1 << 48]


def test_bounds_hold_and_prune():
    make = np.random.default_rng(8)
    smooth = np.repeat(make.normal(size=(300, 8)), 8, axis=1) * 100
    x = np.floor(smooth + make.normal(size=smooth.shape)).astype(np.int64)
    left, right, full = negatives.Summaries.of(x[:40]), negatives.Summaries.of(x), x[:40] @ x.T
    for level in range(len(left.means)):
        middle, reach = left.means[level] @ right.means[level].T, left.deviations[level] @ right.deviations[level].T
        assert (np.abs(full - middle) <= reach + 1e-6).all()
    least = np.sort(full, axis=1)[:, -5]
    a, b, score, open_ = negatives.scored(left, right, np.ones(full.shape, bool), least, np.full(40, negatives.NO_ID))
    assert (score == full[a, b]).all() and len(a) == (full >= least[:, None]).sum()
    assert open_[-1] < 0.1 * full.size


def test_usable_takes_the_usual_length(spark):
    rows = frame(spark, [(1, [1.0, 2.0], 0), (2, [1.0], 0), (3, [1.0, 2.0, 3.0], 0), (4, [], 0)])
    good, width = vectors.usable(rows, "embedding")
    assert width == 3 and [r.vec_id for r in good.collect()] == [3]
