"""PCA whitening of embeddings by incremental eigendecomposition.

Each partition takes its vectors one by one: the scatter about the running mean grows by a centred vector times
itself, and the eigenvectors follow by the roots of a secular equation, after those are put aside (deflated) that
the vector doesn't move. Partitions meet in a tree: the spectrum of one is added to another's, an eigenpair being one
more such update, and so is the distance of their means. The basis found is a very good start; a last
pass over the data projects it on the basis (Rayleigh-Ritz), which gives eigenpairs to double precision whatever
the errors of the updates have added up to.

Vectors are whole numbers far from zero, so sums are exact and each vector is centred before it is multiplied.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm import vectors
from postlens.llm.common import arrow_map
from postlens.session import written
from postlens.sources.scans import spread

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Larger products of scale and entry count as this much; sums of a batch stay within a long.
MOST = 1 << 40
#: Spectra that one task adds up.
FAN = 16
EPSILON = np.finfo(float).eps
ROUNDS = 60
_STATE = "part long, n long, sums array<decimal(38,0)>, mean binary, values binary, vectors binary"


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + sum(weights / (poles - root)), each as (nearest pole's position, distance from it).

    ``poles`` rise strictly and ``weights`` are positive: one root follows each pole. All roots are looked for at
    once: the poles on either side are replaced by one with the same value and slope, whose root is known; a step
    that leaves the bracket is replaced by its middle.
    """
    k = len(poles)
    places = np.arange(k)
    if k == 1:
        return places, weights.copy()
    gaps = np.append(np.diff(poles), weights.sum())
    middle = poles + gaps / 2
    at_middle = 1 + (weights / (poles - middle[:, None])).sum(axis=1)
    origin = np.where((at_middle < 0) & (places < k - 1), np.minimum(places + 1, k - 1), places)
    from_right = origin > places
    low, high = np.where(from_right, -gaps / 2, 0.0), np.where(from_right, 0.0, gaps / 2)
    high[-1] = gaps[-1]
    apart = poles - poles[origin][:, None]
    own, following = apart[places, places], apart[places, np.minimum(places + 1, k - 1)]
    below = np.tri(k)
    above = 1 - below
    t, open_ = (low + high) / 2, np.ones(k, bool)
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        for _ in range(ROUNDS):
            away = apart - t[:, None]
            parts = weights / away
            slopes = parts / away
            psi, psi_slope = np.einsum("ij,ij->i", parts, below), np.einsum("ij,ij->i", slopes, below)
            phi, phi_slope = np.einsum("ij,ij->i", parts, above), np.einsum("ij,ij->i", slopes, above)
            value = 1 + psi + phi
            open_ &= np.abs(value) > k * EPSILON * (1 + np.abs(psi) + np.abs(phi))
            if not open_.any():
                break
            low, high = np.where(value < 0, t, low), np.where(value < 0, high, t)
            a, b = own - t, following - t
            rest = 1 + psi - psi_slope * a + phi - phi_slope * b
            total = rest * (a + b) + psi_slope * a * a + phi_slope * b * b
            product = a * b * value
            root = np.sqrt(np.maximum(total * total - 4 * product * rest, 0))
            step = np.where(total <= 0, (total - root) / (2 * rest), 2 * product / (total + root))
            step[-1] = a[-1] + psi_slope[-1] * a[-1] * a[-1] / (1 + psi[-1] - psi_slope[-1] * a[-1])
            inside = (t + step > low) & (t + step < high)
            t = np.where(open_, np.where(inside, t + step, (low + high) / 2), t)
            open_ &= ~inside | (np.abs(step) > EPSILON * np.abs(t))
    return origin, t


def rank_one(values: np.ndarray, basis: np.ndarray, vector: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``basis * values * basis' + vector * vector'``."""
    z = basis.T @ vector
    weight = float(z @ z)
    if weight == 0:
        return values, basis
    least = 8 * EPSILON * max(abs(values[-1]), abs(values[0]), weight)
    active = np.abs(z) * np.sqrt(weight) > least
    z = np.where(active, z, 0.0)
    spots = np.flatnonzero(active)
    if not len(spots):
        return values, basis
    if (np.diff(values[spots]) <= least).any():
        values, basis, z, spots = _rotated(values, basis.copy(), z, spots, least)
    poles = values[spots]
    origin, t = secular_roots(poles, z[spots] ** 2)
    from_roots = (poles - poles[origin][:, None]) - t[:, None]
    # The weights for which these roots are exact; with them the vectors are at right angles to working precision.
    ratios = poles[:, None] - poles
    np.fill_diagonal(ratios, 1.0)
    exact = np.sqrt(np.prod(np.abs(from_roots / ratios), axis=0)) * np.sign(z[spots])
    turned = exact[:, None] / from_roots.T
    turned /= np.sqrt(np.einsum("ij,ij->j", turned, turned))
    values, found = values.copy(), basis.copy()
    values[spots] = poles[origin] + t
    found[:, spots] = basis[:, spots] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], found[:, order]


def _rotated(values, basis, z, spots, least):
    """Deflation of nearly equal eigenvalues: a rotation of the two vectors leaves one of them untouched."""
    kept = [spots[0]]
    for j in spots[1:]:
        i = kept[-1]
        length = np.hypot(z[i], z[j])
        c, s = z[j] / length, z[i] / length
        if (values[j] - values[i]) * abs(c * s) <= least:
            basis[:, [i, j]] = np.stack((c * basis[:, i] - s * basis[:, j], s * basis[:, i] + c * basis[:, j]), axis=1)
            z[i], z[j] = 0.0, length
            kept[-1] = j
        else:
            kept.append(j)
    return values, basis, z, np.array(kept)


class Spectrum:
    """Number, mean and eigendecomposition of the scatter of the vectors seen."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray | None = None, basis: np.ndarray | None = None):
        self.n, self.mean = n, mean
        self.values = np.zeros(len(mean)) if values is None else values
        self.basis = np.eye(len(mean)) if basis is None else basis

    def add(self, vector: np.ndarray) -> None:
        away = vector - self.mean
        self.n += 1
        self.mean = self.mean + away / self.n
        self.values, self.basis = rank_one(self.values, self.basis, away * np.sqrt((self.n - 1) / self.n))

    def merge(self, other: Spectrum) -> None:
        total, away = self.n + other.n, other.mean - self.mean
        for value, vector in zip(other.values, other.basis.T, strict=True):
            if value > 0:
                self.values, self.basis = rank_one(self.values, self.basis, vector * np.sqrt(value))
        self.values, self.basis = rank_one(self.values, self.basis, away * np.sqrt(self.n * other.n / total))
        self.mean = self.mean + away * (other.n / total)
        self.n = total

    def row(self) -> tuple[bytes, bytes, bytes]:
        return self.mean.tobytes(), self.values.tobytes(), np.ascontiguousarray(self.basis).tobytes()

    @staticmethod
    def of(n: int, mean: bytes, values: bytes, basis: bytes) -> Spectrum:
        values = np.frombuffer(values)
        return Spectrum(n, np.frombuffer(mean), values, np.frombuffer(basis).reshape(len(values), -1))


def _spectra(fit: DataFrame, width: int) -> DataFrame:
    """One row for each partition of ``fit(x)`` with its spectrum and the exact sums of its vectors."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, sums = None, np.zeros(width, object)
        for part in parts:
            for row in range(0, part.num_rows, 1 << 16):
                x = vectors.matrix(part.column(0).slice(row, 1 << 16), width) - OFFSET
                sums = sums + x.sum(axis=0)
                for vector in x.astype(float):
                    if seen is None:
                        seen = Spectrum(1, vector)
                    else:
                        seen.add(vector)
        if seen is not None:
            exact = pa.array([[Decimal(int(s)) for s in sums]], pa.list_(pa.decimal128(38, 0)))
            rest = [pa.array([v], pa.binary()) for v in seen.row()]
            place = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([place, pa.array([seen.n], pa.int64()), exact, *rest], names)

    names = ["part", "n", "sums", "mean", "values", "vectors"]
    return arrow_map(fit, batches, _STATE)


def _merged(group: pd.DataFrame) -> pd.DataFrame:
    spectra = [Spectrum.of(*r) for r in group.sort_values("part")[["n", "mean", "values", "vectors"]].itertuples(index=False)]
    first = spectra[0]
    for other in spectra[1:]:
        first.merge(other)
    return pd.DataFrame([(int(group["above"].iloc[0]), first.n, *first.row())], columns=["part", "n", "mean", "values", "vectors"])


def _one(states: DataFrame, width: int) -> Spectrum:
    """The spectrum of all rows of ``states``, FAN at a time."""
    states = states.drop("sums")
    last = states.agg(F.max("part")).first()[0]
    while last:
        grouped = states.withColumn("above", F.floor(F.col("part") / FAN)).groupBy("above")
        states = written(grouped.applyInPandas(_merged, _STATE.replace("sums array<decimal(38,0)>, ", "")), "spectra")
        last //= FAN
    row = states.first()
    return Spectrum.of(row.n, bytes(row.mean), bytes(row["values"]), bytes(row.vectors))


def _products(fit: DataFrame, width: int, centre: Centre, turn: np.ndarray) -> np.ndarray:
    """Sum over ``fit(x)`` of y * y' with y = turn' * (x - mean), over the whole table."""
    k = turn.shape[1]

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for part in parts:
            y = centre.away(vectors.matrix(part.column(0), width)) @ turn
            total = y.T @ y if total is None else total + y.T @ y
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()], pa.list_(pa.float64()))], ["y"])

    sums = arrow_map(fit, batches, "y array<double>").select(F.posexplode("y").alias("spot", "v")).groupBy("spot").agg(F.sum("v").alias("v"))
    found = np.zeros(k * k)
    for row in sums.collect():
        found[row.spot] = row.v
    found = found.reshape(k, k)
    return (found + found.T) / 2


@dataclass(frozen=True)
class Centre:
    """The exact mean of ``n`` whole-number vectors: near it, and what is left, as a fraction of n."""

    n: int
    near: np.ndarray
    left: tuple[int, ...]

    @staticmethod
    def of(n: int, sums: list[int]) -> Centre:
        near = [(2 * s + n) // (2 * n) for s in sums]
        return Centre(n, np.array(near, np.int64), tuple(s - n * b for s, b in zip(sums, near, strict=True)))

    def away(self, x: np.ndarray) -> np.ndarray:
        """x - mean, each entry correct to its last digits wherever the mean lies."""
        return (x - self.near).astype(float) - np.array([a / self.n for a in self.left])

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n * x - sum)^2, exactly; null if a long can't hold it."""
        steps, most = x - self.near, isqrt((1 << 62) // max(1, x.shape[1]))
        if self.n * (int(np.abs(steps).max(initial=0)) + 1) <= most:
            scaled = steps * self.n - np.array(self.left, np.int64)
            return np.einsum("ij,ij->i", scaled, scaled).tolist()
        exact = (sum((self.n * v - a) ** 2 for v, a in zip(row, self.left, strict=True)) for row in steps.tolist())
        return [v if v < 1 << 63 else None for v in exact]


@dataclass(frozen=True)
class Whitening:
    """Centre, leading eigenvalues and eigenvectors (falling) of the fit list, and what they are measured to do."""

    centre: Centre
    values: np.ndarray
    basis: np.ndarray
    trace: float
    identity_error: float | None

    @property
    def turn(self) -> np.ndarray:
        """Maps a centred vector to its whitened entries; 0 for components along which nothing varies."""
        return self.basis * np.where(self.held, 1 / np.sqrt(np.where(self.held, self.values, 1.0)), 0.0)

    @property
    def held(self) -> np.ndarray:
        return self.values > self.trace * 1e-12


def fitted(fit: DataFrame, width: int, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the vectors of ``fit(x)``, each row counted; None if there are none.

    ``fit`` is read three times: for the spectra and exact sums, for Rayleigh-Ritz, and to measure the result.
    """
    even = spread(fit)
    states = written(_spectra(even, width), "spectra")
    exact = states.select(F.posexplode("sums").alias("spot", "v")).groupBy("spot").agg(F.sum("v").alias("v")).collect()
    n = states.agg(F.sum("n")).first()[0]
    if not n:
        return None
    sums = {row.spot: int(row.v) + OFFSET * n for row in exact}
    centre = Centre.of(n, [sums[k] for k in range(width)])
    start, _ = np.linalg.qr(_one(states, width).basis[:, ::-1])
    values, turn = np.linalg.eigh(_products(fit, width, centre, start) / n)
    values, basis = values[::-1], (start @ turn)[:, ::-1]
    found = Whitening(centre, values[:components].clip(0), basis[:, :components], float(values.clip(0).sum()), None)
    covariance = _products(fit, width, centre, found.turn) / n
    error = np.abs(covariance - np.diag(found.held.astype(float)))[np.ix_(found.held, found.held)].max(initial=0)
    return Whitening(centre, found.values, found.basis, found.trace, float(error))


def whitened(rows: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row of ``rows`` and component: key, component (from 1), n, deviation, whitened, explained, identity_error.

    Rows whose vector is null, holds null or non-finite entries, or is not of the usual length, are left out. Entries
    become floor(64 * entry) + 1,000,000 (products beyond 2^40 count as that). The whitening is fitted on each
    distinct vector once. Repeated keys and null keys are rows of their own. A component along which nothing
    varies (all, if there is one distinct vector) has whitened and explained 0 and isn't part of
    identity_error. A deviation beyond a long is null. No usable rows, or empty vectors, give no rows. Other columns
    are not looked at.
    """
    plain, width = vectors.usable(rows.select(F.col(key).alias("_key"), F.col(vector).alias("x")), "x")
    schema = f"{key} {dict(rows.dtypes)[key]}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not width:
        return rows.sparkSession.createDataFrame([], schema)
    kept = written(plain.select("_key", vectors.whole(F.col("x"), SCALE, MOST, OFFSET).alias("x")), "vectors")
    model = fitted(written(kept.select("x").distinct(), "fit-list"), width, components)
    centre, turn = model.centre, model.turn

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            x = vectors.matrix(part.column(1), width)
            y = pa.FixedSizeListArray.from_arrays(pa.array((centre.away(x) @ turn).ravel()), turn.shape[1]).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(centre.deviations(x), pa.int64()), y], ["_key", "deviation", "y"])

    found = arrow_map(kept, batches, f"_key {dict(kept.dtypes)['_key']}, deviation long, y array<double>")
    share = F.array(*(F.lit(float(v) / model.trace if model.trace else 0.0) for v in model.values))
    return found.select("*", F.posexplode("y").alias("_spot", "whitened")).select(
        F.col("_key").alias(key), (F.col("_spot") + 1).alias("component"), F.lit(centre.n).cast("long").alias("n"), "deviation",
        "whitened", F.get(share, F.col("_spot")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
