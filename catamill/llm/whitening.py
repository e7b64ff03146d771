"""Whitening of vectors: their covariance, centred before it is multiplied, its leading components, and projections.

Components are whole numbers, so sums are exact. The covariance is taken about the whole number next to each mean, and
what is left of the mean (half a unit at most) is put right at the end; as long as the sums stay below 2^53 they are exact
in doubles too, whatever the order of their parts. The driver holds matrices of the dimension alone. It reduces the
covariance to tridiagonal form by Householder reflections, finds the largest eigenvalues by bisection on Sturm counts,
and their vectors by inverse iteration, in which vectors of a cluster of eigenvalues are made orthogonal in each step.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catamill.llm.common import result, scratch
from catamill.llm.vectors import SCALE, Whole, blocks, whole_vectors

#: Added to each whole component.
OFFSET = 100_000
EPS = float(np.finfo(np.float64).eps)


# Leading eigenvectors of a symmetric matrix


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """Diagonal, off-diagonal and the unit reflectors (None: no step needed) of a symmetric matrix."""
    a, n = a.astype(np.float64).copy(), len(a)
    reflectors: list[np.ndarray | None] = []
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        if not np.any(v[1:]):
            reflectors.append(None)
            continue
        scale = np.abs(v).max()
        v /= scale
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        v /= np.linalg.norm(v)
        reflectors.append(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        p -= (v @ p) * v
        rest -= 2 * (np.outer(v, p) + np.outer(p, v))
        column = a[k + 1 :, k]
        column -= 2 * v * (v @ column)
        a[k, k + 1 :] = column
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_counts(d: np.ndarray, e2: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """How many eigenvalues are below each of `at`: negative terms of the sequence. least: stands for pivots next to zero."""
    q = d[0] - at
    count = (q < 0).astype(np.int64)
    for k in range(1, len(d)):
        q = np.where(np.abs(q) < least, -least, q)
        q = d[k] - at - e2[k - 1] / q
        count += q < 0
    return count


def largest_eigenvalues(d: np.ndarray, e: np.ndarray, most: int) -> np.ndarray:
    """The `most` largest, falling, each to the last bits."""
    n = len(d)
    radius = np.abs(np.concatenate([[0], e])) + np.abs(np.concatenate([e, [0]]))
    norm = float(np.abs(d).max() + radius.max()) or 1.0
    least = max(np.finfo(np.float64).tiny, (EPS * norm) ** 2 * 1e-4)
    rank = n - np.arange(1, most + 1)  # so many are smaller
    lo, hi = np.full(most, (d - radius).min() - 2 * EPS * norm * n), np.full(most, (d + radius).max() + 2 * EPS * norm * n)
    for _ in range(200):
        mid = lo + (hi - lo) / 2
        if ((hi - lo) <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi)) + least).all() or ((mid == lo) | (mid == hi)).all():
            break
        above = sturm_counts(d, e * e, mid, least) <= rank
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)
    return lo + (hi - lo) / 2


class _Shifted:
    """Triangular factors of a tridiagonal matrix less a shift, rows swapped where the pivot is the smaller one."""

    def __init__(self, d: np.ndarray, e: np.ndarray, shift: float, least: float):
        n = len(d)
        u0, u1, u2, low = d - shift, np.append(e, 0.0), np.zeros(n), np.zeros(n)
        swapped = np.zeros(n, bool)
        for k in range(n - 1):
            below, diagonal, right = e[k], u0[k + 1], u1[k + 1]
            if abs(below) > abs(u0[k]):
                swapped[k] = True
                factor = u0[k] / below
                first = u1[k]
                u0[k], u1[k], u2[k] = below, diagonal, right
                u0[k + 1], u1[k + 1] = first - factor * diagonal, -factor * right
            else:
                if abs(u0[k]) < least:
                    u0[k] = least
                factor = below / u0[k]
                u0[k + 1] = diagonal - factor * u1[k]
            low[k] = factor
        if abs(u0[-1]) < least:
            u0[-1] = least
        self.u0, self.u1, self.u2, self.low, self.swapped = u0, u1, u2, low, swapped

    def solve(self, b: np.ndarray) -> np.ndarray:
        b, n = b.copy(), len(b)
        for k in range(n - 1):
            if self.swapped[k]:
                b[k], b[k + 1] = b[k + 1], b[k]
            b[k + 1] -= self.low[k] * b[k]
        for k in range(n - 1, -1, -1):
            if k + 1 < n:
                b[k] -= self.u1[k] * b[k + 1]
            if k + 2 < n:
                b[k] -= self.u2[k] * b[k + 2]
            b[k] /= self.u0[k]
        return b


def tridiagonal_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray, close: float = 1e-3, steps: int = 6) -> np.ndarray:
    """Unit vectors of the falling eigenvalues, as columns. Those nearer than close * norm are a cluster: each vector is
    made orthogonal to the earlier ones of its cluster in every step."""
    n = len(d)
    norm = float(np.abs(d).max() + 2 * (np.abs(e).max() if len(e) else 0)) or 1.0
    draw, out, shift = np.random.default_rng(1), np.zeros((n, len(values))), np.inf
    begin = 0
    for k, value in enumerate(values):
        if k and values[k - 1] - value > close * norm:
            begin = k
        # Equal values need shifts of their own.
        shift = min(value, shift - 10 * EPS * norm) if k > begin else value
        factors = _Shifted(d, e, shift, EPS * norm)
        own = out[:, begin:k]
        z = draw.normal(size=n)
        for _ in range(steps):
            z = factors.solve(z / np.abs(z).max())
            for _ in range(2):  # once more for what rounding leaves
                z -= own @ (own.T @ z)
            z /= np.linalg.norm(z)
        out[:, k] = z
    return out


def leading(a: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns."""
    if len(a) == 1:
        return a[0].astype(np.float64), np.ones((1, 1))
    d, e, reflectors = tridiagonal(a)
    values = largest_eigenvalues(d, e, min(most, len(a)))
    z = tridiagonal_vectors(d, e, values)
    for k in range(len(reflectors) - 1, -1, -1):
        if (v := reflectors[k]) is not None:
            z[k + 1 :] -= 2 * np.outer(v, v @ z[k + 1 :])
    return values, z / np.linalg.norm(z, axis=0)


# Over the table


@dataclass(frozen=True)
class Moments:
    """Of whole vectors without OFFSET: n rows, the whole number next to each mean, and n times what the mean exceeds it by."""

    n: int
    middle: np.ndarray
    rest: np.ndarray

    @property
    def over(self) -> np.ndarray:
        return self.rest / self.n


@dataclass(frozen=True)
class Whitener:
    """components: unit columns; values: their eigenvalues; trace: of the covariance."""

    moments: Moments
    values: np.ndarray
    components: np.ndarray
    trace: float

    @property
    def usable(self) -> np.ndarray:
        """Components with variance beyond rounding."""
        return (self.values > 8 * EPS * self.trace * len(self.components)) & (self.trace > 0)

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened rows; not a number where a component has no variance."""
        centred = (x - self.moments.middle) - self.moments.over
        size = np.where(self.usable, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return centred @ self.components / size


def moments(whole: Whole) -> Moments:
    width = max(1, whole.longest)

    def run(batches) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(width, np.int64)
        for _, x in blocks(batches, width):
            sums += x.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(sums)], ["i", "s"])

    sums = [0] * width
    for r in whole.rows.select("x").mapInArrow(run, "i int, s long").groupBy("i").agg(F.sum("s").alias("s")).collect():  # one row a dimension
        sums[r.i] = r.s
    middle = [(2 * s + whole.n) // (2 * whole.n) for s in sums]
    return Moments(whole.n, np.array(middle, np.int64), np.array([s - whole.n * m for s, m in zip(sums, middle, strict=True)], np.int64))


def _products(rows: DataFrame, width: int, size: int, centred) -> np.ndarray:
    """Sum over all rows of centred(x)^T centred(x), of `size` columns."""
    i, j = np.triu_indices(size)

    def run(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for _, x in blocks(batches, width):
            y = centred(x)
            total += y.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], ["i", "j", "s"])

    out = np.zeros((size, size))
    for r in rows.select("x").mapInArrow(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():  # size * (size + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


def fit(whole: Whole, most: int = 8) -> Whitener:
    width, m = max(1, whole.longest), moments(whole)
    covariance = _products(whole.rows, width, width, lambda x: (x - m.middle).astype(np.float64))
    covariance = (covariance - np.outer(m.rest, m.over)) / m.n
    values, components = leading(covariance, most)
    return Whitener(m, values, components, float(np.trace(covariance)))


def identity_error(whole: Whole, w: Whitener) -> float | None:
    """Largest absolute entry of the covariance of whitened rows less the identity, over components with variance."""
    use, width = w.usable, max(1, whole.longest)
    k = int(use.sum())
    if not k:
        return None
    # A last column of ones gives the sums.
    both = lambda x: np.hstack([w.project(x)[:, use], np.ones((len(x), 1))])
    found = _products(whole.rows, width, k + 1, both)
    mean = found[:k, k] / w.moments.n
    return float(np.abs(found[:k, :k] / w.moments.n - np.outer(mean, mean) - np.eye(k)).max())


def deviations(x: np.ndarray, m: Moments) -> list[int]:
    """Sum over dimensions of (n * x - sum of x)^2 of each row, exact; the offset cancels."""
    far = int(m.n) * int(np.abs(x - m.middle).max(initial=0)) + int(np.abs(m.rest).max(initial=0))
    if x.shape[1] * far * far < 1 << 63:
        d = m.n * (x - m.middle) - m.rest
        return (d * d).sum(axis=1).tolist()
    d = m.n * (x - m.middle).astype(object) - m.rest.astype(object)
    return (d * d).sum(axis=1).tolist()


def whiten(df: DataFrame, most: int = 8) -> DataFrame:
    """df: vec_id, embedding. For each vector that is finite and each component up to `most` (or the dimension): vec_id,
    component, n, deviation, whitened, explained, identity_error, deviation_exact.

    Null vectors and those with a null or non-finite component are left out. Shorter vectors end with zeros. Repeated rows
    and null ids all count and are all returned; equal vectors have equal values. Where a component has no variance beyond
    rounding, as with equal vectors or fewer vectors than components, `whitened` is null and identity_error leaves it out;
    without any variance identity_error is null and explained 0. An empty table gives no rows. Other columns don't matter.
    `deviation` is null where it exceeds a long, as from some millions of vectors on; deviation_exact holds it always."""
    kinds = "component int, n long, deviation long, whitened double, explained double, identity_error double, deviation_exact decimal(38,0)"
    schema = T.StructType([T.StructField("vec_id", df.schema["vec_id"].dataType), *T.StructType.fromDDL(kinds).fields])
    with scratch(df.sparkSession):
        whole = whole_vectors(df, "embedding", ["vec_id"], "whole-vectors")
        if not whole.n:
            return df.sparkSession.createDataFrame([], schema)
        w = fit(whole, most)
        error, width, k = identity_error(whole, w), max(1, whole.longest), len(w.values)
        shared = df.sparkSession.sparkContext.broadcast(w)  # (dimension) x (components) numbers

        def run(batches) -> Iterator[pa.RecordBatch]:
            w = shared.value
            explained = np.maximum(w.values, 0) / w.trace if w.trace > 0 else np.zeros(k)
            for batch, x in blocks(batches, width):
                rows, dev = len(x), deviations(x, w.moments)
                each = np.repeat(np.arange(rows), k)
                exact = pa.array([Decimal(v) for v in dev], pa.decimal128(38, 0)).take(pa.array(each))
                long = pa.array([v if v < 1 << 63 else None for v in dev], pa.int64()).take(pa.array(each))
                white = w.project(x).reshape(-1)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, w.moments.n)), long,
                        pa.array(white, mask=np.isnan(white)), pa.array(np.tile(explained, rows)), pa.array([error] * (rows * k), pa.float64()), exact,
                    ],
                    schema.names,
                )

        return result(whole.rows.select("vec_id", "x").mapInArrow(run, schema), "whitened")
