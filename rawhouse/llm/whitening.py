"""Embedding whitening by Chebyshev-filtered subspace iteration.

Vectors are put on an integer grid, x = floor(scale * c) + shift, so that their
number and sums per dimension are exact.  The leading eigenvectors of the
covariance V (divisor n) come from products V Q with a block Q of a few more
columns than components: every product is one distributed pass in which each
task centres its rows, multiplies them with Q and with their own transpose, and
returns one sum of a vector's length a column.  A round applies a Chebyshev
polynomial of V to the block by its three-term recurrence: the unwanted spectrum,
from a lower bound (a few Lanczos steps that ride along with the first products)
up to the block's smallest Ritz value, stays within one and the wanted part grows;
then come QR and Rayleigh-Ritz.  Rounds end when the block is
certified: every wanted pair's residual, and the angle error that follows from
it and the distance to the next Ritz value, are at rounding level.

The driver holds matrices of one dimension by the block and nothing that grows
with the rows; tasks hold one Arrow batch.  The grid vectors are written to the
shared checkpoint folder once, so a lost executor repeats its part of a pass.

Defined results: rows whose vector is null or empty, or holds a null or
non-finite entry, are left out; repeated rows count as often as they stand and
are all returned; a null id is kept; vectors of unequal lengths raise
ValueError; a table without a vector gives no rows.  Components whose variance is
zero to rounding cannot be whitened and are left out, so constant vectors give
no rows.  Equal eigenvalues leave their vectors' directions within their plane
open; one basis is chosen and holds for all rows.
"""

from __future__ import annotations

import decimal
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawhouse.llm.common import free_name
from rawhouse.session import discard, materialize

GUARDS = 16  # columns of the block beside the wanted ones
DEGREE = 12  # of the Chebyshev polynomial, at most
LANCZOS = 10  # steps of the spectrum's lower bound
ROUNDS = 60
SEED = 42
GROWTH = 1e8
RESIDUAL = 1e-13  # of the largest eigenvalue: what double precision passes leave
ANGLE = 1e-10
LEAST = 1e-11  # components below this share of the largest eigenvalue are rounding


@dataclass(frozen=True)
class Whitener:
    """Statistics of the fit list and its leading components.

    ``vectors`` has a unit eigenvector a column, by falling ``values``; ``trace``
    is the covariance's; ``residual`` and ``rounds`` tell how the block was certified.
    """

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residual: float
    rounds: int
    passes: int


def grid(vector: Column, scale: int, shift: int) -> Column:
    """floor(scale * c) + shift of every entry as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))) + F.lit(shift).cast("long"))


def finite(vector: Column) -> Column:
    """Whether a vector is neither null nor empty and holds only finite entries."""
    bad = lambda c: c.isNull() | F.isnan(c.cast("double")) | (F.abs(c.cast("double")) == F.lit(float("inf")))
    return F.coalesce((F.size(vector) > 0) & ~F.exists(vector, bad), F.lit(False))


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.int64).reshape(-1, dim)


def _summed(points: DataFrame, shape: tuple[int, int], task) -> np.ndarray:
    """Sum over all tasks of a matrix that ``task`` makes of each batch of rows."""
    rows, cols = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                part = task(batch.column(0))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(range(rows * cols), pa.int32()), pa.array(total.ravel(), pa.float64())], names=["k", "v"])

    found = points.select("x").mapInArrow(run, "k int, v double").groupBy("k").agg(F.sum("v").alias("v")).collect()
    out = np.zeros(rows * cols)
    for r in found:
        out[r["k"]] = r["v"]
    return out.reshape(shape)


class _Covariance:
    """Products of the covariance with a block, one distributed pass each."""

    def __init__(self, points: DataFrame, n: int, sums: list[int]) -> None:
        self.points, self.n, self.dim, self.passes = points, n, len(sums), 0
        self.sums = np.array(sums, object)
        # The mean's whole part and its remainder: x - mean loses no digits.
        self.whole = np.array([s // n for s in sums], np.int64)
        self.part = np.array([(s % n) / n for s in sums])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.whole).astype(np.float64) - self.part

    def times(self, q: np.ndarray) -> np.ndarray:
        """V Q by a pass over all rows: the sum of each task's Xc^T (Xc Q), over n."""
        self.passes += 1
        whole, part, dim = self.whole, self.part, self.dim

        def task(column: pa.Array) -> np.ndarray:
            x = (_rows(column, dim) - whole).astype(np.float64) - part
            return x.T @ (x @ q)

        return _summed(self.points, q.shape, task) / self.n

    def trace(self) -> float:
        whole, part, dim = self.whole, self.part, self.dim

        def task(column: pa.Array) -> np.ndarray:
            x = (_rows(column, dim) - whole).astype(np.float64) - part
            return (x * x).sum(axis=0)[:, None]

        return float(_summed(self.points, (dim, 1), task).sum() / self.n)


def _ritz(q: np.ndarray, vq: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ritz values (falling), vectors and their products with V."""
    h = q.T @ vq
    values, turn = np.linalg.eigh((h + h.T) / 2)
    turn = turn[:, ::-1]
    return values[::-1], q @ turn, vq @ turn


class _LowerBound:
    """A safe lower bound of the spectrum by Lanczos steps on one more column that
    rides along with the block's products: the smallest Ritz value less the norm of
    the last remainder."""

    def __init__(self, dim: int, seed: int) -> None:
        first = np.random.default_rng(seed).standard_normal(dim)
        self.basis = [first / np.linalg.norm(first)]
        self.diagonal: list[float] = []
        self.beside: list[float] = []
        self.value = 0.0

    def product(self, v: _Covariance, block: np.ndarray) -> np.ndarray:
        """V times the block, and one Lanczos step."""
        if self.basis is None:
            return v.times(block)
        out = v.times(np.column_stack((block, self.basis[-1])))
        rest = out[:, -1]
        self.diagonal.append(float(rest @ self.basis[-1]))
        known = np.column_stack(self.basis)
        for _ in range(2):
            rest = rest - known @ (known.T @ rest)
        norm = float(np.linalg.norm(rest))
        ritz = np.linalg.eigvalsh(np.diag(self.diagonal) + np.diag(self.beside, 1) + np.diag(self.beside, -1))
        if len(self.diagonal) >= min(LANCZOS, v.dim):
            self.value = max(0.0, float(ritz[0]) - norm)
            self.basis = None
        elif norm <= 1e-12 * max(abs(ritz[-1]), 1e-300):
            self.basis = None  # an invariant subspace: nothing is known beyond it
        else:
            self.beside.append(norm)
            self.basis.append(rest / norm)
        return out[:, :-1]


def _degree(low: float, cut: float, last: float, top: float, most: int) -> int:
    """The degree at which the largest and the last wanted eigenvalue grow apart
    by at most GROWTH, so that no column drowns in rounding of another."""
    centre, half = (cut + low) / 2, (cut - low) / 2
    apart = math.acosh(max((top - centre) / half, 1.0)) - math.acosh(max((last - centre) / half, 1.0))
    return max(2, min(most, int(math.log(GROWTH) / apart) if apart > 0 else most))


def _filtered(v: _Covariance, bound: _LowerBound, q: np.ndarray, vq: np.ndarray, cut: float, last: float, top: float, degree: int) -> np.ndarray:
    """The block under a Chebyshev polynomial of V that stays within one on the
    unwanted spectrum [bound, cut], scaled to one at ``top``; V q is already known."""
    low = min(bound.value, 0.99 * cut)
    centre, half = (cut + low) / 2, (cut - low) / 2
    ratio = first = half / (top - centre)
    before, now = q, (vq - centre * q) * (ratio / half)
    for _ in range(_degree(low, cut, last, top, degree) - 1):
        following = 1 / (2 / first - ratio)
        before, now = now, (bound.product(v, now) - centre * now) * (2 * following / half) - ratio * following * before
        ratio = following
    return now


def leading(v: _Covariance, components: int, guards: int = GUARDS, degree: int = DEGREE, seed: int = SEED, max_rounds: int = ROUNDS):
    """(values, vectors, largest residual, rounds) of the leading eigenpairs.

    Raises RuntimeError if ``max_rounds`` rounds do not certify them.
    """
    wanted = min(components, v.dim)
    block = min(v.dim, wanted + guards)
    bound = _LowerBound(v.dim, seed + 1)
    q, _ = np.linalg.qr(np.random.default_rng(seed).standard_normal((v.dim, block)))
    values, q, vq = _ritz(q, bound.product(v, q))
    best, stale = np.inf, 0
    for done in range(max_rounds + 1):
        top = max(float(values[0]), 1e-300)
        live = values[:wanted] > LEAST * top
        if not live.any():
            return values[:0], q[:, :0], 0.0, done
        n_live = int(live.sum())
        residual = float(np.linalg.norm(vq - q * values, axis=0)[:n_live].max()) / top
        # The wanted span's angle error is bounded by the residual over the distance to
        # what the block leaves out; a block as wide as the vectors leaves nothing out.
        gap = (float(values[n_live - 1] - values[-1]) if block < v.dim else np.inf) / top
        stale = stale + 1 if residual > best / 2 else 0
        best = min(best, residual)
        at_rounding = residual <= RESIDUAL or stale >= 2 and residual <= 1e3 * RESIDUAL
        if block == v.dim or at_rounding and (residual <= ANGLE * gap or gap <= 1e-9 or stale >= 2):
            return values[:n_live], q[:, :n_live], residual, done
        cut = min(max(float(values[-1]), 1e-14 * top), 0.98 * top)
        last = max(float(values[n_live - 1]), cut)
        q, _ = np.linalg.qr(_filtered(v, bound, q, vq, cut, last, top, degree))
        values, q, vq = _ritz(q, bound.product(v, q))
    raise RuntimeError(f"components not certified after {max_rounds} rounds: residual {residual:.1e} of the largest eigenvalue")


def _sums(points: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension; each task adds its rows up."""
    size = F.size("x")
    n, least, most = points.agg(F.count("*"), F.min(size), F.max(size)).first()
    if not n:
        return 0, []
    if least != most:
        raise ValueError(f"vectors of unequal lengths: {least} to {most}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = _rows(batch.column(0), most)
                # High and low halves: neither sum can overflow in a batch.
                sums = [int(h) * (1 << 32) + int(r) for h, r in zip((x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0))]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(most), pa.int32()), pa.array([decimal.Decimal(s) for s in sums], pa.decimal128(38, 0))], names=["k", "s"]
                )

    found = points.select("x").mapInArrow(run, "k int, s decimal(38,0)").groupBy("k").agg(F.sum("s").alias("s")).collect()
    return int(n), [int(r["s"]) for r in sorted(found)]


def fit_whitener(
    points: DataFrame, components: int = 32, guards: int = GUARDS, degree: int = DEGREE, seed: int = SEED
) -> Whitener | None:
    """Fit on a frame with a column ``x`` (array<long>, one length); None without rows.

    ``points`` is read once a pass: give a stored frame.
    """
    n, sums = _sums(points)
    if not n:
        return None
    v = _Covariance(points, n, sums)
    values, vectors, residual, rounds = leading(v, components, guards, degree, seed)
    # One sign for all: the entry of largest size is positive.
    if vectors.size:
        vectors = vectors * np.where(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
    return Whitener(n, tuple(sums), values, vectors, v.trace(), residual, rounds, v.passes)


def deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int]:
    """Sum over dimensions of (n x - S)^2 of every row, exact."""
    low, high = (s // n for s in (sums.min(), sums.max()))
    reach = max(int(x.max(initial=0)) - int(low), int(high) - int(x.min(initial=0)) + 1, 1) * n
    if reach * reach * x.shape[1] < 2**63 and (abs(int(x.max(initial=0))) + abs(int(x.min(initial=0)))) * n < 2**62:
        d = x * np.int64(n) - sums.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - sums
    return [int((row * row).sum()) for row in d]


def whiten(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    guards: int = GUARDS,
    degree: int = DEGREE,
    seed: int = SEED,
) -> tuple[DataFrame, Whitener | None]:
    """(id, n, deviation, whitened) of every usable row, and the fitted whitener.

    ``whitened`` is an array by component: the centred grid vector projected on
    it, over the root of its eigenvalue.  ``deviation`` is the exact sum over
    dimensions of (n x - S)^2; one beyond a long raises OverflowError.
    """
    spark = df.sparkSession
    vector = F.col(f"`{vector_col}`")
    name = free_name(df, "x")
    points = materialize(
        df.where(finite(vector)).select(F.col(f"`{id_col}`").alias("id"), grid(vector, scale, shift).alias(name)).toDF("id", "x"), "whitening"
    )
    schema = points.select("id", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("deviation"), F.array(F.lit(0.0)).alias("whitened")).schema
    model = fit_whitener(points, components, guards, degree, seed)
    if model is None or not model.values.size:
        discard(points)
        return spark.createDataFrame([], schema), model
    n, dim = model.n, len(model.sums)
    total = np.array(model.sums, object)
    whole = np.array([s // n for s in model.sums], np.int64)
    part = np.array([(s % n) / n for s in model.sums])
    turn = model.vectors / np.sqrt(model.values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch.column(1), dim)
            found = ((x - whole).astype(np.float64) - part) @ turn
            ends = pa.array(np.arange(0, found.size + 1, found.shape[1]), pa.int32())
            columns = [
                batch.column(0),
                pa.array(np.full(len(x), n), pa.int64()),
                pa.array(deviations(x, n, total), pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(found.ravel())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "n", "deviation", "whitened"])

    return points.mapInArrow(project, schema), model


def identity_error(whitened: DataFrame, components: int, n: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` minus the identity;
    one more pass over the result's own numbers."""
    k = components

    def task(column: pa.Array) -> np.ndarray:
        w = np.asarray(column.flatten(), np.float64).reshape(-1, k)
        return np.concatenate((w.T @ w, w.sum(axis=0)[None, :]))

    got = _summed(whitened.select(F.col("whitened").alias("x")), (k + 1, k), task) / n
    return float(np.abs(got[:k] - np.outer(got[k], got[k]) - np.eye(k)).max())


__all__ = ["Whitener", "deviations", "finite", "fit_whitener", "grid", "identity_error", "leading", "whiten"]
