"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Entries become integers x = floor(scale * c) + SHIFT, and the fit list holds each
distinct x vector once. A block Q of some more columns than components wanted is
driven towards the leading eigenvectors of the covariance V of the fit list:

1. Lanczos steps with one column bound the spectrum and tell roughly how many
   eigenvalues lie above any level.
2. A Chebyshev polynomial of V, by its three-term recurrence, is applied to Q. It
   stays small on the unwanted part of the spectrum and grows fast above it.
3. QR, then Rayleigh-Ritz in the block. The residuals of the wanted pairs certify
   them, or the next polynomial starts from the smallest Ritz value of the block.

V is never formed. Each product V Q is one Spark pass over the stored fit list:
tasks sum their rows' part of centred X'XQ, Spark adds the parts up, and what
reaches the driver is one matrix of dimensions times columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.session import stage_table

SHIFT = 1_000_000
LARGEST = 2.0**45  # entries of this size or more count as not finite: their integers would not be exact
DEGREE = 12
GROWTH = 1e10  # the most that a polynomial may favour the largest eigenvalue over the unwanted: QR must still see the others
LANCZOS = 16
TIGHT = 2e-14  # residual of a certified pair, beside the largest eigenvalue
LOOSE = 1e-11  # also certified, if further rounds no longer help
ZERO = 1e-11  # an eigenvalue below this share of the largest is none
MOST_ROUNDS = 40

Product = Callable[[np.ndarray], np.ndarray]


@dataclass
class Whitening:
    """What was fitted: numbers of the fit list and the leading eigenpairs of its covariance."""

    dim: int
    n: int
    centre: list[int]  # integers near the means, taken off before anything is summed
    sums: list[int]  # of x - centre over the fit list
    trace: float
    values: np.ndarray = field(default_factory=lambda: np.zeros(0))
    vectors: np.ndarray = field(default_factory=lambda: np.zeros((0, 0)))
    residuals: np.ndarray = field(default_factory=lambda: np.zeros(0))
    identity_error: float = 0.0
    passes: int = 0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def directions(self) -> np.ndarray:
        """What centred rows are multiplied by."""
        return self.vectors / np.sqrt(self.values) if len(self.values) else np.zeros((self.dim, 0))


def usable(vector: str) -> Column:
    """No null, and no entry that is null or not finite."""
    v = F.col(vector).cast("array<double>")
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))


def _integers(vector: str, scale: float) -> Column:
    return F.transform(F.col(vector).cast("array<double>"), lambda c: F.floor(c * scale).cast("long") + SHIFT)


def _matrix(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _added(parts: DataFrame) -> np.ndarray:
    """The sum of the arrays in column ``part``, place by place."""
    summed = parts.select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("total"))
    return np.array([r["total"] for r in sorted(summed.collect(), key=lambda r: r["pos"])])


def _sums(fit: DataFrame, dim: int, centre: list[int]) -> tuple[int, list[int], int]:
    """(rows, sums of entries, sum of their squares) of the fit list, exact, with ``centre`` taken off."""
    base = np.array(centre, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, [0] * dim, 0
        for batch in batches:
            x = _matrix(batch, dim) - base
            n += len(x)
            high, low = x >> 20, x & 0xFFFFF
            total = [t + (int(a) << 20) + int(b) for t, a, b in zip(total, high.sum(0), low.sum(0), strict=True)]
            most = int(np.abs(x).max(initial=0))
            exact = x if most * most * max(x.size, 1) < 2**62 else x.astype(object)
            squares += int((exact * exact).sum())
        values = [Decimal(v) for v in (n, *total, squares)]
        yield pa.RecordBatch.from_arrays([pa.array([values], pa.list_(pa.decimal128(38, 0)))], ["part"])

    total = [int(v) for v in _added(fit.mapInArrow(run, "part array<decimal(38,0)>"))]
    return total[0], total[1:-1], total[-1]


def _pass(fit: DataFrame, model: Whitening, work: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """``work`` of centred rows, added up over the fit list."""
    base, mean, dim = np.array(model.centre, np.int64), model.mean, model.dim

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            total += work((_matrix(batch, dim) - base) - mean).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], ["part"])

    model.passes += 1
    return _added(fit.mapInArrow(run, "part array<double>"))


def bounds(product: Product, dim: int, steps: int, draw: np.random.Generator) -> tuple[float, float, Callable[[int], float]]:
    """(least, largest eigenvalue, level that about so many eigenvalues exceed), by Lanczos."""
    q = draw.standard_normal(dim)
    basis = [q / np.linalg.norm(q)]
    alpha: list[float] = []
    beta: list[float] = []
    for _ in range(min(steps, dim)):
        w = product(basis[-1][:, None])[:, 0]
        alpha.append(float(w @ basis[-1]))
        for _ in range(2):  # full orthogonalisation
            w -= np.array(basis).T @ (np.array(basis) @ w)
        beta.append(float(np.linalg.norm(w)))
        if beta[-1] <= 1e-12 * max(alpha[0], alpha[-1], 1e-300):
            beta[-1] = 0.0
            break
        basis.append(w / beta[-1])
    ritz, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[:-1], 1) + np.diag(beta[:-1], -1))
    slack = np.abs(beta[-1] * s[-1])
    above = np.cumsum((s[0] ** 2 * dim)[::-1])

    def level(count: int) -> float:
        return float(ritz[::-1][min(len(ritz) - 1, int(np.searchsorted(above, count)))])

    return max(0.0, float(ritz[0] - slack[0])), float(ritz[-1] + slack[-1]), level


def chebyshev(product: Product, q: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """A polynomial of the operator that is at most 1 on [low, high], scaled to 1 at ``top``, applied to ``q``."""
    half, middle = (high - low) / 2, (high + low) / 2
    sigma = first = half / (top - middle)
    before, now = q, (product(q) - middle * q) * (sigma / half)
    for _ in range(degree - 1):
        new = 1 / (2 / first - sigma)
        before, now = now, (product(now) - middle * now) * (2 * new / half) - before * (sigma * new)
        sigma = new
    return now


def leading(product: Product, dim: int, k: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors, residuals beside the largest) of the ``k`` leading pairs.

    A block that lies within a flat part of the spectrum parts its pairs hardly at all; if its rounds run out, it is doubled.
    """
    k = min(k, dim)
    width = min(dim, k + max(k, 16))
    draw = np.random.default_rng(seed)
    q = np.linalg.qr(draw.standard_normal((dim, width)))[0]
    low = high = top = 0.0
    if width < dim:
        low, top, level = bounds(product, dim, LANCZOS, draw)
        high = level(width)
    best, stuck, rounds = np.inf, 0, 0
    while rounds < MOST_ROUNDS:
        rounds += 1
        if width < dim and low < high < top:
            degree = int(np.log(2 * GROWTH) / np.arccosh(max(1.01, (2 * top - high - low) / (high - low))))
            q = np.linalg.qr(chebyshev(product, q, low, high, top, min(DEGREE, max(1, degree))))[0]
        image = product(q)
        small = q.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        size = max(float(values[0]), 1e-300)
        residuals = np.linalg.norm(image[:, :k] - q[:, :k] * values[:k], axis=0) / size
        worst = float(residuals.max())
        stuck = 0 if worst < best / 2 else stuck + 1
        best = min(best, worst)
        if worst <= TIGHT or (worst <= LOOSE and stuck >= 2):
            return values[:k], q[:, :k], residuals
        high, top = float(values[-1]), max(top, float(values[0]))
        if not low < high:  # the unwanted part is flat, or nothing is left of it
            low = max(0.0, high - 1e-3 * size)
        if rounds == MOST_ROUNDS and width < dim:
            width = min(dim, 2 * width)
            q = np.linalg.qr(np.hstack([q, draw.standard_normal((dim, width - q.shape[1]))]))[0]
            best, stuck, rounds = np.inf, 0, 0
    raise ArithmeticError(f"eigenpairs are not certified after {MOST_ROUNDS} rounds: residual {best:.1e}")


def fit(vectors: DataFrame, k: int = 16, vector: str = "embedding", scale: float = 64.0) -> tuple[Whitening | None, DataFrame]:
    """The whitening learnt from all distinct vectors, and the stored fit list (column x).

    Vectors that are null, empty, or hold entries that are null, not finite or of
    LARGEST or more take no part; with several lengths, only the most frequent one
    (the longer on a tie) does. Components whose eigenvalue is zero beside the
    largest are left out, so fewer than ``k`` may come back: none for a single
    distinct vector. Without usable vectors there is no model.
    """
    rows = vectors.filter(usable(vector)).select(_integers(vector, scale).alias("x"))
    fitted = stage_table(rows.distinct(), "fit")
    lengths = vectors.filter(usable(vector)).groupBy(F.size(vector).alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if lengths is None:
        return None, fitted
    dim = lengths["dim"]
    own = fitted.filter(F.size("x") == dim)
    centre = [0] * dim
    n, sums, _ = _sums(own, dim, centre)
    centre = [s // n for s in sums]
    _, sums, squares = _sums(own, dim, centre)
    model = Whitening(dim, n, centre, sums, (n * squares - sum(s * s for s in sums)) / (n * n))
    if model.trace <= 0:
        return model, own

    def product(q: np.ndarray) -> np.ndarray:
        return _pass(own, model, lambda z: z.T @ (z @ q), q.size).reshape(q.shape) / n

    values, found, residuals = leading(product, dim, k)
    some = values > ZERO * values[0]
    model.values, model.vectors, model.residuals = values[some], found[:, some], residuals[some]
    turn, width = model.directions, int(some.sum())

    def moments(z: np.ndarray) -> np.ndarray:
        w = z @ turn
        return np.concatenate([(w.T @ w).ravel(), w.sum(0)])

    total = _pass(own, model, moments, width * width + width) / n
    covariance = total[: width * width].reshape(width, width) - np.outer(total[width * width :], total[width * width :])
    model.identity_error = float(np.abs(covariance - np.eye(width)).max())
    return model, own


def transform(vectors: DataFrame, model: Whitening, vector: str = "embedding", scale: float = 64.0) -> DataFrame:
    """All columns of the usable rows, with deviation (decimal) and whitened (array, one entry a component) beside them.

    deviation is the exact sum over dimensions of (n x - S) squared. Columns of
    ``vectors`` with these two names are replaced.
    """
    n, dim, base, sums, mean, turn = model.n, model.dim, np.array(model.centre, np.int64), np.array(model.sums, object), model.mean, model.directions
    constant = sum(int(s) * int(s) for s in sums)
    largest = max((abs(int(s)) for s in sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, dim) - base
            most = int(np.abs(x).max(initial=0))
            fits = most * max(most, largest) * dim < 2**62
            z = x if fits else x.astype(object)
            squares, cross = (z * z).sum(1), z @ (sums.astype(np.int64) if fits else sums)
            deviation = squares.astype(object) * (n * n) - cross.astype(object) * (2 * n) + constant
            w = (x - mean) @ turn
            out = [batch.column("row"), pa.array([Decimal(int(d)) for d in deviation], pa.decimal128(38, 0)), pa.array(list(w), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(out, ["row", "deviation", "whitened"])

    names = [c for c in vectors.columns if c not in ("deviation", "whitened")]
    boxed = vectors.filter(usable(vector) & (F.size(vector) == dim)).select(F.struct(*names).alias("row"), _integers(vector, scale).alias("x"))
    kind = boxed.schema["row"].dataType.simpleString()
    done = boxed.mapInArrow(run, f"row {kind}, deviation decimal(38,0), whitened array<double>")
    return done.select("row.*", "deviation", "whitened")


def components(vectors: DataFrame, k: int = 16, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """One row for each usable row and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Rows that repeat an id, or have none, each get theirs. An empty table, or one
    with a single distinct vector, has no component and gives no row.
    """
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    model, _ = fit(rows, k, "embedding")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if model is None or not len(model.values):
        return vectors.sparkSession.createDataFrame([], schema)
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.values])
    done = transform(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return done.select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        F.col("deviation").cast("long").alias("deviation"),
        "whitened",
        F.get(explained, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
