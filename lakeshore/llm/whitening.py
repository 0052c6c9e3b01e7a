"""Embedding whitening: pivoted Cholesky of the centred scatter, then one-sided Jacobi on the factor.

Entries become whole numbers x (floor of 64 times the entry, plus a million).
The fit reads the vectors three times as Spark jobs that each return sums whose
size depends on the dimension alone: exact sums of x, the scatter of the
centred vectors, and the covariance of the whitened ones, which measures how
far they are from white.  The scatter V is factored as P'VP = LL' with diagonal
pivoting, and Jacobi rotations make the columns of L orthogonal: their squared
norms are the eigenvalues of V and the normalised columns its eigenvectors (in
pivot order).  Working on L keeps the small eigenvalues' relative precision.

Centring is exact up to one rounding: x less the whole number next to the mean
is exact, and the remaining shift is a fraction of one.

Defined cases: a vector that is NULL, empty, or holds NULL or non-finite entries
(64 times the entry beyond 2**61 counts as such) is dropped; of several
dimensions the one with most vectors is taken (ties: the larger), vectors of
others are dropped; repeated rows each count and each return their rows; NULL
ids are kept; a component whose eigenvalue is zero to double precision has no
whitened value and is left out, so constant vectors or a single one give no
rows; an empty table gives no rows; a deviation beyond the range of long is
NULL; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import materialise

SCALE, SHIFT = 64, 1_000_000
#: Components returned.
COMPONENTS = 32
#: Largest size of 64 times an entry.
LARGEST = float(1 << 61)
#: Pivots below this share of the largest one are zero.
RANK_TOLERANCE = 1e-14
#: Columns count as orthogonal below this cosine; sweeps at most.
ORTHOGONAL, SWEEPS = 1e-15, 60
#: Output vectors of one Arrow batch.
ROWS = 2000


def _listed(column: pa.Array) -> pa.Array:
    """The column as lists of doubles."""
    return column.cast(pa.list_(pa.float64()))


def whole_vectors(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """(row places, x as int64 matrix) of the valid vectors of this dimension."""
    lists = _listed(column)
    at = np.flatnonzero(pc.fill_null(pc.list_value_length(lists), -1).to_numpy(zero_copy_only=False) == dim)
    values = pc.fill_null(lists.take(pa.array(at)).flatten(), np.nan).to_numpy(zero_copy_only=False).reshape(len(at), dim)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * SCALE)
        good = (np.abs(scaled) <= LARGEST).all(axis=1)  # False for NaN and infinities
    return at[good], scaled[good].astype(np.int64) + SHIFT


@dataclass
class Sums:
    """Dimension, number of vectors and exact sums per dimension."""

    dim: int
    n: int
    totals: list[int]

    def __post_init__(self) -> None:
        near = [(2 * s + self.n) // (2 * self.n) for s in self.totals]
        self.near = np.array(near, np.int64)  # whole numbers next to the means
        self.rest = [s - self.n * c for s, c in zip(self.totals, near)]  # totals about them
        self.offset = np.array([float(Fraction(r, self.n)) for r in self.rest])

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.near).astype(np.float64) - self.offset

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n x - S)**2 per row, exact; None beyond the range of long."""
        d = x - self.near
        reach = self.n * int(np.abs(d).max(initial=0)) + max(map(abs, self.rest), default=0)
        if self.dim * reach * reach < 1 << 62:
            return (np.square(self.n * d - np.array(self.rest, np.int64)).sum(axis=1)).tolist()
        sums = (sum((self.n * v - r) ** 2 for v, r in zip(row, self.rest)) for row in d.tolist())
        return [s if s < 1 << 63 else None for s in sums]


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.select("embedding")


def fit_sums(rows: DataFrame) -> Sums | None:
    """Exact sums over all valid vectors of the most frequent dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The low and the high halves of x are summed apart, so no sum of a task overflows.
        held: dict[int, list] = {}
        for batch in batches:
            lists = _listed(batch.column(0))
            for dim in pc.unique(pc.list_value_length(lists)).to_pylist():
                if dim:
                    _, x = whole_vectors(lists, dim)
                    if len(x):
                        n, high, low = held.get(dim, (0, 0, 0))
                        held[dim] = [n + len(x), high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0)]
        for dim, (n, high, low) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * dim, pa.int32()), pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array(high), pa.array(low)], names=["dim", "i", "n", "high", "low"])

    parts = _vectors(rows).mapInArrow(run, "dim int, i int, n long, high long, low long")
    whole = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = materialise(parts.groupBy("dim", "i").agg(F.sum("n").alias("n"), whole("high"), whole("low")), "vector-sums")
    most = sums.where(F.col("i") == 0).orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    got = sums.where(F.col("dim") == most["dim"]).orderBy("i").collect()  # a row per dimension
    return Sums(most["dim"], most["n"], [int(r["high"]) * (1 << 32) + int(r["low"]) for r in got])


def gram_sum(rows: DataFrame, dim: int, size: int, image: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Sum over all valid vectors of y y', y = image(x) of ``size`` entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            _, x = whole_vectors(batch.column(0), dim)
            y = image(x)
            total += y.T @ y
        for i in range(size):
            yield pa.RecordBatch.from_arrays([pa.array([i] * (size - i), pa.int32()), pa.array(range(i, size), pa.int32()), pa.array(total[i, i:])],
                                             names=["i", "j", "v"])

    parts = _vectors(rows).mapInArrow(run, "i int, j int, v double")
    got = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()  # size * (size + 1) / 2 rows
    out = np.zeros((size, size))
    i, j, v = (got.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    out[j, i] = v
    return out


def pivoted_cholesky(v: np.ndarray, tolerance: float = RANK_TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """(order, L) with v[order][:, order] = L L'; L has as many columns as v has rank."""
    a, n = v.copy(), len(v)
    order, low = np.arange(n), np.zeros((n, n))
    first = a.diagonal().max(initial=0.0)
    for k in range(n):
        p = k + int(np.argmax(a.diagonal()[k:]))
        if not a[p, p] > tolerance * first:
            return order, low[:, :k]
        if p != k:
            a[[k, p]], order[[k, p]], low[[k, p]] = a[[p, k]], order[[p, k]], low[[p, k]]
            a[:, [k, p]] = a[:, [p, k]]
        low[k, k] = np.sqrt(a[k, k])
        low[k + 1:, k] = a[k + 1:, k] / low[k, k]
        a[k + 1:, k + 1:] -= np.outer(low[k + 1:, k], low[k + 1:, k])
    return order, low


def jacobi_columns(low: np.ndarray) -> np.ndarray:
    """``low`` times rotations that make its columns orthogonal (one-sided Jacobi, disjoint pairs of a round at once)."""
    a = low.copy()
    k = a.shape[1]
    ring = list(range(k + k % 2))  # round robin; the odd place out pairs with nothing
    for _ in range(SWEEPS):
        worst = 0.0
        for _ in range(len(ring) - 1):
            half = len(ring) // 2
            pairs = [(min(p, q), max(p, q)) for p, q in zip(ring[:half], ring[:half - 1:-1]) if max(p, q) < k]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            p, q = (np.array(s, int) for s in zip(*pairs)) if pairs else (np.zeros(0, int),) * 2
            x, y = a[:, p], a[:, q]
            alpha, beta, gamma = (x * x).sum(axis=0), (y * y).sum(axis=0), (x * y).sum(axis=0)
            cosine = np.abs(gamma) / np.sqrt(np.maximum(alpha * beta, 1e-300))
            worst = max(worst, cosine.max(initial=0.0))
            turn = cosine > ORTHOGONAL
            zeta = (beta - alpha) / (2 * np.where(turn, gamma, 1.0))
            t = np.where(turn, np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta)), 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = c * x - c * t * y, c * t * x + c * y
        if worst <= ORTHOGONAL:
            break
    return a


def principal_components(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, unit eigenvectors as columns) of a covariance matrix; zero eigenvalues left out."""
    order, low = pivoted_cholesky(v)
    if not low.shape[1]:
        return np.zeros(0), np.zeros((len(v), 0))
    turned = jacobi_columns(low)
    norms = np.sqrt((turned * turned).sum(axis=0))
    by = np.argsort(-norms, kind="stable")
    vectors = np.empty_like(turned)
    vectors[order] = turned[:, by] / norms[by]
    lead = vectors[np.argmax(np.abs(vectors), axis=0), range(vectors.shape[1])]
    return norms[by] ** 2, vectors * np.sign(lead)


@dataclass
class Whitening:
    sums: Sums
    values: np.ndarray  # all nonzero eigenvalues
    vectors: np.ndarray
    trace: float
    identity_error: float = 0.0

    def project(self, x: np.ndarray, components: int) -> np.ndarray:
        return self.sums.centred(x) @ (self.vectors[:, :components] / np.sqrt(self.values[:components]))


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all valid vectors; None without any."""
    sums = fit_sums(rows)
    if sums is None:
        return None
    v = gram_sum(rows, sums.dim, sums.dim, sums.centred) / sums.n
    values, vectors = principal_components(v)
    model = Whitening(sums, values, vectors, float(np.trace(v)))
    k = min(components, len(values))
    if k:
        # The whitened vectors have mean zero: the sums they are centred by are exact.
        cov = gram_sum(rows, sums.dim, k, lambda x: model.project(x, k)) / sums.n
        model.identity_error = float(np.abs(cov - np.eye(k)).max())
    return model


def whiten(rows: DataFrame, model: Whitening | None, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error for each valid vector and component."""
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    k = min(components, len(model.values)) if model else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, ROWS):
                part = batch.slice(lo, ROWS)
                at, x = whole_vectors(part.column(1), model.sums.dim)
                m, each = len(at) * k, np.repeat(np.arange(len(at)), k)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(at[each])), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(at))),
                    pa.array(np.full(m, model.sums.n, np.int64)), pa.array(model.sums.deviations(x), pa.int64()).take(pa.array(each)),
                    pa.array(model.project(x, k).ravel()), pa.array(np.tile(model.values[:k] / model.trace, len(at))),
                    pa.array(np.full(m, model.identity_error))], names=[f.split()[0] for f in schema.split(", ")])

    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    return rows.select("vec_id", "embedding").mapInArrow(run, schema)
