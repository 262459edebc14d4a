"""Whitening of embeddings by shifted Cholesky QR.

The entries c of a vector become whole numbers ``floor(SCALE * c) + OFFSET``, so
that sums, means and deviations are exact.  The whole list of vectors is the
fit list: n vectors with per-dimension sums S.  A row is centred before any
multiplication as ``(n * x - S) / n``, with a whole numerator.

The centred rows X are made orthogonal in passes over the stored rows.  Each
pass sums the Gram matrix of the rows as they are after the triangular solves
of the passes before, takes its Cholesky factor on the driver (d x d numbers),
and adds it to the list of solves.  The first Gram matrix is shifted by a small
part of its diagonal, so that its factor exists however ill-conditioned X is;
later ones are only shifted where they must be.  When the rows are orthonormal,
the composed factor R has ``X'X = R'R``, with small eigenvalues as sharp as large ones
(a plain Gram matrix loses them at a condition number of 1e8).  The SVD of R
gives the components and their eigenvalues.  A last pass measures the
covariance of the whitened rows.

Rows never leave Spark; a task returns sums of d x d numbers, added up by Spark,
so the driver gets d x d numbers whatever the number of rows or tasks.
Repeated vectors are rows like any others and cannot skew a pass.

Defined cases: rows whose vector is null, or holds null, NaN, infinite or too
large entries (beyond 2^52 in size when scaled), are dropped; so are rows whose
length is not the commonest one (of equally common lengths the longest), since
they belong to another space.  Repeated rows count each.  Directions without
variance (constant or dependent dimensions) have no component, so fewer than
``components`` may come out; without any variance, or for an empty table, there
are no rows.  ``deviation`` is null where it does not fit a long.  Further
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplens.llm.common import small_batches, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
#: Rows count as orthonormal when no entry of their Gram matrix is further than this from the identity.
ORTHONORMAL = 1e-13
MAX_PASSES = 8
#: Eigenvalues below this part of the largest one are rounding noise of a direction without variance.
NO_VARIANCE = 1e-26

_EPS = float(np.finfo(float).eps)


def whole_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable vectors as whole numbers, stored."""
    limit = float(1 << 52)
    scaled = F.transform(F.col(vector_col).cast("array<double>"), lambda c: c * SCALE)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), scaled.alias("y")).filter(
        F.col("y").isNotNull() & (F.size("y") > 0) & F.forall("y", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < limit))
    )
    rows = stored(rows.select("vec_id", F.transform("y", lambda c: F.floor(c) + F.lit(OFFSET)).alias("x")), "whole-vectors")
    common = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.filter(F.size("x") == common.d) if common else rows


@dataclass
class Fit:
    """What centring and whitening need: d and n, exact sums, the solves, the components (columns) and their eigenvalues."""

    n: int
    sums: list[int]
    solves: list[np.ndarray] = field(default_factory=list)
    components: np.ndarray | None = None
    eigenvalues: np.ndarray | None = None
    trace: float = 0.0
    exact: bool = True  # whether whole-number arithmetic fits 64 bits

    def numerators(self, x: np.ndarray) -> np.ndarray:
        """n * x - S of whole rows, exact."""
        kind = np.int64 if self.exact else object
        return x.astype(kind) * (self.n if not self.exact else np.int64(self.n)) - np.array(self.sums, kind)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.numerators(x).astype(float) / self.n

    def solved(self, x: np.ndarray) -> np.ndarray:
        """Centred rows after the triangular solves so far."""
        rows = self.centred(x)
        for r in self.solves:
            rows = _row_solve(rows, r)
        return rows

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums of squares of the numerators; None beyond 64 bits."""
        top = self.numerators(x)
        if self.exact and float(np.abs(top).max(initial=0)) ** 2 * top.shape[1] < 2.0**62:
            return (top * top).sum(axis=1).tolist()
        sums = [sum(int(v) ** 2 for v in row) for row in top]
        return [s if s < 1 << 63 else None for s in sums]


def _row_solve(rows: np.ndarray, r: np.ndarray) -> np.ndarray:
    """rows times the inverse of the upper triangular r, by forward substitution over its columns."""
    out = np.empty_like(rows)
    for j in range(r.shape[0]):
        out[:, j] = (rows[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _arrays(batch: pa.RecordBatch, d: int, at: int) -> np.ndarray:
    return batch.column(at).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def sums_of(rows: DataFrame) -> Fit | None:
    """n and the exact sums per dimension; None without rows."""
    small_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, high, low, most = 0, 0, 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _arrays(batch, len(batch.column(0)[0]), 0)
                n += len(x)
                # two halves, neither of which can overflow within a task
                high, low = high + (x >> 31).sum(axis=0), low + (x & 0x7FFFFFFF).sum(axis=0)
                most = max(most, int(np.abs(x).max()))
        if n:
            d = len(high)
            yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(high), pa.array(low), pa.array([n] * d), pa.array([most] * d)], ["j", "high", "low", "n", "most"])

    found = rows.select("x").mapInArrow(run, "j int, high long, low long, n long, most long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    got = found.groupBy("j").agg(wide("high"), wide("low"), F.sum("n").alias("n"), F.max("most").alias("most")).orderBy("j").collect()
    if not got:
        return None
    n, sums = got[0].n, [(int(r.high) << 31) + int(r.low) for r in got]
    return Fit(n, sums, exact=2 * n * (got[0].most + 1) < 1 << 62)


def gram(rows: DataFrame, values: Callable[[np.ndarray], np.ndarray], d: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sum of ``values(x)' values(x)`` and of ``values(x)`` over all rows; ``size`` is the number of values a row."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(values)
    upper = np.triu_indices(size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, plain, some = np.zeros((size, size)), np.zeros(size), False
        for batch in batches:
            if batch.num_rows:
                v = shared.value(_arrays(batch, d, 0))
                total, plain, some = total + v.T @ v, plain + v.sum(axis=0), True
        if some:
            i, j = (np.concatenate([k, e]) for k, e in zip(upper, (np.arange(size), np.full(size, -1))))
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(np.concatenate([total[upper], plain]))], ["i", "j", "v"])

    out, plain = np.zeros((size, size)), np.zeros(size)
    sums = rows.select("x").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    for r in sums.toLocalIterator():
        if r.j < 0:
            plain[r.i] = r.v
        else:
            out[r.i, r.j] = out[r.j, r.i] = r.v
    shared.unpersist()
    return out, plain


def shifted_factor(g: np.ndarray, first: bool) -> np.ndarray:
    """Upper Cholesky factor of ``g`` plus a shift of its diagonal: always on the first pass, else only if it is needed."""
    diagonal = np.diag(g).copy()
    diagonal[diagonal <= 0] = 1.0  # a dimension without variance stays as it is: all zeros
    shift = 11 * len(g) * (len(g) + 1) * _EPS if first else 0.0
    while True:
        try:
            return np.linalg.cholesky(g + np.diag(np.where(np.diag(g) <= 0, diagonal, shift * diagonal))).T
        except np.linalg.LinAlgError:
            shift = max(10 * shift, _EPS)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fit | None:
    """Orthogonalise the centred rows, compose the factors and take the components; None if nothing varies."""
    model = sums_of(rows)
    if model is None:
        return None
    d = len(model.sums)
    composed, g = np.eye(d), np.zeros((d, d))
    for step in range(MAX_PASSES):
        g, _ = gram(rows, model.solved, d, d)
        if step == 0:
            model.trace = float(np.trace(g)) / model.n
            if model.trace == 0:
                return None
        if np.abs(g - np.eye(d)).max() < ORTHONORMAL:
            break
        r = shifted_factor(g, step == 0)
        if step and np.abs(r - np.eye(d)).max() < 4 * d * _EPS:
            break
        model.solves.append(r)
        composed = r @ composed
    else:
        g, _ = gram(rows, model.solved, d, d)
    # what is left of the Gram matrix: the identity, but for directions without variance, where it vanishes
    values, turns = np.linalg.eigh((g + g.T) / 2)
    _, sizes, axes = np.linalg.svd(np.sqrt(np.clip(values, 0, None))[:, None] * turns.T @ composed)
    eigenvalues = sizes**2 / model.n
    keep = min(components, int((eigenvalues > NO_VARIANCE * eigenvalues[0]).sum()))
    model.components, model.eigenvalues = np.ascontiguousarray(axes[:keep].T), eigenvalues[:keep]
    return model


def identity_error(rows: DataFrame, model: Fit) -> float:
    """Largest entry of the whitened rows' covariance minus the identity, in size."""
    k = len(model.eigenvalues)
    g, plain = gram(rows, model.whitened, len(model.sums), k)
    mean = plain / model.n
    return float(np.abs(g / model.n - np.outer(mean, mean) - np.eye(k)).max())


_SCHEMA = "vec_id long, deviation long, whitened array<double>"


def whiten(rows: DataFrame, model: Fit) -> DataFrame:
    """(vec_id, deviation, whitened): every row's vector in whitened coordinates, one entry a component."""
    small_batches(rows.sparkSession)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        k = len(model.eigenvalues)
        for batch in batches:
            x = _arrays(batch, len(model.sums), 1)
            flat = pa.array(model.whitened(x).ravel())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, k * len(x) + 1, k), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviations(x), pa.int64()), lists], ["vec_id", "deviation", "whitened"])

    return rows.select("vec_id", "x").mapInArrow(run, _SCHEMA)


def whitened_components(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component: n, deviation, whitened, explained, identity_error."""
    spark = vectors.sparkSession
    rows = whole_vectors(vectors, id_col, vector_col)
    model = fit(rows, components)
    if model is None:
        return spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
    explained = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    flat = whiten(rows, model).select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return flat.select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(explained, F.col("k") + 1).alias("explained"),
        F.lit(identity_error(rows, model)).alias("identity_error"),
    )
