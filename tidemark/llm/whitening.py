"""Whitening of quantised embeddings.

The scatter of the distinct quantised vectors is summed by tasks around the exact
mean, factored by a pivoted Cholesky decomposition, and one-sided Jacobi rotations
are applied directly to the columns of the triangular factor.  Once the columns are
orthogonal, their squared norms are the eigenvalues and the normalised columns the
components; the scatter itself is never diagonalised, which keeps small eigenvalues
accurate.

Scale: the distinct vectors are checkpointed once; three passes over them add up
sums, scatter and the check of the result, each as one small block per task.  Only
matrices of ``dims x dims`` (the length of a vector, not the number of vectors)
reach the driver, and only ``dims x components`` goes back to the tasks.

Exactness: an entry is ``floor(64 * c) + 1000000``, sums are kept in two halves and
added as decimals, so ``n`` and the sums are exact at any number of rows, and
``n * x - S`` is taken in integers before anything is rounded.

Defined results: rows whose vector is null or empty, or holds null or non-finite
entries, are left out; so are rows whose length is not the most frequent one (ties:
the longer).  Quantised entries are held within +-2^60.  A ``deviation`` beyond a
long is null.  Repeated vectors count once in the fit and every row gets its result;
a null ``vec_id`` is carried through.  Only components with a positive eigenvalue
(by the rank of the Cholesky factor) exist, so a table of equal vectors, or an empty
one, gives no rows.  Only ``vec_id`` and ``embedding`` are read, so extra columns
never clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import checkpoint, checkpoint_folder, field_type, summed_blocks

GRID = 64.0                  # steps of the quantisation in one unit
SHIFT = 1_000_000            # added to every quantised entry
COMPONENTS = 16
HELD = 1 << 60               # bound of a quantised entry
BAND_BYTES = 1 << 20         # bytes of a scatter block that travels as one row
HALF = 31                    # bits of the lower half of a sum


@dataclass
class Whitening:
    """A fitted whitening: ``n`` distinct vectors, exact ``sums``, and the leading components."""

    n: int
    sums: list[int]
    components: np.ndarray     # dims x k, unit columns by falling eigenvalue
    eigenvalues: np.ndarray    # k
    trace: float
    identity_error: float = 0.0

    @property
    def weights(self) -> np.ndarray:
        return self.components / np.sqrt(self.eigenvalues)


def quantised(embeddings: DataFrame) -> DataFrame:
    """``(vec_id, x)`` of the rows whose vector is whole, ``x`` as longs."""
    c = embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("_v"))
    whole = F.col("_v").isNotNull() & (F.size("_v") > 0) & F.forall("_v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    # held before the cast to long, so that no entry overflows
    entry = lambda e: F.floor(F.greatest(F.lit(-float(HELD)), F.least(F.lit(float(HELD)), e * GRID))) + SHIFT
    return c.where(whole).select("vec_id", F.transform("_v", entry).alias("x"))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False).reshape(-1, dims)


def _centre(n: int, sums: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The integer next to every mean, and ``S - n * centre`` (at most half of ``n``)."""
    base = [(2 * s + n) // (2 * n) for s in sums]
    return np.array(base, dtype=np.int64), np.array([s - n * b for s, b in zip(sums, base)], dtype=np.int64)


def exact_sums(vectors: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and exact sum of every dimension."""

    def add(batches):
        high = np.zeros(dims, np.int64)
        low = np.zeros(dims, np.int64)
        n = 0
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("x"), dims)
                high += (x >> HALF).sum(axis=0)
                low += (x & ((1 << HALF) - 1)).sum(axis=0)
                n += len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(high), pa.array(low), pa.array(np.full(dims, n))], names=["dim", "high", "low", "n"])

    parts = vectors.mapInArrow(add, "dim int, high long, low long, n long")
    big = lambda c: F.sum(F.col(c).cast("decimal(38,0)"))
    rows = parts.groupBy("dim").agg(big("high").alias("high"), big("low").alias("low"), F.sum("n").alias("n")).orderBy("dim").collect()  # one per dimension
    return (int(rows[0]["n"]), [(int(r["high"]) << HALF) + int(r["low"]) for r in rows]) if rows else (0, [])


def _gram(vectors: DataFrame, dims: int, base: np.ndarray, rest: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    """Sum over rows of the outer product of the centred (and, with ``weights``, projected) vectors."""
    size = dims if weights is None else weights.shape[1]
    bands = np.array_split(np.arange(size), max(1, -(-size * size * 8 // BAND_BYTES)))
    fields = T.StructType([T.StructField("key", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("total", T.BinaryType())])

    def add(batches):
        total = None
        for b in batches:
            if b.num_rows:
                d = (_matrix(b.column("x"), dims) - base).astype(np.float64) - rest / n
                d = d if weights is None else d @ weights
                total = d.T @ d if total is None else total + d.T @ d
        if total is not None:
            blocks = [total[band].tobytes() for band in bands]
            yield pa.RecordBatch.from_arrays([pa.array([0] * len(blocks), pa.int32()), pa.array(range(len(blocks)), pa.int32()), pa.array(blocks, pa.binary())], names=fields.names)

    rows = {r["block"]: r["total"] for r in summed_blocks(vectors.mapInArrow(add, fields), "key").collect()}  # size x size doubles in all
    return np.concatenate([np.frombuffer(rows[k], np.float64).reshape(-1, size) for k in range(len(bands))])


def pivoted_cholesky(v: np.ndarray) -> np.ndarray:
    """``L`` with ``L @ L.T = v`` and as many columns as ``v`` has rank; triangular in the order of its pivots."""
    d = len(v)
    left = np.diag(v).astype(np.float64).copy()
    limit = d * np.finfo(np.float64).eps * left.max(initial=0.0)
    out = np.zeros((d, d))
    open_ = np.ones(d, dtype=bool)
    for k in range(d):
        p = int(np.argmax(np.where(open_, left, -np.inf)))
        if left[p] <= limit:
            return out[:, :k]
        col = (v[:, p] - out[:, :k] @ out[p, :k]) / np.sqrt(left[p])
        col[~open_] = 0.0
        col[p] = np.sqrt(left[p])
        out[:, k] = col
        open_[p] = False
        left -= col * col
    return out


def _rounds(k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of ``k`` columns in rounds of disjoint pairs (circle method)."""
    ring = list(range(k + k % 2))
    out = []
    for _ in range(len(ring) - 1):
        half = len(ring) // 2
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:half], reversed(ring[half:])) if max(a, b) < k]
        out.append((np.array([a for a, _ in pairs], int), np.array([b for _, b in pairs], int)))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def one_sided_jacobi(factor: np.ndarray, sweeps: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and unit eigenvectors of ``factor @ factor.T``.

    Pairs of columns are rotated until all are orthogonal to rounding; disjoint
    pairs of a round are rotated together.
    """
    a = np.array(factor, dtype=np.float64)
    tol = 4 * np.finfo(np.float64).eps
    for _ in range(sweeps):
        worst = 0.0
        for p, q in _rounds(a.shape[1]):
            if not len(p):
                continue
            left, right = a[:, p], a[:, q]
            alpha, beta, gamma = (left * left).sum(0), (right * right).sum(0), (left * right).sum(0)
            scale = np.sqrt(alpha) * np.sqrt(beta)
            turn = np.abs(gamma) > tol * scale
            if not turn.any():
                continue
            worst = max(worst, float((np.abs(gamma[turn]) / scale[turn]).max()))
            zeta = (beta - alpha) / np.where(turn, 2 * gamma, 1.0)
            t = np.where(zeta < 0, -1.0, 1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            t = np.where(turn, t, 0.0)
            c = 1 / np.hypot(1.0, t)
            a[:, p], a[:, q] = left * c - right * (c * t), left * (c * t) + right * c
        if worst <= 16 * tol:
            break
    norms = np.sqrt((a * a).sum(0))
    order = np.argsort(-norms, kind="stable")
    return norms[order] ** 2, a[:, order] / norms[order]


def fit(x: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors of ``x``; None where nothing varies (or no row is left).

    All vectors of ``x`` have one length.
    """
    vectors = checkpoint(x.select("x").distinct())
    first = vectors.select(F.size("x").alias("d")).limit(1).collect()
    if not first:
        return None
    dims = first[0]["d"]
    n, sums = exact_sums(vectors, dims)
    base, rest = _centre(n, sums)
    v = _gram(vectors, dims, base, rest, n) / n
    factor = pivoted_cholesky(v)
    if not factor.shape[1]:
        return None
    values, columns = one_sided_jacobi(factor)
    model = Whitening(n, sums, columns[:, :components], values[:components], float(np.trace(v)))
    white = _gram(vectors, dims, base, rest, n, model.weights) / n
    model.identity_error = float(np.abs(white - np.eye(len(white))).max())
    return model


def _deviations(y: np.ndarray, rest: np.ndarray, n: int) -> pa.Array:
    """Exact sum over dimensions of ``(n * x - S)^2`` of every row; null beyond a long."""
    near = np.square(y.astype(np.float64) * n - rest).sum(axis=1)
    safe = near < float(1 << 62)
    t = np.where(safe[:, None], y, 0) * np.int64(n) - rest
    out = np.square(t).sum(axis=1).tolist()
    for i in np.flatnonzero(~safe):
        exact = sum((n * int(a) - int(r)) ** 2 for a, r in zip(y[i], rest))
        out[i] = exact if exact < 1 << 63 else None
    return pa.array(out, pa.int64())


def transform(x: DataFrame, model: Whitening) -> DataFrame:
    """One row per vector and component: projection over the root of the eigenvalue, and the fit's figures."""
    dims, k = model.components.shape
    n, weights = model.n, model.weights
    base, rest = _centre(n, model.sums)
    explained, error = model.eigenvalues / model.trace, model.identity_error
    fields = [("component", T.IntegerType()), ("n", T.LongType()), ("deviation", T.LongType()), ("whitened", T.DoubleType()), ("explained", T.DoubleType()), ("identity_error", T.DoubleType())]
    schema = T.StructType([T.StructField("vec_id", field_type(x, "vec_id")), *[T.StructField(a, t) for a, t in fields]])

    def run(batches):
        for b in batches:
            rows = b.num_rows
            if not rows:
                continue
            y = _matrix(b.column("x"), dims) - base
            white = (y.astype(np.float64) - rest / n) @ weights
            each = pa.array(np.repeat(np.arange(rows), k))
            out = [
                b.column("vec_id").take(each),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n, np.int64)),
                _deviations(y, rest, n).take(each),
                pa.array(white.reshape(-1)),
                pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(out, names=schema.names)

    return x.mapInArrow(run, schema)


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every whole vector, as ``transform`` gives them."""
    spark = embeddings.sparkSession
    checkpoint_folder(spark)
    x = quantised(embeddings)
    lengths = x.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("d")).limit(1).collect()
    if lengths:
        x = x.where(F.size("x") == lengths[0]["d"])
    model = fit(x, components)
    if model is None:
        nothing = Whitening(1, [0], np.zeros((1, 0)), np.zeros(0), 1.0)
        return transform(x.where(F.lit(False)), nothing)
    return transform(x, model)
