"""Whitening of embeddings by mixed-precision eigenvectors.

The covariance of the distinct integer vectors is summed over tasks in exact
integers, centred on an integer vector next to the mean before anything is
multiplied; what the driver gets is ``dims * dims`` numbers that do not depend on
partitions or on the order of rows.  Its eigenvectors start in float32 and are
corrected by Ogita-Aishima iterations (matrix products only, quadratic
convergence) in extended precision.  Eigenvalues that an iteration cannot yet
tell apart form clusters: their subspace is corrected as a whole, then the matrix
projected on it, shifted by the cluster's centre, is solved anew.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import scratch_folder, ship_code
from .vectors import common_length, exact_gram, grid, matrix, usable

COMPONENTS = 4
#: Entries beyond count as this; their products over 2 ** 40 rows fit decimal(38, 0).
LIMIT = 1 << 40
ROWS = "component int, n long, deviation long, whitened double, explained double, identity_error double"


# ---- eigenvectors ------------------------------------------------------------

def _groups(values: np.ndarray, apart: float) -> list[np.ndarray]:
    """Runs of two or more ascending values whose neighbours differ by ``apart`` at most."""
    order = np.argsort(values)
    runs = np.split(order, np.flatnonzero(np.diff(values[order]) > apart) + 1)
    return [r for r in runs if len(r) > 1]


def corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """One Ogita-Aishima iteration on symmetric ``a`` and approximate eigenvectors ``x``
    (columns): the new eigenvectors, the eigenvalues of the old ones, the largest correction."""
    one = np.eye(len(a), dtype=a.dtype)
    r, s = one - x.T @ x, x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2            # rounding apart, E + E' = R then holds
    values = np.diag(s) / (1 - np.diag(r))
    size = lambda m: float(np.linalg.norm(m.astype(np.float64), 2))
    apart = 2 * (size(s - np.diag(values)) + size(a) * size(r))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > apart
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    x = x + x @ e
    for group in _groups(values, apart):
        part, centre = x[:, group], values[group].mean()
        small = part.T @ (a @ part - centre * part)
        scale = np.abs(small).max()
        if scale > 0:                              # an exact multiple eigenvalue needs no turn
            turn = np.linalg.eigh(((small + small.T) / (2 * scale)).astype(np.float64))[1]
            x[:, group] = part @ turn.astype(a.dtype)
    return x, values, float(np.abs(e).max())


def eigenvectors(a: np.ndarray, most: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (falling) and eigenvectors (columns, largest entry positive) of a
    symmetric matrix, from float32 ones corrected in extended precision until no
    correction is left, corrections no longer shrink (rounding over a narrow gap) or
    ``most`` iterations are done."""
    a = np.asarray(a, dtype=np.longdouble)
    scale = np.abs(a).max(initial=0)
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    last = np.inf
    for _ in range(most):
        x, values, change = corrected(a, x)
        if change < 1e-17 or (change < 1e-8 and change > last / 2):
            break
        last = change
    x = x / np.sqrt((x * x).sum(0))
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    x = x * np.sign(x[np.abs(x).argmax(0), np.arange(len(a))])
    return (values[order] * scale).astype(np.float64), x.astype(np.float64)


# ---- sums over the rows ------------------------------------------------------

def _sums(dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        n, total = 0, np.zeros(dims, dtype=object)
        for b in batches:
            n, total = n + len(b), total + matrix(b.column("x"), dims, np.int64).sum(0).astype(object)
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(total, pa.decimal128(38, 0))],
                ["i", "n", "total"])
    return run


def _products(centre: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        dims, total = len(centre), 0
        for b in batches:
            total = total + exact_gram(matrix(b.column("x"), dims, np.int64) - np.array(centre, np.int64))
        if not isinstance(total, int):
            i, j = np.triu_indices(dims)
            yield pa.RecordBatch.from_arrays(
                [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j], pa.decimal128(38, 0))],
                ["i", "j", "total"])
    return run


def _long_double(n: int) -> np.longdouble:
    high = float(n)
    return np.longdouble(high) + np.longdouble(float(n - int(high)))


def covariance(fit: DataFrame, dims: int) -> tuple[int, list[int], np.ndarray]:
    """Number of rows, sums S and covariance (divisor n) of ``fit`` (column x)."""
    rows = fit.mapInArrow(_sums(dims), "i int, n long, total decimal(38,0)").groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")).orderBy("i").collect()      # dims rows
    n, sums = rows[0].n, [int(r.total) for r in rows]
    centre = [s // n for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    v = np.zeros((dims, dims), dtype=np.longdouble)
    cells = fit.mapInArrow(_products(centre), "i int, j int, total decimal(38,0)").groupBy("i", "j").agg(F.sum("total").alias("total"))
    for c in cells.collect():                                                              # dims * dims / 2 rows
        v[c.i, c.j] = v[c.j, c.i] = _long_double(n * int(c.total) - rest[c.i] * rest[c.j]) / np.longdouble(n) / np.longdouble(n)
    return n, sums, v


# ---- projection --------------------------------------------------------------

def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, as int64 where all squares fit a long, else as Python integers."""
    most = n * int(np.abs(x).max(initial=0)) + max(map(abs, sums))
    if most * most * len(sums) < 1 << 63:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def _projected(y: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    return (y / n).astype(np.float64) @ basis


def _moments(n: int, sums: list[int], basis: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        k = basis.shape[1]
        first, second = np.zeros(k), np.zeros((k, k))
        for b in batches:
            w = _projected(_centred(matrix(b.column("x"), len(sums), np.int64), n, sums), n, basis)
            first, second = first + w.sum(0), second + w.T @ w
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(k + k * k, dtype=np.int32)), pa.array(np.concatenate([first, second.ravel()]))], ["at", "total"])
    return run


def _whiten(n: int, sums: list[int], basis: np.ndarray, explained: list[float], error: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        k = basis.shape[1]
        for b in batches:
            y = _centred(matrix(b.column("x"), len(sums), np.int64), n, sums)
            squares = (y * y).sum(1)
            if squares.dtype == object:
                squares = [s if s < 1 << 63 else None for s in squares]
            yield pa.RecordBatch.from_arrays(
                [b.column("id").take(pa.array(np.repeat(np.arange(len(b)), k))),
                 pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(b))), pa.array([n] * (len(b) * k), pa.int64()),
                 pa.array(np.repeat(squares, k), pa.int64()), pa.array(_projected(y, n, basis).ravel()),
                 pa.array(explained * len(b), pa.float64()), pa.array([error] * (len(b) * k), pa.float64())],
                ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable row and component: the id, component (from 1), n,
    deviation, whitened, explained, identity_error.

    Rows with a null vector or a null, NaN or infinite entry are left out, and rows
    whose vector has another length than most (the longer on a tie).  Entries become
    x = floor(256 * entry), at most 2 ** 40 either way.  n, the sums S and the
    covariance V are those of the distinct x.  deviation is the sum of
    (n * x - S) ^ 2, exact, null beyond a long; whitened is (x - S / n) on an
    eigenvector of V over the root of its eigenvalue; explained is the eigenvalue
    over V's trace; identity_error is the largest entry of |covariance of whitened -
    identity|.  Components of no variance are left out, so fewer distinct vectors or
    dimensions give fewer components, and one distinct vector gives no rows, as does
    an empty table.  Repeated rows and null ids are whitened like any other; other
    columns are not read.
    """
    spark = vectors.sparkSession
    ship_code("tillroll.llm.vectors", __name__)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v")))
    none = spark.createDataFrame([], f"id long, {ROWS}").withColumnRenamed("id", id_col)
    dims = common_length(rows, "v")
    if not dims:
        return none
    kept = rows.filter(F.size("v") == dims).select("id", grid(F.col("v"), LIMIT).alias("x"))
    path = scratch_folder(spark, "distinct-vectors")
    kept.select("x").distinct().write.option("compression", "zstd").parquet(path)
    fit = spark.read.parquet(path)
    n, sums, v = covariance(fit, dims)
    values, directions = eigenvectors(v)
    k = min(components, int((values > values[0] * dims * np.finfo(np.float64).eps).sum()))
    if not k:
        return none
    values, basis = values[:k], directions[:, :k] / np.sqrt(values[:k])
    sent = fit.mapInArrow(_moments(n, sums, basis), "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    moments = {r.at: r.total / n for r in sent.collect()}                                  # k + k * k rows
    mean = np.array([moments[i] for i in range(k)])
    spread = np.array([moments[k + i] for i in range(k * k)]).reshape(k, k) - np.outer(mean, mean)
    error = float(np.abs(spread - np.eye(k)).max())
    explained = [float(e) for e in values / float(np.trace(v))]
    out = kept.mapInArrow(_whiten(n, sums, basis, explained, error), f"id long, {ROWS}")
    return out.withColumnRenamed("id", id_col)
