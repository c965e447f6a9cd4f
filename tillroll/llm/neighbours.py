"""Approximate nearest neighbours (largest inner product) on shifted Hilbert curves.

Vectors are projected on a few random axes, every axis is cut at the quantiles of a
bounded sample, and the cells are numbered along a Hilbert curve; several curves
have other axes and another shift of the cells.  Each curve is cut into blocks of
neighbouring keys.  A query goes to the blocks of a window around its own key, on
every curve; blocks are compared with their queries one matrix product at a time,
what several tasks found is merged, and all scores are those of the original
vectors in double precision.

The window is not guessed: for a bounded sample of queries the exact neighbours are
found in one pass over all rows, and the window is the smallest that holds
``recall`` of them on some curve.  Vectors with structure get narrow windows;
vectors spread evenly in many dimensions, where no index helps, get wide ones.

Of equal vectors only the ``k + 1`` smallest ids can be among anyone's ``k``
nearest, so only those are indexed; equal queries are searched once.  A vector that
a third of all rows share is therefore neither a hot block nor a hot query.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, scratch_folder, ship_code
from .vectors import common_length, matrix, usable

NEAREST, EVERY = 20, 20
#: Curves, projected axes of a curve, bits of an axis; the rest of a key tells crowded cells apart.
CURVES, AXES, AXIS_BITS, TIE_BITS = 4, 6, 8, 14
#: Rows that the axes' quantiles and the blocks' borders are fitted on at most, queries that the window is fitted on.
SAMPLE_ROWS, SAMPLE_QUERIES, RECALL = 8_192, 256, 0.97
#: Rows of a block, as planned, and least number of blocks of a curve.
BLOCK_ROWS, LEAST_BLOCKS = 65_536, 32
#: Entries of one product of queries and rows, and hits that a task gathers before it merges them.
PRODUCT, GATHERED = 4_000_000, 1_000_000


# ---- keys --------------------------------------------------------------------

def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with integer coordinates below 2 ** bits
    (rows): reflections and exchanges of axes from the top bit down, then a Gray code."""
    x = cells.astype(np.int64).T.copy()
    axes = len(x)
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for i in range(axes):
            on = (x[i] >> b) & 1 == 1
            swap = np.where(on, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(on, low, swap)
            x[i] ^= swap
    for i in range(1, axes):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((x[-1] >> b) & 1 == 1, (1 << b) - 1, 0)
    x ^= turn
    key = np.zeros_like(turn)
    for b in range(bits - 1, -1, -1):
        for i in range(axes):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


@dataclass
class Curve:
    """One ordering: projection, quantiles of each axis, shift of the cells, block borders."""
    axes: np.ndarray
    cuts: np.ndarray
    shift: np.ndarray
    borders: np.ndarray

    def keys(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Sort keys of vectors; the lowest bits come from the id, so that any number of
        vectors in one cell can be cut into blocks."""
        size = np.sqrt((x * x).sum(1, keepdims=True))
        y = (x / np.where(size > 0, size, 1)) @ self.axes
        steps = 1 << (AXIS_BITS - 1)               # half of the cells, the shift needs the other half
        cells = np.stack([np.searchsorted(self.cuts[:, i], y[:, i]) for i in range(y.shape[1])], 1)
        cells = np.minimum(cells, steps - 1) + self.shift
        mixed = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TIE_BITS)
        return (hilbert(cells, AXIS_BITS) << TIE_BITS) | mixed.astype(np.int64)

    def blocks(self, x: np.ndarray, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.borders, self.keys(x, ids), side="right")


def fit_curves(sample: np.ndarray, ids: np.ndarray, blocks: int, curves: int = CURVES, seed: int = 0) -> list[Curve]:
    """Curves of ``blocks`` blocks each, fitted on a sample of the vectors."""
    rng, steps = np.random.default_rng(seed), 1 << (AXIS_BITS - 1)
    out = []
    for _ in range(curves):
        axes = rng.normal(size=(sample.shape[1], AXES))
        size = np.sqrt((sample * sample).sum(1, keepdims=True))
        y = (sample / np.where(size > 0, size, 1)) @ axes
        cuts = np.quantile(y, np.arange(1, steps) / steps, axis=0)
        curve = Curve(axes, cuts, rng.integers(0, steps, AXES), np.empty(0, np.int64))
        keys = np.sort(curve.keys(sample, ids))
        curve.borders = np.unique(keys[np.arange(1, blocks) * len(keys) // blocks])
        out.append(curve)
    return out


# ---- comparing ---------------------------------------------------------------

def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row; equal rows give equal sums, wherever they stand."""
    return (q * x).sum(1)


def best(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` best of each ``at``: by falling score, then smaller id;
    a pair found twice counts once."""
    order = np.lexsort((ids, -scores, at))
    a, i = at[order], ids[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (i[1:] != i[:-1]) | (scores[order][1:] != scores[order][:-1])
    order, a = order[new], a[new]
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]]) if len(a) else np.empty(0, int)
    rank = np.arange(len(a)) - np.repeat(first, np.diff(np.r_[first, len(a)]))
    return order[rank < k]


def hits(queries: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best rows of ``x`` for each query: query positions, scores, ids.

    A matrix product proposes all rows within rounding of the ``k``-th best; the
    exact scores of those decide."""
    found, step = [], max(1, PRODUCT // len(x))
    for at in range(0, len(queries), step):
        part = queries[at:at + step]
        rough = part @ x.T
        if len(x) > k:
            least = np.partition(rough, len(x) - k, axis=1)[:, len(x) - k]
            slack = 1e-12 * np.sqrt((part * part).sum(1)) * np.sqrt((x * x).sum(1).max())
            q, c = np.nonzero(rough >= (least - slack)[:, None])
        else:
            q, c = np.nonzero(np.ones_like(rough, bool))
        scores = exact_scores(part[q], x[c])
        keep = best(q, scores, ids[c], k)
        found.append((q[keep] + at, scores[keep], ids[c][keep]))
    return tuple(np.concatenate(col) for col in zip(*found))


def _vectors(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    """Binary vectors as rows of doubles."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind).reshape(-1, dims).astype(np.float64)


def _packed(dims: int, kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for b in batches:
            x = matrix(b.column("a"), dims, np.dtype(kind))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in x], pa.binary()), b.column("asks")], ["id", "v", "asks"])
    return run


def _placed(curve: Curve, dims: int, kind: str, reach: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows with their block; with ``reach``, queries with every block of their window."""
    def run(batches):
        for b in batches:
            ids = b.column("id").to_numpy()
            low = high = curve.blocks(_vectors(b.column("v"), dims, kind), ids)
            if reach is not None:
                low, high = np.maximum(low - reach, 0), np.minimum(high + reach, len(curve.borders))
            for step in range(int((high - low).max(initial=0)) + 1):
                here = pa.array(low + step <= high)
                part = b.filter(here)
                block = pa.array((low + step).astype(np.int32)).filter(here)
                yield pa.RecordBatch.from_arrays(
                    [block, pa.array(np.full(len(part), reach is not None)), part.column("number" if reach is not None else "id"), part.column("v")],
                    ["block", "asks", "id", "v"])
    return run


def _compared(dims: int, kind: str, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks one after another, each row set before its queries; hits are merged as they gather."""
    def out(parts):
        at, scores, ids = (np.concatenate(c) for c in zip(*parts))
        keep = best(at, scores, ids, k)
        return at[keep], scores[keep], ids[keep]

    def batch(part):
        return pa.RecordBatch.from_arrays([pa.array(c) for c in part], ["number", "score", "id"])

    def run(batches):
        here, rows, x, ids = None, [], None, None
        parts, held = [], 0
        for b in batches:
            place = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("block", "asks")], 1)
            ends = np.flatnonzero((place[1:] != place[:-1]).any(1)) + 1
            for low, high in zip(np.r_[0, ends], np.r_[ends, len(place)]):
                (block, asks), part = place[low], b.slice(low, high - low)
                if block != here:
                    here, rows, x, ids = block, [], None, None
                if not asks:
                    rows.append(part)
                    continue
                if x is None and rows:
                    x = np.concatenate([_vectors(r.column("v"), dims, kind) for r in rows])
                    ids, rows = np.concatenate([r.column("id").to_numpy() for r in rows]), []
                if x is None:
                    continue                       # no rows in this block
                at, scores, found = hits(_vectors(part.column("v"), dims, kind), x, ids, k)
                parts.append((part.column("id").to_numpy()[at], scores, found))
                held += len(at)
                if held > GATHERED:
                    parts = [out(parts)]
                    held = len(parts[0][0])
                    if held > GATHERED // 2:       # many queries: let go of what is merged
                        yield batch(parts[0])
                        parts, held = [], 0
        if parts:
            yield batch(out(parts))
    return run


def _scanned(queries: np.ndarray, dims: int, kind: str, k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The best of a task's rows for each sampled query, with the vectors found."""
    def run(batches):
        at, scores, ids, rows = np.empty(0, int), np.empty(0), np.empty(0, np.int64), np.empty((0, dims))
        for b in batches:
            x = _vectors(b.column("v"), dims, kind)
            own = b.column("id").to_numpy()
            order = np.argsort(own, kind="stable")
            x, own = x[order], own[order]
            q, s, found = hits(queries, x, own, k)
            where = np.searchsorted(own, found)
            at, scores, ids = np.r_[at, q], np.r_[scores, s], np.r_[ids, found]
            rows = np.concatenate([rows, x[where]])
            keep = best(at, scores, ids, k)
            at, scores, ids, rows = at[keep], scores[keep], ids[keep], rows[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int64)), pa.array(scores), pa.array(ids), pa.array([r.tobytes() for r in rows], pa.binary())],
            ["query", "score", "id", "v"])
    return run


# ---- the operator ------------------------------------------------------------

def _first(rows: DataFrame, by: str, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows of each ``by``; tasks cut their own share before the shuffle."""
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= k)


def window(indexed: DataFrame, asked: DataFrame, curves: list[Curve], dims: int, kind: str, k: int,
           recall: float = RECALL, queries: int = SAMPLE_QUERIES) -> tuple[int, float]:
    """Blocks to either side of a query's own that hold ``recall`` of the exact
    neighbours of a sample of queries (at most ``queries``), and the share held."""
    some = asked.orderBy(F.xxhash64("id"), "id").limit(queries).collect()
    q = np.frombuffer(b"".join(r.v for r in some), dtype=kind).reshape(-1, dims).astype(np.float64)
    own = np.array([r.id for r in some], np.int64)
    near = indexed.mapInArrow(_scanned(q, dims, kind, k), "query long, score double, id long, v binary")
    near = _first(near, "query", k, F.desc("score"), F.asc("id")).collect()                # queries * k rows at most
    x = np.frombuffer(b"".join(r.v for r in near)).reshape(-1, dims)
    at, ids = np.array([r["query"] for r in near]), np.array([r.id for r in near], np.int64)
    off = np.min([np.abs(c.blocks(x, ids) - c.blocks(q, own)[at]) for c in curves], axis=0)
    off = off[ids != own[at]]                      # a query finds itself anyway
    if not len(off):
        return 0, 1.0
    reach = int(np.quantile(off, recall, method="higher"))
    return reach, float((off <= reach).mean())


def search(vectors: DataFrame, asks: Column, k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding",
           curves: int = CURVES, recall: float = RECALL) -> DataFrame:
    """For each row where ``asks`` holds its ``k`` nearest other rows found: query_id,
    rank (from 1), the id, score; nearest first, ties to the smaller id.

    Vectors that are null, zero, hold null, NaN or infinite entries, or have another
    length than most (the longer on a tie), and rows without an id take no part.
    Rows that repeat an id and its vector count once; an id with several vectors is
    searched, and found, with each, and is no neighbour of itself.  With fewer than
    ``k`` others all are returned.  An empty table, or one without queries, gives an
    empty result; other columns are read by ``asks`` only.
    """
    spark = vectors.sparkSession
    ship_code("tillroll.llm.vectors", __name__)
    schema = f"query_id long, rank int, {id_col} long, score double"
    valid = vectors.filter(vectors[id_col].isNotNull() & usable(vectors[vector_col]) & F.exists(vectors[vector_col], lambda c: c != 0))
    dims = common_length(valid, vector_col)
    if not dims:
        return spark.createDataFrame([], schema)
    single = dict(vectors.dtypes)[vector_col] == "array<float>"
    kind = "<f4" if single else "<f8"
    rows = valid.filter(F.size(vectors[vector_col]) == dims).select(
        vectors[id_col].cast("long").alias("id"), vectors[vector_col].alias("a"), F.coalesce(asks, F.lit(False)).alias("asks"))
    rows = rows.mapInArrow(_packed(dims, kind), "id long, v binary, asks boolean")
    path = scratch_folder(spark, "vectors")
    rows.groupBy("id", "v").agg(F.max("asks").alias("asks")).write.parquet(path)
    rows = spark.read.parquet(path)

    indexed = cut(_first(rows.select("id", "v"), "v", k + 1, F.asc("id")).select("id", "v"))
    questions = cut(rows.filter("asks").groupBy("v").agg(F.min("id").alias("id")))
    questions = cut(questions.withColumn("number", F.monotonically_increasing_id()))
    if not questions.head(1):
        return spark.createDataFrame([], schema)
    sample = indexed.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).collect()
    x = np.frombuffer(b"".join(r.v for r in sample), dtype=kind).reshape(-1, dims).astype(np.float64)
    blocks = max(LEAST_BLOCKS, indexed.count() // BLOCK_ROWS)
    fitted = fit_curves(x, np.array([r.id for r in sample], np.int64), blocks, curves)
    reach, _ = window(indexed, questions, fitted, dims, kind, k + 1, recall)

    path = scratch_folder(spark, "hits")
    for n, curve in enumerate(fitted):             # one copy of the rows is in the shuffle at a time
        placed = "block int, asks boolean, id long, v binary"
        met = (indexed.mapInArrow(_placed(curve, dims, kind, None), placed)
                      .unionByName(questions.mapInArrow(_placed(curve, dims, kind, reach), placed)))
        met = met.repartitionByRange("block").sortWithinPartitions("block", "asks")
        met.mapInArrow(_compared(dims, kind, k + 1), "number long, score double, id long").write.parquet(f"{path}/curve={n}")
    order = Window.partitionBy("number").orderBy(F.desc("score"), F.asc("id"))
    found = (spark.read.parquet(path).withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k + 1)
                  .groupBy("number", "rank").agg(F.first(F.struct("id", "score")).alias("hit"))   # a pair found on two curves
                  .groupBy("number").agg(F.sort_array(F.collect_list(F.struct("rank", "hit"))).alias("found")))
    lists = questions.join(found, "number").select("v", "found")
    mine = rows.filter("asks").select(F.col("id").alias("query_id"), "v")
    others = F.slice(F.filter("found", lambda f: f["hit"]["id"] != F.col("query_id")), 1, k)
    return (mine.join(lists, "v").select("query_id", F.posexplode(others).alias("rank", "f"))
                .select("query_id", (F.col("rank") + 1).alias("rank"), F.col("f.hit.id").alias(id_col), F.col("f.hit.score").alias("score")))
