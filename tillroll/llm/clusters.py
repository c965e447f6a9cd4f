"""Centroid clustering of integer vectors with an incremental distance matrix.

Every vector keeps its exact integer dot products with all centroids.  When
centroids move, a dot product changes by (change of a component) * (the vector's
component), summed over the components that changed; nothing else is computed
anew.  The nearest centroid follows from ``|c|^2 - 2 x.c``, in longs.

The dot products are written as a table in the shared folder, one generation a
round, so a lost executor costs its tasks of one round; the generation before is
removed once the next is written.  The driver sees centroids and their sums
only: ``k * dims`` numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove_folder, scratch_folder, ship_code
from .vectors import grid, lists, matrix, usable

DIMS, CENTROIDS, ROUNDS, SEED = 64, 40, 5, 2
STATE = "id long, x array<int>, dots array<long>"


@dataclass
class Clustering:
    """``rows``: vec_id, cluster, distance; ``centroids``: those of the last assignment."""
    rows: DataFrame
    centroids: np.ndarray


def nearest(dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The centroid of the smallest |c|^2 - 2 x.c for each row (the smaller number on
    a tie) and that value."""
    gap = (centroids * centroids).sum(1) - 2 * dots
    best = gap.argmin(1)
    return best, gap[np.arange(len(dots)), best]


def updated(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after the centroids changed by ``change``: only the nonzero
    components are gone through."""
    dots = dots.copy()
    for c in np.flatnonzero(change.any(1)):
        at = np.flatnonzero(change[c])
        dots[:, c] += x[:, at] @ change[c, at]
    return dots


def _step(change: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for b in batches:
            x = matrix(b.column("x"), change.shape[1], np.int64)
            dots = matrix(b.column("dots"), len(change), np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("x"), lists(updated(dots, x, change))], ["id", "x", "dots"])
    return run


def _sums(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each cluster and component met in a task: how many vectors, and their sum."""
    def run(batches):
        k, dims = centroids.shape
        count, total = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for b in batches:
            best, _ = nearest(matrix(b.column("dots"), k, np.int64), centroids)
            x = matrix(b.column("x"), dims, np.int64)
            count += np.bincount(best, minlength=k)
            for c in np.unique(best):
                total[c] += x[best == c].sum(0)
        met = np.flatnonzero(count)
        at = np.repeat(met, dims)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(np.tile(np.arange(dims, dtype=np.int32), len(met))),
             pa.array(count[at]), pa.array(total[met].ravel())], ["cluster", "dim", "n", "total"])
    return run


def _assigned(centroids: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for b in batches:
            x = matrix(b.column("x"), centroids.shape[1], np.int64)
            best, gap = nearest(matrix(b.column("dots"), len(centroids), np.int64), centroids)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pa.array(best.astype(np.int32)), pa.array(gap + (x * x).sum(1))], ["id", "cluster", "distance"])
    return run


def moved(sums: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Exact floor of the mean of each cluster's vectors; empty clusters stay."""
    out = centroids.copy()
    rows = sums.groupBy("cluster", "dim").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    for r in rows.collect():                      # k * dims rows at most
        out[r.cluster, r.dim] = int(r.total) // r.n
    return out


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", dims: int = DIMS,
            k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> Clustering | None:
    """Cluster the rows whose vector has exactly ``dims`` entries, none null, NaN or
    infinite; entries become floor(256 * entry), at most 2 ** 27 either way.

    The first centroids are the vectors of the ``k`` smallest SHA-256 of
    ``<seed>:<id>``; equal digests (repeated ids) go by their vectors, null ids
    come last.  With fewer rows there are fewer centroids; with none the result is
    None.  Repeated rows are clustered one by one.  Other columns are not read.
    """
    spark = vectors.sparkSession
    ship_code("tillroll.llm.vectors", __name__)
    kept = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).filter(usable(F.col("v"), dims))
    kept = kept.select("id", grid(F.col("v")).cast("array<int>").alias("x"))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = kept.select("x", key.alias("key")).orderBy(F.col("key").asc_nulls_last(), "x").limit(k).collect()
    if not first:
        return None
    centroids = np.array([r.x for r in first], dtype=np.int64)

    start = kept.select("id", "x", F.array(*[F.lit(0).cast("long")] * len(first)).alias("dots"))
    change, state = centroids, start              # the first products are changes from centroids at zero
    for turn in range(rounds + 1):
        old, path = (path if turn else None), scratch_folder(spark, "products")
        state.mapInArrow(_step(change), STATE).write.option("compression", "zstd").parquet(path)
        state = spark.read.parquet(path)
        if old:
            remove_folder(spark, old)
        if turn < rounds:
            new = moved(state.mapInArrow(_sums(centroids), "cluster int, dim int, n long, total long"), centroids)
            change, centroids = new - centroids, new
    rows = state.mapInArrow(_assigned(centroids), "id long, cluster int, distance long")
    return Clustering(rows.withColumnRenamed("id", id_col), centroids)


def inertia(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", **settings) -> DataFrame:
    """One row for each clustered row (see ``cluster``): the id, cluster, distance
    (squared), cluster_inertia and inertia (sums of distance; null if beyond a long)
    and centroid_sha256.  An empty table gives an empty result."""
    done = cluster(vectors, id_col, vector_col, **settings)
    if done is None:
        none = vectors.sparkSession.createDataFrame(
            [], "id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
        return none.withColumnRenamed("id", id_col)
    sums = {r.cluster: int(r.total) for r in done.rows.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()}   # k rows at most
    fits = lambda n: n if n < 1 << 63 else None
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in done.centroids.tolist()]
    by = vectors.sparkSession.createDataFrame(
        [(c, fits(n), fits(sum(sums.values())), digest[c]) for c, n in sums.items()],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return done.rows.join(F.broadcast(by), "cluster").select(
        id_col, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _sql(dims: int = DIMS, k: int = CENTROIDS, rounds: int = ROUNDS, seed: int = SEED) -> str:
    """What the query returns, in DuckDB: plain distances, every round written out."""
    square = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::bigint"
    parts = [f"""
kept as materialized (
  select row_number() over () as r, vec_id, list_transform(embedding, lambda e: floor(e::double * 256)::bigint) as x
  from embeddings
  where len(embedding) = {dims} and len(list_filter(embedding, lambda e: e is not null and isfinite(e))) = {dims}),
c0 as materialized (
  select row_number() over (order by sha256('{seed}:' || vec_id), x) - 1 as n, x as c from kept
  order by n limit {k})"""]
    for turn in range(rounds + 1):
        parts.append(f"""
a{turn} as materialized (
  select r, min({{'d': {square}, 'n': n}}) as best from kept, c{turn} group by r)""")
        if turn < rounds:
            parts.append(f"""
m{turn} as materialized (
  select n, d, sum(v)::bigint as s, count(*) as m
  from (select a.best.n as n, unnest(x) as v, generate_subscripts(x, 1) as d from kept join a{turn} a using (r))
  group by n, d),
c{turn + 1} as materialized (
  select n, coalesce(w, c) as c from c{turn} left join (
    select n, list(((s - ((s % m) + m) % m) // m)::bigint order by d) as w from m{turn} group by n) using (n))""")
    return f"""with {','.join(parts)}
select vec_id, best.n::integer as cluster, best.d as distance,
       sum(best.d) over (partition by best.n)::bigint as cluster_inertia, sum(best.d) over ()::bigint as inertia,
       sha256(list_aggregate(c, 'string_agg', ',')) as centroid_sha256
from kept join a{rounds} using (r) join c{rounds} c on c.n = best.n"""


SQL = _sql()
