"""K-means for many (k, seed) pairs at once.

All runs advance together: one pass over the points assigns every point in every
run and returns a sum, a count and a cost for each centre, added up inside each
task first.  So 70 fits cost the passes of the slowest one instead of 70 times
their own.

Runs start from an oversampled set of candidates: a point enters with a
probability that grows with its squared distance from the mean (half of it
uniform), decided by a hash of its key, and stands for 1 / probability points.
Weighted k-means++ and Lloyd steps on those few thousand candidates, a bounded
number whatever the table's size, give each run its centres; the passes over all
points follow.

Assignment and silhouette of given centres are plain column expressions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..session import scratch_path

# pass code travels with the tasks, executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidates expected, passes over all points, shift of a centre that counts as none.
CANDIDATES = 4096
MAX_PASSES = 20
TOLERANCE = 1e-4


@dataclass
class Points:
    """Standardised points: ``frame`` has the input's columns and ``names`` (scaled), all read
    from a written table; ``rows`` complete ones."""
    frame: DataFrame
    names: list[str]
    rows: int


@dataclass
class Fit:
    k: int
    seed: int
    cost: float
    centres: np.ndarray


def standardise(df: DataFrame, features: Sequence[str]) -> Points:
    """Write ``df`` once, with mean and sample deviation of each feature observed on the
    way, and add the features as z-scores (zero where all values are equal)."""
    watch = Observation()
    complete = _complete(features)
    stats = [F.count_if(complete).alias("rows")]
    for c in features:
        x = F.when(complete, F.col(c).cast("double"))
        stats += [F.avg(x).alias(f"mean_{c}"), F.stddev_samp(x).alias(f"std_{c}")]
    path = scratch_path(df.sparkSession, "points")
    df.observe(watch, *stats).write.parquet(path)
    seen = watch.get
    names = [f"_z_{c}" for c in features]
    scaled = {}
    for c, z in zip(features, names):
        mean, std = seen[f"mean_{c}"], seen[f"std_{c}"]
        flat = not std or np.isnan(std)
        scaled[z] = F.when(complete, F.lit(0.0) if flat else (F.col(c).cast("double") - mean) / std)
    return Points(df.sparkSession.read.parquet(path).withColumns(scaled), names, seen["rows"])


def _complete(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return out


# -- starts --------------------------------------------------------------------
def candidates(points: Points, key: str, expected: int = CANDIDATES) -> tuple[np.ndarray, np.ndarray]:
    """A sample of the points and the number of points that each stands for.

    Squared distances from the mean add up to (rows - 1) * features on z-scores,
    so the probabilities need no pass of their own."""
    square = sum((F.col(c) * F.col(c) for c in points.names), F.lit(0.0))
    total = max(1, points.rows - 1) * len(points.names)
    chance = F.least(F.lit(1.0), F.lit(float(expected)) * (F.lit(0.5 / max(1, points.rows)) + square * F.lit(0.5 / total)))
    drawn = F.pmod(F.xxhash64(F.col(key), F.lit("candidate")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = points.frame.where(_complete(points.names)).select(*points.names, chance.alias("p"), drawn.alias("u")).where("u < p")
    got = rows.collect()                             # ``expected`` rows, whatever the table's size
    return np.array([r[:len(points.names)] for r in got]).reshape(-1, len(points.names)), np.array([1 / r.p for r in got])


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((x[:, None, :] - centres[None, :, :]) ** 2).sum(2)


def start(x: np.ndarray, weight: np.ndarray, k: int, seed: int, steps: int = 50) -> np.ndarray:
    """Weighted k-means++ draws and Lloyd steps on the candidates."""
    rng = np.random.default_rng([seed, k])
    pick = [rng.choice(len(x), p=weight / weight.sum())]
    near = _squares(x, x[pick])[:, 0]
    for _ in range(1, k):
        mass = weight * near
        at = rng.choice(len(x), p=mass / mass.sum()) if mass.sum() > 0 else pick[0]
        pick.append(at)
        near = np.minimum(near, _squares(x, x[[at]])[:, 0])
    centres = x[pick].copy()
    for _ in range(steps):
        best = _squares(x, centres).argmin(1)
        mass = np.bincount(best, weight, k)
        sums = np.stack([np.bincount(best, weight * c, k) for c in x.T], 1)
        moved = np.where(mass[:, None] > 0, sums / np.maximum(mass, 1e-300)[:, None], centres)
        done = np.abs(moved - centres).max() < 1e-9
        centres = moved
        if done:
            break
    return centres


# -- passes --------------------------------------------------------------------
def _pass(runs: list[np.ndarray]):
    """One task: counts, costs and sums of every centre of every run, over all its batches."""
    ends = np.cumsum([0] + [len(c) for c in runs])

    def run(batches: Iterable[pa.RecordBatch]):
        dims = runs[0].shape[1]
        n, cost, square, sums = np.zeros(ends[-1], np.int64), np.zeros(ends[-1]), np.zeros(ends[-1]), np.zeros((ends[-1], dims))
        for b in batches:
            x = _matrix(b)
            sq = (x * x).sum(1)
            for lo, centres in zip(ends, runs):
                near = _squares(x, centres)
                best = near.argmin(1)
                at = slice(lo, lo + len(centres))
                n[at] += np.bincount(best, minlength=len(centres))
                cost[at] += np.bincount(best, near[np.arange(len(x)), best], len(centres))
                square[at] += np.bincount(best, sq, len(centres))
                for d in range(dims):
                    sums[at, d] += np.bincount(best, x[:, d], len(centres))
        met = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(cost[met]), pa.array(square[met]),
             *[pa.array(sums[met, d]) for d in range(dims)]],
            ["centre", "n", "cost", "square", *[f"s{d}" for d in range(dims)]])
    return run


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], 1)


def _totals(rows: DataFrame, sets: Sequence[np.ndarray]) -> list[list]:
    """For each set of centres, for each centre: the row of its n, cost, square and sums
    s0, s1, ..., or None where no point is nearest to it.  ``rows`` has the points only."""
    sums = ["cost", "square", *[f"s{d}" for d in range(len(rows.columns))]]
    schema = ", ".join(["centre int", "n long", *[f"{c} double" for c in sums]])
    got = rows.mapInArrow(_pass(list(sets)), schema).groupBy("centre").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect()
    at = {r.centre: r for r in got}                  # one row for each centre of each set
    ends = np.cumsum([0] + [len(c) for c in sets])
    return [[at.get(lo + j) for j in range(len(c))] for lo, c in zip(ends, sets)]


def fit_many(points: Points, key: str, runs: Sequence[tuple[int, int]], passes: int = MAX_PASSES,
             tolerance: float = TOLERANCE) -> list[Fit]:
    """Fit every (k, seed) of ``runs``; a run is done when no centre moves by more than
    ``tolerance``.  Empty centres stay where they are.  Without complete points there
    are no fits."""
    x, weight = candidates(points, key)
    if not len(x):
        return []
    fits = [Fit(k, seed, float("inf"), start(x, weight, k, seed)) for k, seed in runs]
    live = list(range(len(fits)))
    rows = points.frame.where(_complete(points.names)).select(*points.names)
    for turn in range(passes):
        totals = _totals(rows, [fits[i].centres for i in live])
        still = []
        for i, got in zip(live, totals):
            f = fits[i]
            f.cost = sum(r.cost for r in got if r)
            moved = np.array([[r[f"s{d}"] / r.n for d in range(len(points.names))] if r else c for r, c in zip(got, f.centres)])
            if ((moved - f.centres) ** 2).sum(1).max() > tolerance ** 2 and turn < passes - 1:
                f.centres = moved
                still.append(i)
        live = still
        if not live:
            break
    return fits


def best_fits(fits: Sequence[Fit]) -> dict[int, Fit]:
    """For each k the run of the lowest cost, then of the lowest seed."""
    out: dict[int, Fit] = {}
    for f in sorted(fits, key=lambda f: (f.cost, f.seed)):
        out.setdefault(f.k, f)
    return out


# -- given centres -----------------------------------------------------------------
def _distance(names: Sequence[str], centre: Sequence[float]) -> Column:
    return sum(((F.col(c) - float(v)) * (F.col(c) - float(v)) for c, v in zip(names, centre)), F.lit(0.0))


def nearest(names: Sequence[str], centres: Sequence[Sequence[float]]) -> Column:
    """Number of the nearest centre (the smaller on a tie); NULL for an incomplete point."""
    best = F.array_min(F.array(*[F.struct(_distance(names, c).alias("d"), F.lit(j).alias("j")) for j, c in enumerate(centres)]))
    return F.when(_complete(names), best["j"])


def _silhouette_pass(sets: Sequence[np.ndarray], totals: list[list]):
    """One task: the sum of the points' silhouettes for each set, and the points."""
    stats = [[(j, r.n, r.square, np.array([r[f"s{d}"] for d in range(c.shape[1])])) for j, r in enumerate(t) if r]
             for c, t in zip(sets, totals)]

    def run(batches: Iterable[pa.RecordBatch]):
        total, n = np.zeros(len(sets)), 0
        for b in batches:
            x = _matrix(b)
            n, square = n + len(x), (x * x).sum(1)
            for i, (centres, here) in enumerate(zip(sets, stats)):
                if len(here) < 2:
                    continue
                best = _squares(x, centres).argmin(1)
                numbers, sizes = np.array([h[0] for h in here]), np.array([h[1] for h in here], float)
                all_to = sizes * square[:, None] + np.array([h[2] for h in here]) - 2 * x @ np.stack([h[3] for h in here]).T
                mine = numbers[None, :] == best[:, None]
                own = (all_to * mine).sum(1) / np.maximum((sizes * mine).sum(1) - 1, 1)
                other = np.where(mine, np.inf, all_to / sizes).min(1)
                top = np.maximum(own, other)
                ok = ((sizes * mine).sum(1) > 1) & (top > 0)
                total[i] += np.where(ok, (other - own) / np.where(ok, top, 1), 0).sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sets), dtype=np.int32)), pa.array(total), pa.array([n] * len(sets), pa.int64())],
                                         ["number", "total", "n"])
    return run


def silhouettes(points: Points, centres: dict[object, Sequence[Sequence[float]]]) -> dict[object, float]:
    """Mean silhouette (squared Euclidean) of several sets of centres in two passes.

    The first gathers size, sum and sum of squares of each cluster; with those a
    point's mean squared distance to a cluster needs no other points.  A point
    alone in its cluster, or with no other cluster, counts 0; NULL without points."""
    names, sets = list(centres), [np.array(c, float) for c in centres.values()]
    rows = points.frame.where(_complete(points.names)).select(*points.names)
    sent = rows.mapInArrow(_silhouette_pass(sets, _totals(rows, sets)), "number int, total double, n long")
    got = sent.groupBy("number").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect()
    return {names[r.number]: r.total / r.n if r.n else None for r in got}
