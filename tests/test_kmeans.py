"""Batched k-means: passes, cost against separate fits, silhouettes against their definition."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler

from tillroll.operators import kmeans as K


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(4)
    at = rng.normal(size=(5, 3)) * 6
    x = np.concatenate([at[i % 5] + rng.normal(size=(1, 3)) for i in range(6000)])
    x[2000:] = x[0]                                    # a hot point holds two thirds
    x[2000:2400] += rng.normal(size=(400, 3)) * 20
    rows = [(i, *map(float, r)) for i, r in enumerate(x)] + [(9000, None, 1.0, 2.0), (9001, float("nan"), 1.0, 2.0)]
    return K.standardise(spark.createDataFrame(rows, "id long, a double, b double, c double").repartition(5), ["a", "b", "c"])


def _matrix(points):
    return np.array([tuple(r) for r in points.frame.where(K._complete(points.names)).select(*points.names).collect()])


def test_standardised_once_and_complete(blobs):
    x = _matrix(blobs)
    assert blobs.rows == len(x) == 6000
    assert np.abs(x.mean(0)).max() < 1e-9 and np.allclose(x.std(0, ddof=1), 1)


def test_candidates_stand_for_all_points(blobs):
    x, weight = K.candidates(blobs, "id", 1500)
    assert 900 < len(x) < 2200
    assert abs(weight.sum() / blobs.rows - 1) < 0.15


def test_fits_cost_no_more_than_separate_ones(blobs):
    runs = [(k, s) for k in (2, 4, 6) for s in range(42, 47)]
    best = K.best_fits(K.fit_many(blobs, "id", runs))
    frame = VectorAssembler(inputCols=blobs.names, outputCol="features", handleInvalid="skip").transform(blobs.frame)
    for k, fit in best.items():
        alone = min(KMeans(k=k, seed=s).fit(frame).summary.trainingCost for s in range(42, 47))
        assert fit.cost <= alone * 1.0001
        x = _matrix(blobs)
        assert abs(K._squares(x, fit.centres).min(1).sum() - fit.cost) < 1e-6 * fit.cost


def test_all_runs_share_their_passes(blobs, monkeypatch):
    seen = []
    plain = K._totals
    monkeypatch.setattr(K, "_totals", lambda rows, sets: seen.append(len(sets)) or plain(rows, sets))
    runs = [(k, s) for k in range(2, 9) for s in range(10)]
    assert len(K.fit_many(blobs, "id", runs)) == 70
    assert seen[0] == 70 and len(seen) <= K.MAX_PASSES and seen == sorted(seen, reverse=True)


def test_assignment_column_equals_the_passes(blobs):
    centres = [[0.0, 0, 0], [1, 1, 1], [1, 1, 1], [-2, 0, 1]]
    got = blobs.frame.withColumn("j", K.nearest(blobs.names, centres))
    counts = {r.j: r["count"] for r in got.groupBy("j").count().collect()}
    totals = K._totals(blobs.frame.where(K._complete(blobs.names)).select(*blobs.names), [np.array(centres, float)])[0]
    assert counts.pop(None) == 2
    assert counts == {j: r.n for j, r in enumerate(totals) if r}


def test_silhouettes_follow_their_definition(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 2))
    x[0] = 50.0                                        # alone in its cluster
    points = K.standardise(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double"), ["a", "b"])
    z = _matrix(points)
    centres = [z[0].tolist(), [0.0, 0.0], [-0.3, -0.2], [99.0, 99.0]]
    best = K._squares(z, np.array(centres)).argmin(1)
    d = K._squares(z, z)
    s = []
    for i, j in enumerate(best):
        own = best == j
        if own.sum() == 1:
            s.append(0.0)
            continue
        a = d[i, own].sum() / (own.sum() - 1)
        b = min(d[i, best == o].mean() for o in set(best) if o != j)
        s.append((b - a) / max(a, b))
    got = K.silhouettes(points, {"here": centres, "one": [[0.0, 0.0]]})
    assert abs(got["here"] - np.mean(s)) < 1e-9 and got["one"] == 0.0


def test_no_points(spark):
    points = K.standardise(spark.createDataFrame([(1, None)], "id long, a double"), ["a"])
    assert points.rows == 0 and K.fit_many(points, "id", [(2, 1)]) == []
