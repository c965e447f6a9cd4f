import numpy as np
from pyspark.sql import functions as F

from tillroll.llm import neighbours as N
from tillroll.llm.queries import op13_neighbours

from .conftest import SF
from .vector_rows import SCHEMA, odd_rows, whole


def brute(rows, asks, k=20):
    """(query id, its vector) -> the k nearest other ids with scores."""
    rows = sorted({(r[0], tuple(r[1])) for r in whole(rows, len(rows[0][1])) if any(r[1]) and r[0] is not None})
    x = np.array([r[1] for r in rows], float)
    out = {}
    for (i, v), q in zip(rows, x):
        if asks(i):
            near = sorted((-float((q * c).sum()), j) for (j, _), c in zip(rows, x) if j != i)[:k]
            out[(i, v)] = [(j, -s) for s, j in near]
    return out


def recall(got, want, k=20):
    found = {}
    for r in got:
        found.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    share = []
    for (i, _), near in want.items():
        assert sorted(found[i]) == list(range(1, len(found[i]) + 1)) and len(found[i]) == len(near)
        mine = [found[i][n] for n in sorted(found[i])]
        assert mine == sorted(mine, key=lambda m: (-m[1], m[0]))
        share.append(len({m[0] for m in mine} & {n[0] for n in near}) / max(1, len(near)))
    return np.mean(share)


def test_query_reaches_its_recall(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = op13_neighbours(spark, SF).collect()
    want = brute(rows, lambda i: i % 20 == 0)
    assert len(got) == 20 * len(want) and recall(got, want) >= 0.9
    by = {r[0]: np.array(r[1], float) for r in rows}
    assert all(r.score == (by[r.query_id] * by[r.vec_id]).sum() for r in got)


def test_windows_are_narrow_where_vectors_have_structure(spark, saved, monkeypatch):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(200, 16))
    rows = [(i, (centres[i % 200] + 0.05 * rng.normal(size=16)).tolist(), None, "", "", 1) for i in range(6000)]
    rows = [(r[0], [float(np.float32(c)) for c in r[1]], *r[2:]) for r in rows]
    seen = []
    plain = N.window
    monkeypatch.setattr(N, "window", lambda *a, **b: seen.append(plain(*a, **b)) or seen[-1])
    got = N.search(saved(rows, SCHEMA), F.col("vec_id") % 100 == 0, k=10).collect()
    assert seen[0][0] <= 4 and recall(got, brute(rows, lambda i: i % 100 == 0, 10), 10) >= 0.9


def test_full_windows_equal_brute_force_on_odd_rows(saved):
    rows = odd_rows(dims=8)
    got = N.search(saved(rows, SCHEMA), F.col("vec_id") % 4 == 0, recall=1.0).collect()
    want = brute(rows, lambda i: i % 4 == 0)
    flat = sorted((i, n + 1, j, s) for (i, _), near in want.items() for n, (j, s) in enumerate(near))
    assert sorted(map(tuple, got)) == flat                       # hot vector: ties by id; an id with two vectors


def test_few_rows_and_none(saved, spark):
    rows = [(i, [1.0, float(i)], None, "", "", 1) for i in range(3)]
    got = N.search(saved(rows, SCHEMA), F.col("vec_id") == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in sorted(got, key=lambda r: r.rank)] == [(0, 1, 1, 1.0), (0, 2, 2, 1.0)]
    assert N.search(saved(rows, SCHEMA), F.col("vec_id") == 9).count() == 0
    assert N.search(saved(rows[:1], SCHEMA), F.col("vec_id") == 0).count() == 0
    empty = N.search(spark.createDataFrame([], SCHEMA), F.lit(True))
    assert empty.count() == 0 and empty.columns == ["query_id", "rank", "vec_id", "score"]


def test_hilbert_curve_visits_every_cell_by_steps_of_one():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    order = cells[np.argsort(N.hilbert(cells, 3))]
    assert sorted(N.hilbert(cells, 3)) == list(range(512))
    assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_crowded_cells_are_cut_by_id():
    x, ids = np.ones((4096, 8)), np.arange(4096)
    curve = N.fit_curves(x, ids, 32)[0]
    assert np.bincount(curve.blocks(x, ids)).max() < 300
