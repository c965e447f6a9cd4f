import numpy as np
import pytest

from tillroll.llm import whitening as W
from tillroll.llm.queries import op11_whitening
from tillroll.llm.vectors import exact_gram

from .conftest import SF
from .vector_rows import SCHEMA, odd_rows, whole


def known(values, seed=0):
    """A matrix with these eigenvalues, and its eigenvectors, in extended precision."""
    rng, d = np.random.default_rng(seed), len(values)
    q = np.eye(d, dtype=np.longdouble)
    for _ in range(3):
        h = np.r_[7, rng.integers(-5, 6, d - 1)].astype(np.longdouble)
        q = q - 2 * np.outer(q @ h, h) / (h @ h)
    return (q * np.asarray(values, np.longdouble)) @ q.T, q


@pytest.mark.parametrize("values,most", [
    (np.linspace(1, 2, 20), 1e-15),
    (np.r_[np.linspace(1, 2, 16), 3, 3 + 1e-9, 3 + 2e-9, 3 + 1e-6], 1e-9),      # a narrow cluster
    (np.r_[1e-8, np.linspace(1, 1.0001, 18), 1e4], 1e-10),                      # clusters in float32
])
def test_eigenvectors_of_known_matrices(values, most):
    a, q = known(values)
    got, x = W.eigenvectors(a)
    order = np.argsort(-values, kind="stable")
    assert np.allclose(got, values[order], rtol=1e-14, atol=1e-15 * values.max())
    assert np.abs(np.abs(x) - np.abs(q[:, order].astype(float))).max() < most
    assert np.abs(x.T @ x - np.eye(len(a))).max() < 1e-14


def test_equal_eigenvalues_give_an_orthonormal_basis_of_their_space():
    a, q = known([1] * 10 + [2] * 10)
    got, x = W.eigenvectors(a)
    assert np.allclose(got, [2] * 10 + [1] * 10, rtol=1e-14)
    assert np.abs(x.T @ x - np.eye(20)).max() < 1e-14
    assert np.abs(np.asarray(a, float) @ x - x * got).max() < 1e-13


def test_refinement_beats_its_float32_start():
    a, q = known(np.linspace(1, 2, 20))
    start = np.linalg.eigh(np.asarray(a, np.float32))[1]
    assert np.abs(np.abs(start) - np.abs(q.astype(float))).max() > 1e-7        # what the iterations have to mend


def test_gram_is_exact_for_large_entries():
    rng = np.random.default_rng(0)
    rows = rng.integers(-(1 << 40), 1 << 40, (3000, 5))
    o = rows.astype(object)
    assert (exact_gram(rows) == o.T @ o).all()


def brute(rows):
    rows = whole(rows, len(rows[0][1]))
    x = np.array([np.floor(256 * np.array(r[1], float)) for r in rows])
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    e, u = np.linalg.eigh(np.cov(fit.T, bias=True))
    e, u = e[::-1], u[:, ::-1]
    return n, ((n * x - s) ** 2).sum(1), (x - s / n) @ u[:, :4] / np.sqrt(e[:4]), e[:4] / e.sum(), [r[0] for r in rows]


def compare(got, rows):
    n, deviation, whitened, explained, ids = brute(rows)
    table = {}
    for r in got:
        assert r.n == n and r.identity_error < 1e-10
        assert abs(r.explained - explained[r.component - 1]) < 1e-12
        table.setdefault((r.vec_id, r.deviation), {})[r.component] = r.whitened
    assert len(got) == 4 * len(ids) and set(table) == set(zip(ids, map(int, deviation)))
    signs = None
    for i, d, w in zip(ids, deviation, whitened):
        mine = np.array([table[(i, int(d))][c] for c in (1, 2, 3, 4)])
        if signs is None:
            signs = np.sign(mine * w)
        assert np.abs(mine * signs - w).max() < 1e-9


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    compare(op11_whitening(spark, SF).collect(), rows)


def test_odd_rows(saved):
    rows = odd_rows(dims=8)
    compare(W.whiten(saved(rows, SCHEMA)).collect(), rows)


def test_partitions_do_not_matter(saved):
    rows = odd_rows(dims=8)
    one, many = (sorted(map(tuple, W.whiten(saved(rows, SCHEMA, parts)).select("vec_id", "component", "whitened").collect())) for parts in (1, 7))
    assert one == many


def test_no_variance_no_rows(saved, spark):
    assert W.whiten(saved([(1, [1.0, 2.0], None, "", "", 1)] * 3, SCHEMA)).count() == 0
    empty = W.whiten(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]


def test_fewer_components_than_asked(saved):
    got = W.whiten(saved([(i, [float(i), 5.0], None, "", "", 1) for i in range(5)], SCHEMA)).collect()
    assert {r.component for r in got} == {1} and abs(got[0].explained - 1) < 1e-12


def test_deviation_beyond_a_long_is_null(saved):
    got = W.whiten(saved([(i, [1e9 * i, 1.0 * (i % 2)], None, "", "", 1) for i in range(5)], SCHEMA)).collect()
    assert {r.deviation for r in got if r.vec_id == 2} != {None} and {r.deviation for r in got if r.vec_id == 0} == {None}
