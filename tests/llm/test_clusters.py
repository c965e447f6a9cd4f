import hashlib

import duckdb
import numpy as np

from tillroll.llm import clusters as C
from tillroll.llm.queries import op12_clusters

from .conftest import SF
from .vector_rows import SCHEMA, odd_rows, whole


def brute(rows, k=40, rounds=5):
    rows = whole(rows, len(rows[0][1]))
    x = [[int(np.floor(256 * float(c))) for c in r[1]] for r in rows]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    order = sorted(range(len(x)), key=lambda i: (digest(f"2:{rows[i][0]}"), x[i]))
    centres = [x[i] for i in order[:k]]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(centres))
    for _ in range(rounds):
        at = [near(v)[1] for v in x]
        for j in set(at):
            mine = [v for v, a in zip(x, at) if a == j]
            centres[j] = [sum(c) // len(mine) for c in zip(*mine)]
    out = [near(v) for v in x]
    total = {}
    for d, j in out:
        total[j] = total.get(j, 0) + d
    return sorted((r[0], j, d, total[j], sum(total.values()), digest(",".join(map(str, centres[j])))) for r, (d, j) in zip(rows, out))


def result(df):
    return sorted(map(tuple, df.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()))


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    rel = con.sql(C.SQL)
    df = op12_clusters(spark, SF)
    assert rel.columns == df.columns
    assert result(df) == sorted(rel.fetchall())


def test_odd_rows_match_brute_force(saved):
    rows = odd_rows()
    assert result(C.inertia(saved(rows, SCHEMA))) == brute(rows)


def test_fewer_vectors_than_centroids(saved):
    rows = odd_rows()[:7]
    got = result(C.inertia(saved(rows, SCHEMA)))
    assert got == brute(rows) and [r[2] for r in got] == [0] * 7


def test_empty_table(spark, saved):
    assert C.inertia(spark.createDataFrame([], SCHEMA)).count() == 0
    assert C.inertia(saved([(1, [1.0], None, "", "", 1)], SCHEMA)).count() == 0


def test_entries_beyond_the_limit(saved):
    rows = [(i, [3e38 if i == 1 else float(i)] + [0.0] * 63, None, "", "", 1) for i in range(3)]
    got = result(C.inertia(saved(rows, SCHEMA), k=1, rounds=0))
    assert max(r[2] for r in got) >= (C.grid.__defaults__[0] - 1024) ** 2


def test_updates_equal_products(spark):
    rng = np.random.default_rng(0)
    x, old, new = rng.integers(-99, 99, (50, 8)), rng.integers(-99, 99, (5, 8)), rng.integers(-99, 99, (5, 8))
    new[:, 3:] = old[:, 3:]
    new[2] = old[2]
    assert (C.updated(x @ old.T, x, new - old) == x @ new.T).all()


def test_ties_go_to_the_smaller_number():
    centres = np.array([[1, 0], [-1, 0], [1, 0]])
    assert list(C.nearest(np.array([[0, 5], [3, 0]]) @ centres.T, centres)[0]) == [0, 0]
