"""Rows of an embeddings table with every odd case the vector operators define."""
import numpy as np

SCHEMA = "vec_id long, embedding array<float>, id long, x string, v string, cluster int"


def odd_rows(dims=64, n=60, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(i, [float(np.float32(c)) for c in rng.normal(size=dims)]) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(n, None), (n + 1, []), (n + 2, [1.0] * (dims - 1)), (n + 3, [nan] + [1.0] * (dims - 1)),
             (n + 4, [1.0] * (dims - 1) + [-inf]), (n + 5, [None] + [1.0] * (dims - 1)), (n + 6, [0.0] * dims)]
    rows += [(100 + i, rows[0][1]) for i in range(40)]            # a hot vector
    rows += [rows[1], rows[1], (rows[2][0], rows[3][1])]          # a repeated row, an id with two vectors
    return [(*r, None, "clash", "clash", 1) for r in rows]


def whole(rows, dims=64):
    return [r for r in rows if r[1] is not None and len(r[1]) == dims and all(c is not None and np.isfinite(c) for c in r[1])]
