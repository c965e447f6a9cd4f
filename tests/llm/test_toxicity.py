import zlib
from itertools import combinations

import numpy as np
import pytest

from tillroll.llm import toxicity as T

SF = "/root/testdata/sf0.1"


def kernel(a, b):
    total = 0.0
    for x in combinations(range(len(a)), T.ORDER):
        for y in combinations(range(len(b)), T.ORDER):
            spans = x[-1] - x[0] + 1, y[-1] - y[0] + 1
            if max(spans) <= T.SPAN and all(a[i] == b[j] for i, j in zip(x, y, strict=True)):
                total += T.DECAY ** sum(spans)
    return total


def test_kernel_matches_its_definition():
    words, marks = ["idixot", "moronic", "idiotidiot", "zzzzz"], ["idiot", "moron"]
    letters = T.Alphabet("".join(sorted(set("idiotmoron"))))
    got = T.kernel_rows(words, marks, letters)
    want = [[kernel(w, z) / (kernel(w, w) * kernel(z, z)) ** 0.5 for z in marks] for w in words]
    assert np.allclose(got, want, atol=1e-6)


def test_words_are_squeezed_and_long_ones_windowed():
    assert {"idiot"} <= T.words("an i d i o t!") and {"idiot"} <= T.words("i.d.i.o.t") and {"idiot"} <= T.words("id_iot")
    long = T.words("x" * 30 + "idiot" + "y" * 200_000)
    assert any("idiot" in w for w in long) and max(map(len, long)) <= T.LONGEST
    assert T.words("") == set() == T.words("\n .")


@pytest.fixture(scope="module")
def scored(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    rows = T.classify(docs, labels).collect()
    return {r.doc_id: r for r in rows}, {r.doc_id: r.toxic for r in labels.collect()}


def test_held_out_documents(scored):
    rows, labels = scored
    assert len(rows) == 10_000
    for i, r in rows.items():
        assert r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.5)
    test = [(labels[i], rows[i].predicted) for i in labels if rows[i].held_out]
    assert sum(y == p for y, p in test) >= 0.95 * len(test)
    by = {y: [rows[i].score for i in labels if rows[i].held_out and labels[i] == y] for y in (0, 1)}
    wins = [(b > a) + 0.5 * (a == b) for a in by[0] for b in by[1]]
    assert sum(wins) / len(wins) >= 0.95


def test_model_tolerates_inserted_letters():
    rng = np.random.default_rng(3)
    insults = ["pillock", "wazzock", "gobshyte"]
    parts = ["the", "er", "in", "on", "an", "re", "st", "ti", "nd", "ou"]
    word = lambda: "".join(rng.choice(parts, rng.integers(2, 5)))
    bags = [(y, sorted({word() for _ in range(60)} | ({insults[k % 3]} if y else set())))
            for k in range(300) for y in (0, 1)]
    model = T.fit(bags)
    score = lambda w: model.score(model.margins([w]).get(w, model.bias))
    assert all(score(w) > 0.5 for w in insults)
    gapped = [w[:k] + "q" + w[k:] for w in insults for k in range(2, len(w) - 1)]
    assert sum(score(w) > 0.5 for w in gapped) >= 0.8 * len(gapped)
    clean = [word() for _ in range(500)]
    assert sum(score(w) > 0.5 for w in clean) <= 5


def test_odd_rows_and_missing_labels(spark, saved):
    df = saved([(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, "x" * 200_000, "c")],
               "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = T.classify(df, none).collect()
    assert len(rows) == 4 and {r.predicted for r in rows} == {0} and not any(
        r.held_out for r in rows if r.doc_id is None)
    assert T.classify(df.limit(0), none).count() == 0
    odd = spark.createDataFrame([(1, 1, None), (None, 1, 1), (2, 0, 1), (2, 0, 0)], "doc_id long, quality int, toxic int")
    assert T.classify(df, odd).count() == 4
