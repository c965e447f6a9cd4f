import random
import re

import numpy as np
import pytest

from tillroll.llm import jaccard_join as J
from tillroll.llm import partenum as P
from tillroll.llm.queries import op6_jaccard_join

from .conftest import SF


def shingles(t):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if c.isascii() else c for c in t or ""))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and 100 * common >= 80 * (len(a) + len(sets[j]) - common):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, len(sets[i]), low.get(find(i)) if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def joined(df):
    return sorted((tuple(r) for r in J.near_duplicates(df).collect()), key=str)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    seen = 0
    for _ in range(1500):
        n = int(rng.choice([4, 5, 6, 8, 9, 10, 12, 15, 20, 24, 30, 50, 100, 300, 700]))
        pool = rng.integers(0, 2 ** 63, 2 * n + 20).astype(np.uint64)
        gone, more = int(rng.integers(0, n // 4 + 2)), int(rng.integers(0, n // 4 + 2))
        a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[gone:n], pool[n:n + more]]))
        common = len(np.intersect1d(a, b))
        if common and 100 * common >= 80 * (len(a) + len(b) - common) and not np.array_equal(a, b):
            seen += 1
            sig, owner = P.signatures([a, b])
            assert set(sig[owner == 0]) & set(sig[owner == 1])
    assert seen > 300


def test_levels_keep_the_guarantee_when_parts_are_empty(monkeypatch):
    monkeypatch.setattr(P, "LEVELS", 1)  # the last level signs empty projections too
    rng = np.random.default_rng(2)
    for _ in range(300):
        pool = rng.integers(0, 2 ** 63, 8).astype(np.uint64)
        sig, owner = P.signatures([np.unique(pool[:5]), np.unique(pool[:4])])
        assert set(sig[owner == 0]) & set(sig[owner == 1])


def test_query_matches_brute_force(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = sorted((tuple(r) for r in op6_jaccard_join(spark, SF).collect()), key=str)
    assert got == brute(rows)


def test_chains_and_border_cases_match_brute_force(spark, saved):
    """Chains of edits whose ends are not similar, sizes from 1 to 300 words, and
    pairs on both sides of the limit: every link matters."""
    rng = random.Random(4)
    rows, i = [], 0
    for _ in range(60):
        words = [rng.choice("abcdefghij") + str(rng.randrange(400)) for _ in range(rng.choice([3, 6, 8, 9, 13, 30, 60, 300]))]
        for _ in range(rng.randint(1, 7)):
            rows.append((i, " ".join(words)))
            i += 1
            for _ in range(rng.randint(0, max(1, len(words) // 40))):
                words[rng.randrange(len(words))] = str(rng.randrange(1000))
            if rng.random() < 0.4:
                words = words + ["tail"] if rng.random() < 0.5 else words[1:]
    rng.shuffle(rows)
    assert joined(saved(rows, "doc_id long, text string", 5)) == brute(rows)


def test_sketches_fold_and_never_pass_the_true_difference():
    rng = np.random.default_rng(9)
    for _ in range(200):
        n = int(rng.integers(5, 2500))
        pool = np.unique(rng.integers(0, 2 ** 63, 2 * n + 20).astype(np.uint64))
        a, b = pool[:n], np.sort(pool[int(rng.integers(0, n // 5 + 1)):n + int(rng.integers(0, n // 5 + 1))])
        word, owner, place = J.sketches([a, b])
        one, two = word[owner == 0], word[owner == 1]
        assert list(place[owner == 1]) == list(range(len(two))) and 64 * len(one) >= len(a)
        while len(one) != len(two):
            one, two = ((x[:len(x) // 2] ^ x[len(x) // 2:]) if len(x) == max(len(one), len(two)) else x
                        for x in (one, two))
        differ = sum(int(x).bit_count() for x in (one ^ two).view(np.uint64))
        assert differ <= len(np.setxor1d(a, b))


def test_large_sets_of_two_sketch_sizes(saved):
    rng = random.Random(8)
    rows = []
    for g in range(4):
        base = [f"g{g}w{rng.randrange(5000)}" for _ in range(540)]
        for k in range(6):
            own = base[:540 - 12 * k]
            for _ in range(rng.randint(0, 12)):
                own[rng.randrange(len(own))] = f"new{rng.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(own)))
    assert joined(saved(rows, "doc_id long, text string")) == brute(rows)


def test_a_hot_group_is_one_component(saved, monkeypatch):
    monkeypatch.setattr(J, "PARTNERS", 16)
    rng = random.Random(6)
    words = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(300):
        own = list(words)
        own[rng.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    assert joined(saved(rows, "doc_id long, text string", 7)) == brute(rows)


@pytest.mark.parametrize("low", [1, 64])
def test_near_copies_around_the_limit_are_paired_once(spark, saved, monkeypatch, low):
    """Members of one family, similar to some and just not to others: each unsettled pair is
    made about once, however many signatures it shares, and no link is lost."""
    monkeypatch.setattr(J, "LOWEST", low)
    made = []
    frame = type(spark.range(1))
    plain = frame.distinct

    def seen(self):
        if self.columns == ["a", "b"] and "one" in self._jdf.queryExecution().analyzed().toString():
            made.append((self.count(), plain(self).count()))
        return plain(self)

    rng = random.Random(12)
    rows = []
    for i in range(400):
        own = [f"w{k}" for k in range(120)]
        for _ in range(rng.randint(2, 5)):             # each change takes up to five shingles of 116
            own[rng.randrange(120)] = f"x{i}y{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(own)))
    monkeypatch.setattr(frame, "distinct", seen)
    got = joined(saved(rows, "doc_id long, text string", 5))
    monkeypatch.setattr(frame, "distinct", plain)
    assert got == brute(rows)
    assert made or low == 1
    if low == 64:
        assert all(rows_made <= 1.2 * pairs + 50 for rows_made, pairs in made), made


def test_odd_rows(saved, spark):
    rows = [(None, "a b c d e f g h i j"), (None, "a b c d e f g h i j"), (7, "A b c d e f g h i j k"), (1, ""), (2, None),
            (3, " \t\n"), (4, "x y"), (5, "X y"), (None, None), (6, "x y z"), (6, "x  y z"), (None, "only here q r s t u"),
            (8, "a b c d e f g h i j z"), (9, "É b"), (10, "é b"), (11, "wide space"), (12, "word " * 60_000)]
    df = saved(rows, "doc_id long, text string").withColumn("vertex", J.F.lit("x")).withColumn("key", J.F.lit(1))
    assert joined(df) == brute(rows)
    kept = J.drop_near_duplicates(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(None) == 4 and sorted(x for x in ids if x is not None) == [1, 2, 3, 4, 6, 6, 7, 9, 10, 11, 12]
    assert J.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("total", range(2, 400))
def test_least_common_is_the_contract(total):
    least = P.least_common(total)
    assert 100 * least >= 80 * (total - least) and 100 * (least - 1) < 80 * (total - least + 1)


def test_small_frames_make_few_tasks(spark):
    """However many partitions a shuffle has, labels of a few vertices are read by no more tasks than there are cores."""
    most = spark.sparkContext.defaultParallelism
    settings = {"spark.sql.shuffle.partitions": str(16 * most), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        links = J.cut(spark.createDataFrame([(k, k + 1) for k in range(0, 90) if k % 10 < 8], "a long, b long").repartition("a"))
        assert links.rdd.getNumPartitions() > most
        roots = J.components(links)
        more = J.merged(roots, J.cut(spark.createDataFrame([(8, 10), (95, 96)], "a long, b long")))
        assert roots.rdd.getNumPartitions() <= most and more.rdd.getNumPartitions() <= most
        want = {k: k - k % 10 for k in range(0, 90) if k % 10 < 9}
        assert {r.vertex: r.root for r in roots.collect()} == want
        assert {r.vertex: r.root for r in more.collect()} == {k: 0 if v == 10 else v for k, v in want.items()} | {95: 95, 96: 95}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
