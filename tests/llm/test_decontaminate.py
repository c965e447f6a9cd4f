import random

import pytest

from tillroll.llm import decontaminate as D
from tillroll.llm.queries import op10_decontaminate

from .conftest import SF


@pytest.fixture(scope="module")
def items(spark):
    return [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]


def distance(a, b):
    """Plain edit distance between ``a`` and the closest stretch of ``b``."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return min(row)


def test_every_stretch_within_the_budget_is_found(items, docs):
    rng, searcher = random.Random(5), D.Searcher(items)
    hosts = [r.text[:3000] for r in docs.limit(20).collect()]
    for _ in range(60):
        item, text = rng.choice(items)
        window, t = text[:D.WINDOW], list(text[:D.WINDOW])
        for _ in range(rng.randint(0, D.edits_allowed(len(window)))):
            p, o = rng.randrange(len(t)), rng.random()
            if o < .4:
                t[p] = rng.choice("abcxyz")
            elif o < .7:
                t.insert(p, rng.choice("abcxyz"))
            elif len(t) > 1:
                del t[p]
        host = rng.choice(hosts)
        p = rng.randrange(len(host) + 1)
        doc = host[:p] + "".join(t) + host[p:]
        found = [x for x in searcher.search([doc])[0] if x["item_id"] == item]
        assert any(x["start"] <= p + len(t) and x["end"] >= p for x in found)
        for x in found:
            assert x["edits"] <= D.edits_allowed(len(window))


def test_alignment_matches_plain_edit_distance():
    rng = random.Random(2)
    for _ in range(40):
        w = "".join(rng.choice("ab ") for _ in range(20))
        b = "".join(rng.choice("ab ") for _ in range(30))
        table = D._fold_table()
        edits, start, end = D.align(D.codes(w, table)[None], D.codes(b, table), D.np.array([-20]), 51)
        assert edits[0] == distance(w, b)
        assert distance(w, b[max(0, start[0]):end[0]]) == edits[0]


def test_query_finds_exact_copies_and_leaves_the_rest(spark, docs, items):
    rows = {r.doc_id: r.text for r in docs.collect()}
    exact = {(d, i) for d, t in rows.items() for i, x in items if x in t}
    found = op10_decontaminate(spark, SF).collect()
    assert exact <= {(r.doc_id, r.item_id) for r in found} and exact
    by = dict(items)
    for r in found:
        piece = rows[r.doc_id][r.start:r.end]
        assert distance(by[r.item_id][:D.WINDOW], piece) <= 10 or distance(piece[:90], by[r.item_id]) <= 19


def test_odd_rows(saved, spark):
    bench = saved([(1, "The quick brown fox jumps over the lazy dog near the river bank today"), (2, None), (3, ""),
                   (4, "tiny"), (None, "no id here at all, so never searched")], "item_id long, text string")
    docs = [(1, "x" * (D.CHUNK_CHARS - 30) + " the quick  brown fox jumps OVER the lazy dog near the river bank today yes"),
            (2, None), (3, ""), (4, "a tiny thing"), (None, "tiny"), (4, "a tiny thing"),
            (5, "nothing of the kind, no id here at all, so never searched")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("leaks", D.F.lit(1)).withColumn(
        "row", D.F.lit(2))
    found = D.find_leaks(df, bench).collect()
    assert sorted((str(r.doc_id), r.item_id) for r in found) == [("1", 1), ("4", 4), ("4", 4), ("None", 4)]
    one = next(r for r in found if r.doc_id == 1)
    assert docs[0][1][one.start:one.end].strip().lower().startswith("the quick  brown")
    kept = D.drop_leaked(df, bench)
    assert kept.columns == df.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3, 5]


def test_blocks_and_empty_tables(saved, spark, items, monkeypatch):
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(k, f"before {t} after") for k, t in items[:10]], "doc_id long, text string")
    whole = sorted(map(tuple, D.find_leaks(df, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 2000)
    assert sorted(map(tuple, D.find_leaks(df, bench).collect())) == whole
    assert D.find_leaks(df.limit(0), bench).count() == 0
    assert D.drop_leaked(df, bench.limit(0)).count() == 10


def test_a_text_that_begins_mid_window_keeps_its_leak(items):
    item, text = next((k, t) for k, t in items if len(t) >= 150)
    searcher, clean = D.Searcher([(item, text)]), "0123456789 " * 20
    for cut in range(1, 11):
        docs = [text[cut:], clean, text[cut:] + " " + clean, clean, clean + text, clean, text[cut:]]
        found = searcher.search(docs)
        assert [bool(x) for x in found] == [k % 2 == 0 for k in range(7)]
        for doc, leaks in zip(docs, found, strict=True):
            assert all(0 <= x["start"] < x["end"] <= len(doc) for x in leaks)
        assert [found[k][0]["start"] for k in (0, 2, 6)] == [0, 0, 0]


def test_a_border_inside_a_passage_changes_nothing(items, monkeypatch):
    item, text = next((k, t) for k, t in items if len(t) >= 150)
    searcher = D.Searcher([(item, text)])
    monkeypatch.setattr(D, "CHUNK_CHARS", 1000)
    for cut in range(0, len(text) + 1, 3):
        doc = "." * (1000 - cut) + text + "." * 1500
        assert [(x["start"], x["end"], x["edits"]) for x in searcher.search([doc, "." * 99])[0]] == [
            (1000 - cut, 1000 - cut + len(text), 0)]


def test_verbatim_runs_are_found_at_every_offset(items):
    texts = sorted(items, key=lambda x: len(x[1]))
    for item, text in (texts[0], texts[len(texts) // 2], texts[-1]):
        searcher = D.Searcher(items)
        for size in (59, 60, 77, 88, 100):
            docs = ["0123456789 " * 3 + text[at:at + size] + " 0123456789" * 3 for at in range(len(text) - size + 1)]
            for doc, found in zip(docs, searcher.search(docs), strict=True):
                mine = [x for x in found if x["item_id"] == item]
                assert mine and all(x["start"] < 33 + size and x["end"] > 33 for x in mine)


def test_runs_of_any_length_match_brute_force(items):
    item, text = min(items, key=lambda x: len(x[1]))
    text, rng = text.lower().replace("\n", " "), random.Random(7)
    docs = [text[at:at + size] for size in range(40, 60, 3) for at in rng.sample(range(len(text) - size + 1), 5)]
    want = [any(distance(text[i:j], "#" * 12 + d + "#" * 12) <= D.edits_allowed(j - i) for i, j in D.cuts(len(text)))
            for d in docs]
    assert [bool(x) for x in D.Searcher([(item, text)]).search(docs)] == want and set(want) == {True, False}


def test_windows_hold_every_former_window():
    for n in (8, 49, 50, 51, 99, 100, 101, 149, 150, 151, 394):
        former = {(at, min(at + 100, n)) for at in [*range(0, max(1, n - 100), 50), max(0, n - 100)]}
        assert former <= set(D.cuts(n))


def test_very_short_items_match_as_whole_words_or_texts():
    searcher = D.Searcher([(1, "a"), (2, "tiny"), (3, "--")])
    docs = ["banana bread", "tinytown", "such a day", "Tiny!", "a", "x -- y", "--", "dátiny", "(tiny)", "tiny tinya"]
    assert [sorted({x["item_id"] for x in f}) for f in searcher.search(docs)] == [
        [], [], [1], [2], [1], [], [3], [], [2], [2]]


def test_a_block_is_a_pass_of_its_own(saved, spark, items, monkeypatch):
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(k % 3 or None, f"before {t} after" if k % 2 else "clean text", k) for k, t in items]
    df = saved([*rows, *rows, (7, None, 0)], "doc_id long, text string, gone_text long")
    one = sorted(map(repr, D.drop_leaked(df, bench).collect()))
    monkeypatch.setattr(D, "BLOCK_CHARS", 2000)
    kept = D.drop_leaked(df, bench)
    assert kept.columns == df.columns and sorted(map(repr, kept.collect())) == one and one
    plan = D.find_leaks(df, bench)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == len(D.leak_finders(bench)) > 1


def test_a_block_bounds_memory():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(D.BLOCK_CHARS // 20 // 7)]
    searcher = D.Searcher([(k, " ".join(rng.choices(words, k=40))) for k in range(D.BLOCK_CHARS // 20 // 280)])
    held = sum(x.nbytes for x in vars(searcher).values() if isinstance(x, D.np.ndarray))
    held += sum(x.nbytes for x in searcher.letters.values()) - searcher.slots.nbytes
    assert held * 20 < 250e6


def test_repetitive_texts_and_items_match_plain_distances():
    """Rulers, tables and stutters in items and texts: found exactly where a window is within its edits."""
    rng = random.Random(9)
    def piece():
        kind = rng.randrange(5)
        if kind == 4:
            return "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(5, 60)))
        return ["-", "=-", "ab ", "#"][kind] * rng.randint(3, 60)

    for _ in range(12):
        items = [(k, "".join(piece() for _ in range(rng.randint(1, 3)))[:120].ljust(10, "x")) for k in range(4)]
        searcher = D.Searcher(items)
        for _ in range(4):
            base = list((piece() + rng.choice(items)[1] + piece())[:160])
            for _ in range(rng.randint(0, 9)):
                base[rng.randrange(len(base))] = rng.choice("-=ab#z ")
            doc = "".join(base)
            found = {x["item_id"] for x in searcher.search([doc])[0]}
            for k, text in items:
                near = any(distance(text[a:b], doc) <= D.edits_allowed(b - a) for a, b in D.cuts(len(text)))
                assert (k in found) == near, (text, doc)


def test_long_runs_stay_within_memory_and_time():
    import time
    import tracemalloc
    searcher = D.Searcher([(1, "-" * 400), (2, "=-" * 200), (3, "-" * 60 + "some words between the rulers of a table" + "-" * 60)])
    tracemalloc.start()
    began = time.perf_counter()
    for piece in ("-", "=-"):
        found = searcher.search([piece * (240_000 // len(piece))])[0]
        whole = [x for x in found if x["item_id"] == len(piece)]
        assert [(x["start"], x["end"]) for x in whole] == [(0, 240_000)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 400 << 20 and time.perf_counter() - began < 120, (peak, time.perf_counter() - began)
