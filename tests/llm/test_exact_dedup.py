import hashlib

from tillroll.llm import exact_dedup as X
from tillroll.llm.queries import op8_exact_dedup

from .conftest import SF

ROWS = [(1, "Hello É", "a"), (2, "hello É", "b"), (3, "hello é", "c"), (4, None, "d"), (5, "", "e"),
        (None, "hELLO É", "f"), (6, "only", "g"), (7, "twice", "h"), (7, "twice", "i"), (None, "nobody", "j"),
        (8, "x" * 300_000, "k"), (9, "X" * 300_000, "l")]
SCHEMA = "doc_id long, text string, sha string"


def digest(t):
    return hashlib.sha256("".join(c.lower() if c.isascii() else c for c in t or "").encode()).hexdigest()


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(digest(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[digest(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, digest(t)))
    return sorted(map(repr, out))


def test_groups_match_brute_force_on_odd_rows(saved):
    got = X.duplicate_groups(saved(ROWS, SCHEMA)).collect()
    assert sorted(repr(tuple(r)) for r in got) == brute([r[:2] for r in ROWS])


def test_query_matches_sql(spark, same):
    same(op8_exact_dedup(spark, SF), X.SQL)


def test_full_filter_only_costs_time(saved):
    df = saved([(i, f"text {i % 700}", "") for i in range(2000)], SCHEMA)
    small = X.duplicate_groups(df, max_bits=X.BLOCK_BITS)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, X.duplicate_groups(df).collect()))


def test_filter_lets_unique_rows_pass(saved):
    df = saved([(i, f"text {i}", "") for i in range(2000)] + [(9000 + i, "copy", "") for i in range(500)], SCHEMA)
    hashes = X.cut(df.select(X.F.sha2(X.normalise(df.text), 256).alias("sha")))
    blocks = X.filter_blocks(hashes.count())
    marked = X.probe(hashes, X.repeated_filter(hashes, blocks), blocks)
    assert 500 <= marked.filter("possible").count() < 600


def test_drop_keeps_one_row_and_all_columns(saved):
    df = saved(ROWS, SCHEMA).withColumnRenamed("sha", "row")
    kept = X.drop_duplicates(df)
    assert kept.columns == df.columns
    rows = kept.collect()
    assert len(rows) == len({digest(r[1]) for r in ROWS})
    assert {r.doc_id for r in rows} == {2, 3, 5, 6, 7, None, 9}


def test_empty_table(saved, spark):
    df = spark.createDataFrame([], SCHEMA)
    assert X.duplicate_groups(df).count() == 0 and X.drop_duplicates(df).count() == 0


def test_plan_is_native(saved):
    plan = X.drop_duplicates(saved(ROWS, SCHEMA))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
