"""Distributed order primitives against pandas / numpy on skewed data."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillroll.operators.ordered import exact_quantiles, global_rank, prefix_sum, quantile_table


def _data(spark, n=3000, seed=7):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < 0.34, "hot", rng.choice(["a", "b", "c"], n))   # a third in one group
    v = np.round(rng.exponential(100, n), 1)
    v[rng.random(n) < 0.3] = 5.0                                                 # a hot value
    pdf = pd.DataFrame({"id": np.arange(n), "g": g, "v": v})
    return pdf, spark.createDataFrame(pdf)


def test_prefix_sum_matches_cumsum(spark):
    pdf, df = _data(spark)
    got = prefix_sum(df, [F.col("v").desc(), F.col("id").asc()], ["v"]).toPandas()
    exp = pdf.sort_values(["v", "id"], ascending=[False, True]).assign(v_cum=lambda d: d.v.cumsum())
    m = got.merge(exp[["id", "v_cum"]], on="id", suffixes=("", "_exp"))
    assert len(m) == len(pdf)
    assert np.allclose(m.v_cum, m.v_cum_exp)


def test_prefix_sum_grouped(spark):
    pdf, df = _data(spark)
    got = prefix_sum(df, [F.col("id").asc()], ["v"], partition_by=["g"]).toPandas()
    exp = pdf.sort_values("id").assign(v_cum=lambda d: d.groupby("g").v.cumsum())
    m = got.merge(exp[["id", "v_cum"]], on="id", suffixes=("", "_exp"))
    assert np.allclose(m.v_cum, m.v_cum_exp)


def test_global_rank(spark):
    pdf, df = _data(spark)
    got = global_rank(df, "v", "r", "rank").toPandas().set_index("id").sort_index()
    dense = global_rank(df, "v", "r", "dense").toPandas().set_index("id").sort_index()
    assert (got.r.values == pdf.v.rank(method="min", ascending=False).astype(int).values).all()
    assert (dense.r.values == pdf.v.rank(method="dense", ascending=False).astype(int).values).all()


def test_exact_quantiles(spark):
    pdf, df = _data(spark)
    probs = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    q = exact_quantiles(df, "v", probs).collect()[0]
    assert np.allclose(list(q), np.quantile(pdf.v, probs))
    qg = {r.g: r for r in exact_quantiles(df, "v", [0.25, 0.75], by=["g"]).collect()}
    for g, part in pdf.groupby("g"):
        assert np.allclose([qg[g].q25, qg[g].q75], np.quantile(part.v, [0.25, 0.75]))


def test_quantile_table_several_columns(spark):
    pdf, df = _data(spark)
    df2 = df.withColumn("w", F.col("v") * 2 + F.col("id") % 7)
    pdf["w"] = pdf.v * 2 + pdf.id % 7
    row = quantile_table(df2, ["v", "w"], [0.25, 0.75], ["q1", "q3"]).collect()[0]
    assert np.allclose([row.v__q1, row.v__q3], np.quantile(pdf.v, [0.25, 0.75]))
    assert np.allclose([row.w__q1, row.w__q3], np.quantile(pdf.w, [0.25, 0.75]))


def test_large_groups_are_bracketed_exactly(spark):
    """More rows than the sketch resolves, ties, a hot value and infinities."""
    import numpy as np
    from tillroll.operators.ordered import exact_quantiles
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=30_000), np.full(15_000, 0.25), rng.exponential(1e6, 5_000)])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    got = exact_quantiles(df, "v", probs, names=[f"q{i}" for i in range(len(probs))]).first()
    assert np.allclose(list(got), np.quantile(x, probs), rtol=1e-12)


def _hard(spark, n=60_000):
    rng = np.random.default_rng(11)
    x = np.concatenate([rng.normal(size=n // 2), np.full(n // 4, 0.25), rng.exponential(1e6, n // 8), -rng.exponential(1e-6, n // 8)])
    return x, spark.createDataFrame(pd.DataFrame({"g": np.where(np.arange(n) % 3 == 0, "a", None), "v": x})).repartition(6)


def test_narrowing_leaves_few_values(spark):
    """However many rows: what the window sees is bounded by ``left`` a position."""
    from tillroll.operators import ordered as O
    x, df = _hard(spark)
    base, probs = df.select(F.col("v").alias("__x")), [0.01, 0.25, 0.5, 0.75, 0.999]
    sizes = {}
    for left in (100_000, 200, 20):                    # the sketch alone leaves thousands
        brackets = O._selected(base, [], probs, False, left)
        sizes[left] = O._counted(base, brackets, [], len(probs), False).count()
        assert sizes[left] <= len(probs) * (left + 3) + 1
        row = brackets.first()
        assert all(row[f"__most{i}"] <= left for i in range(len(probs)))
    assert sizes[20] <= sizes[200] <= sizes[100_000]
    got = exact_quantiles(df, "v", probs, names=list("abcde"), left=20).first()
    assert np.allclose(list(got), np.quantile(x, probs), rtol=1e-12)


def test_narrowing_by_group(spark):
    x, df = _hard(spark)
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: list(r)[1:] for r in exact_quantiles(df, "v", probs, by=["g"], names=list("abcde"), left=30).collect()}
    for g, mine in (("a", x[::3]), (None, np.delete(x, np.arange(0, len(x), 3)))):
        assert np.allclose(got[g], np.quantile(mine, probs), rtol=1e-12)


def test_lost_position_is_an_error(spark, monkeypatch):
    import pytest
    from tillroll.operators import ordered as O
    _, df = _hard(spark)
    monkeypatch.setattr(O, "_selected", lambda base, by, probs, bounded, left: O._brackets(base, by, probs).withColumn(
        "__lo0", F.lit(99.0)).withColumn("__hi0", F.lit(99.5)))
    with pytest.raises(Exception, match="outside its bracket|position"):
        exact_quantiles(df, "v", [0.5]).collect()


def test_ranks_of_ties_nulls_and_groups(spark):
    rng = np.random.default_rng(2)
    n = 4000
    pdf = pd.DataFrame({"id": np.arange(n), "k": rng.choice(["x", "y", None], n), "v": rng.integers(0, 900, n).astype(float)})
    pdf.loc[pdf.index % 3 == 0, "v"] = 7.0             # a third of the rows tie
    pdf.loc[pdf.index % 50 == 0, "v"] = None
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "id long, k string, v double").repartition(5)
    df.createOrReplaceTempView("ranked_rows")
    for way, desc in (("desc nulls last", True), ("asc nulls last", False)):
        want = {r.id: r for r in spark.sql(f"""select id, rank() over (order by v {way}) a, dense_rank() over (order by v {way}) b,
            rank() over (partition by k order by v {way}) c, dense_rank() over (partition by k order by v {way}) d from ranked_rows""").collect()}
        for col, method, by in (("a", "rank", []), ("b", "dense", []), ("c", "rank", ["k"]), ("d", "dense", ["k"])):
            got = global_rank(df, "v", "r", method, desc, by)
            assert got.columns == ["id", "k", "v", "r"]
            assert {r.id: r.r for r in got.collect()} == {i: w[col] for i, w in want.items()}
    assert global_rank(df.limit(0), "v").count() == 0


def test_rank_scans_once_and_keeps_ties_out_of_the_sort(spark, tmp_path):
    df = spark.range(20_000).selectExpr("id", "if(id % 3 = 0, 5, id) v")
    path = str(tmp_path / "rows")
    df.write.parquet(path)
    out = global_rank(spark.read.parquet(path), "v", "r", "dense")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "SortMergeJoin" not in plan    # the checkpoint is read, nothing joins on the value


def test_ranks_of_text(spark):
    words = [f"w{i * 7919 % 500}" for i in range(1500)] + [None, "", "é"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    order = {w: i + 1 for i, w in enumerate(sorted({w for w in words if w is not None}, key=lambda w: w.encode()))}
    got = {r.w: r.r for r in global_rank(df, "w", "r", "dense", descending=False).collect()}
    assert got == order | {None: len(order) + 1}


def test_few_large_groups_stay_dealt_over_all_tasks(spark):
    """No pass joins or sorts the rows by a group that a few large ones make up."""
    from tillroll.operators import profile as P
    df = spark.range(40_000, numPartitions=4).select((F.col("id") % 7).alias("a"), (F.col("id") * 3).alias("b"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = P.describe(df, ["a", "b"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        rows = {r.column_name: (r["count"], r.p25, r.p50, r.p75) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert rows == {"a": (40_000, 1.0, 3.0, 5.0), "b": (40_000, 29999.25, 59998.5, 89997.75)}
    # the one shuffle join is that of the finished rows, one a column
    assert plan.count("SortMergeJoin") == 1 and plan.count("BroadcastHashJoin") == 1
