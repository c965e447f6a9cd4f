"""Mergeable distinct counts against count(distinct), and the slicer table."""

from pyspark.sql import functions as F

from tillroll.operators import distinct as D


def _rows(spark):
    ids = [None, 0, -1, -32768, -32769, 1, 32768, 32769, 2 ** 40, 2 ** 40 + 1, 7, 7, 7]
    rows = [(i, ["a", None, "b"][k % 3], k % 4) for k, i in enumerate(ids * 3)]
    return spark.createDataFrame(rows + [(5, "hot", 1)] * 500, "id long, g string, m int").repartition(6)


def test_states_add_up_over_any_slice(spark):
    df = _rows(spark)
    states = D.distinct_states(df, "id", ["g", "m"])
    for by in ([], ["g"], ["m"], ["g", "m"]):
        got = sorted(map(str, D.distinct_count(states, "n", by).collect()))
        want = df.groupBy(*by).agg(F.count_distinct("id").alias("n"))
        assert got == sorted(map(str, want.where("n > 0" if by else "true").collect()))
    sets = [(), ("g",), ("m", "g")]
    got = {(r._set, r.g, r.m): r.n for r in D.distinct_grouping_sets(states, "n", sets).collect()}
    for i, s in enumerate(sets):
        for r in df.groupBy(*s).agg(F.count_distinct("id").alias("n")).where("n > 0").collect():
            assert got.pop((i, r.g if "g" in s else None, r.m if "m" in s else None)) == r.n
    assert not got


def test_no_id_is_shuffled(spark):
    df = spark.range(100_000, numPartitions=4).withColumnRenamed("id", "sale_id")
    out = D.distinct_count(D.distinct_states(df, "sale_id"), "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "sale_id" not in line
    assert "partial_bitmap_construct_agg" in plan and out.first().n == 100_000
    assert D.distinct_count(D.distinct_states(df.limit(0), "sale_id"), "n").first().n == 0


def test_slicer_table_equals_filtered_measures(spark):
    import __spark_entry__ as E
    from conftest import SF_SMALL
    from tillroll.operators import measures as M
    from tillroll.plans.slicers import SlicedStar
    rows = E.queries()["slicer_table"](spark, SF_SMALL).collect()
    assert len({(r.category_sliced, r.warehouse_sliced, r.category, r.warehouse_name) for r in rows}) == len(rows)
    for r in [x for x in rows if not x.category_sliced or x.category == "PROMO"][:6]:
        st = SlicedStar(spark, SF_SMALL, category=r.category if r.category_sliced else None,
                        warehouse=r.warehouse_name if r.warehouse_sliced else None)
        assert M.total_skus(st.fact_inventory).first()[0] == r.total_skus
        assert M.reorder_alerts(st.fact_inventory).first().reorder_alert_count == r.reorder_alert_count
        assert abs(M.gross_profit(st.fact_sales, st.dim_product).first()[0] - r.gross_profit) < 1e-6 * abs(r.gross_profit)


def test_one_state_a_bucket_wherever_its_ids_lie(spark):
    """Each slice has one state a bucket when it is built, and groupings make no copies of the states."""
    df = spark.range(200_000, numPartitions=8).select("id", (F.col("id") % 3).alias("m"), (F.col("id") % 5).cast("string").alias("g"))
    states = D.distinct_states(df.repartition(8, F.hash("id")), "id", ["m", "g"])
    plan = states._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") - plan.count("ReusedExchange") == 2       # the test's own, and the one by bucket
    assert "Exchange hashpartitioning(_bucket" in plan
    out = D.distinct_grouping_sets(states, "n", [(), ("m",), ("g",)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "Expand" not in plan
    got = {(r._set, r.m, r.g): r.n for r in out.collect()}
    assert got[0, None, None] == 200_000 and got[1, 2, None] == 66_666 and got[2, None, "4"] == 40_000 and len(got) == 9
    assert D.distinct_grouping_sets(D.distinct_states(df.limit(0), "id", ["m", "g"]), "n", [(), ("m",)]).isEmpty()
