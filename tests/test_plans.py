"""Physical-plan properties: pushdown, pruning, top-k, JVM-side execution."""

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _formatted(df) -> str:
    import io
    import contextlib
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_scan_pushdown_and_pruning(spark):
    import __spark_entry__ as E
    text = _formatted(E.queries()["scan_parquet"](spark, SF_SMALL).where("l_quantity >= 25"))
    assert "PushedFilters: [IsNotNull(l_quantity), GreaterThanOrEqual(l_quantity,25.0)]" in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_extendedprice:double>" in text


def test_top10_is_take_ordered(spark):
    import __spark_entry__ as E
    text = _formatted(E.queries()["top10_products"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in text
    # only the needed lineitem columns are read
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double,l_extendedprice:double,l_discount:double>" in text


def test_sql_library_has_no_python_udfs(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    for name in ("monthly_revenue", "category_performance", "inventory_alerts", "abc_sql", "clean_sales",
                 "recommend", "mom_ma3", "product_scorecard", "detect_iqr"):
        text = _formatted(qs[name](spark, SF_SMALL))
        for udf_node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas"):
            assert udf_node not in text, (name, udf_node)
        assert name in sql


def test_calendar_and_warehouse_are_broadcast(spark):
    import __spark_entry__ as E
    text = _formatted(E.queries()["monthly_revenue"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in text or "BroadcastExchange" in text


def test_partitioned_fact_prunes_periods(spark):
    import __spark_entry__ as E
    from pyspark.sql import functions as F
    back = E.queries()["sink_replace_table"](spark, SF_SMALL)
    q = back.where((F.col("year") == 1998) & (F.col("month") <= 3))
    text = _formatted(q)
    assert "PartitionFilters: [isnotnull(year" in text and "(year#" in text
    assert q.count() > 0


def test_calendar_queries_scan_the_fact_once(spark):
    """One scan, counting what a checkpoint read."""
    import __spark_entry__ as E
    seen = []
    frame = type(spark.range(1))
    plain = frame.checkpoint

    def checkpoint(self, eager=True):
        seen.append(_plan(self))
        return plain(self, eager)

    for name in ("mom_ma3", "monthly_revenue", "quarterly_revenue", "ytd_mtd_running", "self_join_prior_year", "dense_rank_products"):
        seen.clear()
        frame.checkpoint = checkpoint
        try:
            out = E.queries()[name](spark, SF_SMALL)
        finally:
            frame.checkpoint = plain
        plans = seen + [_plan(out)]
        assert sum(p.count("l_shipdate") > 0 and "FileScan" in p or "lineitem.parquet" in p for p in plans) == 1, name
        assert sum(line.count("lineitem.parquet") for p in plans for line in p.splitlines() if "FileScan" in line) == 1, name
