"""Edge cases of measures, time series, ABC and the recommender."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import abc as A
from tillroll.operators import measures as M
from tillroll.operators import recommend as R
from tillroll.operators import timeseries as T


def _sales(spark, rows):
    return spark.createDataFrame(
        [(i, p, d, q, Decimal(str(r))) for i, (p, d, q, r) in enumerate(rows)],
        "sale_id long, product_id long, sale_date date, quantity int, revenue decimal(18,4)")


def test_top1_blank_on_tie(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 1.0)], "category string, rev double")
    assert M.top1(df, "category", "rev", "top").collect()[0].top is None
    df2 = spark.createDataFrame([("a", 6.0), ("b", 5.0)], "category string, rev double")
    assert M.top1(df2, "category", "rev", "top").collect()[0].top == "a"


def test_resample_fills_gaps_and_rolling_mean(spark):
    D = dt.date
    s = _sales(spark, [(1, D(2024, 1, 5), 1, 10), (1, D(2024, 3, 5), 1, 30), (1, D(2024, 4, 1), 1, 20)])
    r = T.rolling_mean(T.resample_month(s), 3).orderBy("month_end").collect()
    assert [x.month_end for x in r] == [D(2024, 1, 31), D(2024, 2, 29), D(2024, 3, 31), D(2024, 4, 30)]
    assert [x.revenue for x in r] == [10.0, 0.0, 30.0, 20.0]           # empty month -> 0
    assert [x.ma3 for x in r] == [None, None, 40 / 3, 50 / 3]           # NULL until 3 values
    grouped = {x.month for x in T.monthly_totals(s).collect()}
    assert D(2024, 2, 1) not in grouped                                   # absent when not resampled


def test_ma_forecast_length(spark):
    D = dt.date
    s = _sales(spark, [(1, D(2024, m, 1), 1, 10 * m) for m in range(1, 7)])
    f = T.ma_forecast(s, 3, 6, band=True).orderBy("step").collect()
    assert len(f) == 6 and f[0].month_end == D(2024, 7, 31) and f[-1].month_end == D(2024, 12, 31)
    assert all(abs(x.forecast_ma - 50.0) < 1e-9 for x in f)
    assert abs(f[0].lower - 45.0) < 1e-9 and abs(f[0].upper - 55.0) < 1e-9


def test_abc_monotone_and_null_class(spark):
    items = spark.createDataFrame([(i, 100 - i, 1.0) for i in range(20)] + [(99, None, 1.0)],
                                  "product_id long, annual_demand long, unit_cost double")
    rows = A.abc_classification(items).orderBy(F.col("annual_value").desc_nulls_last(), "product_id").collect()
    order = {"A": 0, "B": 1, "C": 2}
    classes = [order[r.abc_class] for r in rows]
    assert classes == sorted(classes)
    assert rows[-1].product_id == 99 and rows[-1].abc_class == "C"


def test_recommender(spark):
    D = dt.date
    rows = [(D(2024, 1, 1), 1), (D(2024, 1, 1), 2), (D(2024, 1, 1), 3), (D(2024, 1, 2), 1), (D(2024, 1, 2), 2),
            (D(2024, 1, 3), 4), (D(2024, 1, 3), 4), (D(2024, 1, 4), 5)]
    o = spark.createDataFrame(rows, "order_date date, product_id long")
    m = {(r.product_a, r.product_b): r.cnt for r in R.similarity_matrix(o, 4).collect()}
    assert m[(1, 2)] == 2 and m[(2, 1)] == 2 and m[(1, 3)] == 1       # symmetric counts
    rec = R.recommend(o, 1, n=4, k=3).orderBy("rank").collect()
    assert [r.partner_id for r in rec] == [2, 3, 4] and [r.score for r in rec] == [2, 1, 0]   # zero fill
    assert R.recommend(o, 5, n=4, k=3).count() == 0                    # outside the top-n: empty


def test_pandas_null_key_and_empty_sum_rules(spark):
    from tillroll.operators import inventory as I
    inv = spark.createDataFrame([(1, "A", 5, 3), (2, None, 7, 3), (3, "B", None, 3)],
                                "product_id long, warehouse string, stock_level int, reorder_level int")
    got = {r.warehouse: r.stock_level for r in I.warehouse_stock(inv).collect()}
    assert got == {"A": 5, "B": 0}                    # NULL key dropped, all-missing sum is 0
    o = spark.createDataFrame([(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 1), None)],
                              "order_date date, product_id long")
    assert [(r.product_id, r["count"]) for r in R.value_counts(o).collect()] == [(1, 1)]


def test_star_load_null_safe_warehouse(spark):
    from tillroll.operators import inventory as I
    inv = spark.createDataFrame([(1, "Pune", 5, 3), (2, None, 7, 3), (3, "Agra", 1, 3)],
                                "product_id long, warehouse string, stock_level int, reorder_level int")
    w = {r.warehouse_name: r.warehouse_id for r in I.distinct_warehouses(inv).collect()}
    assert w == {"Agra": 1, "Pune": 2, None: 3}
    j = inv.join(I.distinct_warehouses(inv), inv.warehouse.eqNullSafe(F.col("warehouse_name")))
    assert sorted((r.product_id, r.warehouse_id) for r in j.collect()) == [(1, 2), (2, 3), (3, 1)]


def test_slicers_match_grouped_measures(spark):
    from conftest import SF_SMALL
    from tillroll.sources.tpch import Star
    st = Star(spark, SF_SMALL)
    cat = st.dim_product.select("category").orderBy("category").first()[0]
    from tillroll.operators import scorecard as SC
    grouped = {r.category: r for r in SC.sliced_measures(st.fact_sales, st.dim_product, ["category"]).collect()}
    tot = M.total_revenue(st.fact_sales, product=st.dim_product, category=cat).collect()[0][0]
    gm = M.gross_margin_pct(st.fact_sales, st.dim_product, category=cat).collect()[0][0]
    assert abs(tot - grouped[cat].total_revenue) < 1e-6
    assert abs(gm - grouped[cat].gross_margin_pct) < 1e-9
    # warehouse slicer filters inventory; alerts of one warehouse = its overview row
    w1 = M.reorder_alerts(st.fact_inventory, warehouse_id=1).collect()[0]
    exp = st.fact_inventory.where("warehouse_id = 1 and stock_level <= reorder_level").count()
    assert w1.reorder_alert_count == exp


def test_rfm_five_clusters_fifth_label_null(spark):
    from conftest import SF_SMALL
    from tillroll.operators import segment as SG
    from tillroll.sources.tpch import Star
    st = Star(spark, SF_SMALL)
    seg = SG.rfm_segment(st.fact_sales, st.dim_product, k=5)
    labels = {r.segment: r.segment_label for r in seg.select("segment", "segment_label").distinct().collect()}
    assert len(labels) == 5
    assert sorted(v for v in labels.values() if v) == sorted(SG.SEGMENT_LABELS)
    assert sum(v is None for v in labels.values()) == 1
    means = {r.segment_label: r.monetary for r in SG.rfm_segment_means(seg).collect() if r.segment_label}
    order = [means[lbl] for lbl in SG.SEGMENT_LABELS]
    assert order == sorted(order, reverse=True)          # labels follow mean monetary value
