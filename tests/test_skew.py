"""Operators on skewed input: one product holds a third of all sales, one
revenue value repeats, one date holds a third of the orders.  Results are
checked against pandas on the same rows."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tillroll.operators import abc as A
from tillroll.operators import clean as C
from tillroll.operators import recommend as R
from tillroll.operators import sales as S


def _skewed(spark, n=6000, seed=3):
    rng = np.random.default_rng(seed)
    pid = np.where(rng.random(n) < 1 / 3, 1, rng.integers(2, 300, n))
    rev = np.round(rng.gamma(2.0, 50.0, n), 2)
    rev[rng.random(n) < 0.2] = 99.99
    qty = rng.integers(1, 20, n)
    day = np.where(rng.random(n) < 1 / 3, 0, rng.integers(0, 700, n))
    dates = [dt.date(2020, 1, 1) + dt.timedelta(days=int(d)) for d in day]
    pdf = pd.DataFrame({"sale_id": np.arange(n), "product_id": pid, "sale_date": dates, "quantity": qty,
                        "revenue": rev})
    sdf = spark.createDataFrame(
        [(int(r.sale_id), int(r.product_id), r.sale_date, int(r.quantity), Decimal(str(r.revenue)))
         for r in pdf.itertuples()],
        "sale_id long, product_id long, sale_date date, quantity int, revenue decimal(18,4)")
    prod = spark.createDataFrame([(i, f"Product_{i}", f"C{i % 4}", Decimal("10.5")) for i in range(1, 300)],
                                 "product_id long, product_name string, category string, cost decimal(14,4)")
    return pdf, sdf, prod


def test_top_products_and_abc_under_skew(spark):
    pdf, sdf, prod = _skewed(spark)
    top = S.top_products(sdf, prod, 5).collect()
    exp = pdf.groupby("product_id").revenue.sum().sort_values(ascending=False)
    assert top[0].product_id == 1
    assert [r.product_id for r in top] == list(exp.index[:5])
    items = A.abc_items(sdf, prod)
    got = {r.product_id: r for r in A.abc_classification(items).collect()}
    v = pdf.groupby("product_id").quantity.sum() * 10.5
    v = v.reset_index().sort_values(["quantity", "product_id"], ascending=[False, True])
    v["cum"] = v.quantity.cumsum() / v.quantity.sum() * 100
    for row in v.itertuples():
        assert abs(got[row.product_id].cumulative_percentage - row.cum) < 1e-9


def test_capping_under_skew(spark):
    pdf, sdf, _ = _skewed(spark)
    q1, q3 = np.quantile(pdf.revenue, [0.25, 0.75])
    hi = q3 + 1.5 * (q3 - q1)
    got = C.cap_outliers(sdf, "revenue").agg(F.max("revenue"), F.count("revenue")).collect()[0]
    assert abs(got[0] - min(pdf.revenue.max(), hi)) < 1e-9 and got[1] == len(pdf)


def test_recommender_hot_date(spark):
    pdf, sdf, _ = _skewed(spark)
    orders = sdf.select(F.col("sale_date").alias("order_date"), "product_id")
    m = {(r.product_a, r.product_b): r.cnt for r in R.cooccurrence_counts(orders, 10).collect()}
    counts = pdf.groupby("product_id").size().reset_index(name="c") \
        .sort_values(["c", "product_id"], ascending=[False, True])
    top = set(counts.product_id[:10])
    d = pdf[pdf.product_id.isin(top)][["sale_date", "product_id"]].drop_duplicates()
    exp = d.merge(d, on="sale_date").query("product_id_x < product_id_y") \
        .groupby(["product_id_x", "product_id_y"]).size()
    assert m == {k: v for k, v in exp.items()}
