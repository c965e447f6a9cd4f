"""Inputs that once lost rows: late sales, appended files, NULL groups, extreme hashes."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.operators import sales as S
from tillroll.operators.anomaly import detect_zscore, label_anomalies, normal_rows
from tillroll.operators.classify import train_test_split
from tillroll.operators.clean import cap_outliers
from tillroll.operators.ordered import exact_quantiles, global_rank
from tillroll.operators.timeseries import resample_month
from tillroll.sources.tpch import Star, date_spine


def _sales(spark, rows):
    return spark.createDataFrame(rows, "sale_id long, product_id long, sale_date date, quantity int, revenue int").withColumn(
        "revenue", F.col("revenue").cast("decimal(18,4)"))


def test_appended_files_are_read(spark, tmp_path):
    path = str(tmp_path / "region.parquet")
    spark.range(10).withColumnRenamed("id", "r_regionkey").write.parquet(path)
    star = Star(spark, str(tmp_path))
    assert star.table("region").count() == 10
    spark.range(5).withColumnRenamed("id", "r_regionkey").write.mode("append").parquet(path)
    assert Star(spark, str(tmp_path)).table("region").count() == 15


def test_calendar_follows_the_sales(spark):
    s = _sales(spark, [(1, 1, dt.date(1999, 3, 5), 1, 10), (2, 1, dt.date(2005, 7, 9), 1, 20)])
    days = date_spine(s, "sale_date")
    assert days.count() == 2557 and days.agg(F.max("full_date")).first()[0] == dt.date(2005, 12, 31)
    months = S.monthly_revenue(s, days).collect()
    assert any(r["year"] == 2005 for r in months)
    assert date_spine(s.limit(0), "sale_date").count() == 0


def test_null_groups_keep_their_rows(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), (None, 5.0), (None, 500.0)], "k string, v double")
    assert global_rank(df, "v", partition_by=["k"]).count() == 4
    q = {r.k: r.m for r in exact_quantiles(df, "v", [0.5], by=["k"], names=["m"]).collect()}
    assert q == {"a": 2.0, None: 252.5}
    wide = spark.createDataFrame([(None, float(x)) for x in [1, 2, 3, 4, 1000]], "k string, v double")
    assert cap_outliers(wide, "v", by=["k"]).agg(F.max("v")).first()[0] == 7.0
    assert detect_zscore(df, "v", threshold=0.5, by=["k"]).count() == 4


def test_null_series_keep_their_revenue(spark):
    rows = [(None, dt.date(2024, 1, 5), 10.0), (None, dt.date(2024, 3, 5), 5.0), ("a", dt.date(2024, 2, 1), 7.0)]
    df = spark.createDataFrame(rows, "category string, sale_date date, revenue double")
    got = [(r.category, r.revenue) for r in resample_month(df, ["category"]).orderBy("category", "month_end").collect()]
    assert got == [(None, 10.0), (None, 0.0), (None, 5.0), ("a", 7.0)]


def test_labels_reach_every_row_of_a_key(spark):
    rows = [(k, 1, dt.date(2024, 1, 1), 1, 10) for k in range(40)] + [
        (5, 1, dt.date(2024, 1, 2), 1, 9999), (None, 1, dt.date(2024, 1, 2), 1, 10)]
    df = _sales(spark, rows)
    labels = label_anomalies(df).where("label = 'anomaly'").collect()
    assert len(labels) == 2 and {r.sale_id for r in labels} == {5}
    assert normal_rows(df).count() == 40


def test_split_takes_any_hash(spark):
    df = spark.range(2000).withColumnRenamed("id", "product_id")
    parts = {r["split"]: r["count"] for r in train_test_split(df, "product_id").groupBy("split").count().collect()}
    assert sum(parts.values()) == 2000 and 300 < parts["test"] < 500
