"""The cleaning and detection queries act on rows that need them."""

import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tillroll.sources.tpch import Star


@pytest.fixture(scope="module")
def run(spark):
    import __spark_entry__ as E
    return lambda name: E.queries()[name](spark, SF_SMALL)


@pytest.mark.parametrize("name", ["detect_zscore", "detect_iqr", "anomaly_union", "anti_orphans"])
def test_detectors_find_rows(run, name):
    assert run(name).count() > 0


@pytest.mark.parametrize("name, table", [
    ("drop_duplicates", "raw_orders"), ("filter_positive_sales", "raw_sales"), ("clean_products", "raw_products"),
    ("clean_suppliers", "raw_suppliers"), ("clean_inventory", "raw_inventory"), ("clean_orders", "raw_orders"),
    ("clean_sales", "raw_sales"), ("anti_normal", "raw_sales")])
def test_rows_are_dropped(run, spark, name, table):
    assert 0 < run(name).count() < getattr(Star(spark, SF_SMALL), table).count()


def test_values_change(run, spark):
    star = Star(spark, SF_SMALL)
    capped = run("cap_outliers").agg(F.max("revenue")).first()[0]
    assert capped < float(star.raw_sales.agg(F.max("revenue")).first()[0])
    assert run("impute_median").where("cost is null").count() == 0 < star.raw_products.where("cost is null").count()
    assert run("clean_inventory").agg(F.min("stock_level")).first()[0] == 0
    assert run("long_lead_flag").where("long_lead_flag").count() > 0
    assert run("label_anomalies").where("label = 'anomaly'").count() > 0
    assert run("anomaly_rate").first().anomalies > 0 and run("profile_boxstats").first().outliers > 0
    assert run("profile_duplicates").first().duplicate_rows > 0
    assert {r.column_name for r in run("profile_nulls").where("nulls > 0").collect()} == {"product_id", "delivery_date"}
    counts = run("orphan_counts").first()
    assert counts.orphan_sales > 0 and counts.orphan_orders > 0
