"""Hand-written dirty rows (FIXTURES.md section D) through the cleaning steps."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tillroll.operators import clean as C


def _raw_products(spark):
    rows = [("1", "A", "hi-fi o'neil", "10", "20"),
            ("2", "B", "tools", "n/a", "30"),          # bad number -> NULL -> median
            ("3", "C", "tools", "", "0"),               # empty cost; price 0 -> margin_pct NULL
            ("4", "D", "tools", "30", "40"),
            ("4", "D", "tools", "30", "40"),            # duplicate row
            ("5", "E", "tools", "10000", "50")]         # cost outlier -> capped
    schema = StructType([StructField(n, StringType()) for n in
                         (" Product-ID ", "Product_Name", "Category", "Cost", "Price")])
    return spark.createDataFrame(rows, schema)


def test_clean_products(spark):
    out = {r.product_id: r for r in C.clean_products(_raw_products(spark)).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5]
    assert out[1].category == "Hi-Fi O'Neil"
    # cost median of 10, 30, 10000 is 30 (the duplicate was removed first)
    assert out[2].margin == 30 - 30 and out[3].margin_pct is None
    costs = [r.cost for r in out.values()]
    assert max(costs) < 10000            # capped at the upper IQR fence
    assert out[5].margin == 50 - 10000   # margin is computed before capping


def test_bad_id_raises(spark):
    df = spark.createDataFrame([("x7", "A", "t", "1", "2")], "Product_ID string, Product_Name string, "
                                                            "Category string, Cost string, Price string")
    with pytest.raises(Exception):
        C.clean_products(df).collect()


def test_clean_orders(spark):
    rows = [("1", "1", "2024-01-01", "2024-01-05", "3"),
            ("2", "1", "2024-02-30", "2024-03-01", "3"),    # bad date -> dropped
            ("3", "1", "2024-01-10", None, "3"),            # null delivery -> dropped
            ("4", "1", "2024-01-10", "2024-01-02", "3"),    # reversed -> dropped
            ("5", "2", "2024-01-10", "2024-01-10", None),   # null quantity stays null
            ("6", "2", "2024-01-10", "2024-01-12", "10000"),
            ("7", "2", "2024-01-11", "2024-01-12", "3"), ("8", "2", "2024-01-11", "2024-01-12", "4"),
            ("9", "2", "2024-01-11", "2024-01-12", "5"), ("10", "2", "2024-01-11", "2024-01-12", "2")]
    df = spark.createDataFrame(rows, "Order_ID string, Product_ID string, Order_Date string, "
                                     "Delivery_Date string, Quantity string")
    out = {r.order_id: r for r in C.clean_orders(df).collect()}
    assert sorted(out) == [1, 5, 6, 7, 8, 9, 10]
    assert out[1].fulfilment_days == 4 and out[1].order_date == dt.date(2024, 1, 1)
    assert out[5].quantity is None
    # quantities 2,3,3,4,5,10000: q1 = 3, q3 = 4.75, upper fence 7.375
    assert out[6].quantity == 7.375


def test_clean_inventory(spark):
    rows = [("1", "Delhi", "-5", "10"), ("2", "Delhi", None, "10"), ("3", "Pune", "50", "10")]
    df = spark.createDataFrame(rows, "Product_ID string, Warehouse string, Stock_Level string, Reorder_Level string")
    out = {r.product_id: r for r in C.clean_inventory(df).collect()}
    assert out[1].stock_level == 0 and out[1].needs_reorder is True
    assert out[2].stock_level is None and out[2].needs_reorder is False
    assert out[3].needs_reorder is False


def test_clean_sales_and_orphans(spark):
    rows = [("1", "1", "2024-01-01", "2", "100"), ("2", "1", "2024-01-02", "0", "100"),
            ("3", "9", "2024-01-03", "1", "0"), ("4", "9", "2024-01-04", "1", "50"),
            ("5", None, "2024-01-04", "1", "50")]
    df = spark.createDataFrame(rows, "Sale_ID string, Product_ID string, Sale_Date string, "
                                     "Quantity string, Revenue string")
    s = C.clean_sales(df)
    got = {r.sale_id: r for r in s.collect()}
    assert sorted(got) == [1, 4, 5]                  # zero quantity / revenue dropped
    assert got[1].unit_price == 50 and got[1].year == 2024 and got[1].month == 1
    products = spark.createDataFrame([(1,)], "product_id bigint")
    orphan_ids = sorted(r.sale_id for r in C.orphans(s.withColumn("product_id", F.col("product_id").cast("bigint")),
                                                     products).collect())
    assert orphan_ids == [4, 5]                      # unknown and NULL product


def test_clean_suppliers(spark):
    df = spark.createDataFrame([("1", "S", "45", "usa"), ("2", "T", "bad", "germany")],
                               "Supplier_ID string, Supplier_Name string, Lead_Time string, Location string")
    out = {r.supplier_id: r for r in C.clean_suppliers(df).collect()}
    assert out[1].long_lead_flag is True and out[1].location == "Usa"
    assert out[2].lead_time is None and out[2].long_lead_flag is False


def test_texts_are_parsed_once(spark):
    """The written distinct rows are typed and filtered already, counts are those before; a
    date alone is never tried as a date with a time of day, and texts in between are NULL."""
    rows = [("1", "5", "2024-01-02", "2024-01-05", "3"), ("1", "5", "2024-01-02", "2024-01-05", "3"),
            ("2", "5", "2024-01-02 10:11:12", "2024-01-04 00:00:00", "4"), ("3", "5", "2024-01-09", "2024-01-05", "x"),
            ("4", None, "2024-01-02T10:11:12Z", "2024-01-05", "1"), ("5", "5", "2024-1-2", "2024-02-30", "1")]
    raw = spark.createDataFrame(rows, "order_id string, product_id string, order_date string, delivery_date string, quantity string")
    typed, seen = C.deduplicated(raw, C._typed_orders)
    assert seen == {"rows_before": 6, "rows_after": 5} and dict(typed.dtypes)["order_date"] == "date"
    assert sorted((r.order_id, str(r.order_date), r.quantity) for r in typed.collect()) == [(1, "2024-01-02", 3.0), (2, "2024-01-02", 4.0)]
    plan = C.clean_orders(raw)._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" in plan and "gettimestamp" not in plan.lower()
    old = F.to_date(F.coalesce(*[F.try_to_timestamp("order_date", F.lit(f)) for f in C.ISO_FORMATS]))
    texts = spark.createDataFrame([(t,) for t in ("2024-01-02", "2024-01-02 10:11:12", "2024-01-02 10:11", "12024-01-02", "+12024-01-02 10:11:12",
                                                  " 2024-01-02 ", "", None, "2024-01-02 10:11:12 ", "0000-01-01", "2024-13-01")], "order_date string")
    got = C.parse_dates(texts.withColumn("old", old), ["order_date"])
    assert got.where(~F.col("old").eqNullSafe(F.col("order_date"))).isEmpty() and got.where("order_date is not null").count() >= 2
