"""Source / sink queries: parquet scan, CSV round trips, star load, calendar,
model persistence.  Written data goes under the session's checkpoint folder
(shared storage on a cluster) and is read back."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import standardize_columns
from ..operators import classify as CL
from ..operators import clean as C
from ..operators import profile as P
from ..sources import files as IO
from ..sources.tpch import Star
from .registry import query


def _root(spark, sf: str, name: str) -> str:
    """A new folder for each run: earlier results may still be read."""
    return IO.output_root(spark, uuid.uuid4().hex[:12], name)


@query("scan_parquet", """
select l_orderkey, l_partkey, l_quantity, l_extendedprice from lineitem""")
def scan_parquet(spark, sf):
    """Projected parquet scan of all rows; filters put on top are pushed into it."""
    return Star(spark, sf).table("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")


def _raw_products(st: Star):
    """The product table in the raw CSV layout (headers of the source file)."""
    names = IO.RAW_COLUMNS["products"]
    p = st.dim_product
    return p.select(*[F.col(src).cast("string").alias(dst) for src, dst in
                      zip(("product_id", "product_name", "category", "cost", "price"), names)])


_PRODUCTS_SQL = """
select product_id, product_name, category, cast(cost as double) cost, cast(price as double) price
from dim_product"""


@query("scan_raw_csv", """
select cast(product_id as varchar) product_id, product_name, category, cast(cost as varchar) cost,
       cast(price as varchar) price
from dim_product""")
def scan_raw_csv(spark, sf):
    """Write the products as a raw CSV, read it back as text with its header."""
    path = IO.sink_clean_csv(_raw_products(Star(spark, sf)), _root(spark, sf, "raw_products_csv"))
    return standardize_columns(IO.scan_raw_csv(spark, path, "products"))


@query("sink_clean_csv", _PRODUCTS_SQL)
def sink_clean_csv(spark, sf):
    """Cleaned-table CSV write (header, no index) and typed read-back."""
    st = Star(spark, sf)
    p = st.dim_product.withColumns({"cost": F.col("cost").cast("double"), "price": F.col("price").cast("double")})
    path = IO.sink_clean_csv(p, _root(spark, sf, "products_clean_csv"))
    return spark.read.schema(p.schema).option("header", True).csv(path)


@query("scan_clean_csv_dates", """
select order_id, product_id, order_date, delivery_date, quantity, fulfilment_days from fact_orders_clean""")
def scan_clean_csv_dates(spark, sf):
    """Cleaned orders written to CSV and read back with parsed date columns."""
    o = Star(spark, sf).fact_orders_clean
    path = IO.sink_clean_csv(o, _root(spark, sf, "orders_clean_csv"))
    df = IO.scan_clean_csv(spark, path, "orders", schema=o.schema)
    return df


@query("sink_replace_table", """
select *, cast(year(sale_date) as int) "year", cast(month(sale_date) as int) "month" from fact_sales""")
def sink_replace_table(spark, sf):
    """fact_sales replaced as parquet partitioned by year/month and read back
    whole (period filters on it prune partitions: tests/test_plans.py)."""
    s = Star(spark, sf).fact_sales.withColumns({"year": F.year("sale_date"), "month": F.month("sale_date")})
    path = IO.replace_table(s, f"fact_sales_{uuid.uuid4().hex[:12]}", IO.output_root(spark), ("year", "month"))
    return spark.read.parquet(path).select(*s.columns)


@query("load_star", " union all ".join(
    f"select '{t}' table_name, count(*) row_count from {t}"
    for t in ("dim_product", "dim_supplier", "dim_warehouse", "dim_date", "fact_sales", "fact_orders",
              "fact_inventory")))
def load_star(spark, sf):
    """Write all seven star tables (dimensions first) and count them back."""
    st = Star(spark, sf)
    names = ("dim_product", "dim_supplier", "dim_warehouse", "dim_date", "fact_sales", "fact_orders",
             "fact_inventory")
    run = uuid.uuid4().hex[:12]
    paths = IO.load_star({n: getattr(st, n) for n in names}, IO.output_root(spark, run), f"run_{run}_")
    return P.table_counts({n: spark.read.parquet(p) for n, p in paths.items()})


def _raw_tables(st: Star) -> dict:
    """The five raw tables, their columns as text under the raw headers."""
    sources = {"products": st.raw_products, "suppliers": st.raw_suppliers, "inventory": st.raw_inventory,
               "orders": st.raw_orders, "sales": st.raw_sales}
    return {n: df.select(*[F.col(c).cast("string").alias(raw) for c, raw in zip(df.columns, IO.RAW_COLUMNS[n])])
            for n, df in sources.items()}


_RAW_FIELDS = {"products": "product_id, product_name, category, cost, price",
               "suppliers": "supplier_id, supplier_name, lead_time, location",
               "inventory": "product_id, warehouse, stock_level, reorder_level",
               "orders": "order_id, product_id, order_date, delivery_date, quantity",
               "sales": "sale_id, product_id, sale_date, quantity, revenue"}


def _joined(fields: str) -> str:
    return " || '|' || ".join(f"coalesce(cast({f.strip()} as varchar), '')" for f in fields.split(","))


@query("scan_raw_csv_all", " union all ".join(
    f"select '{n}' table_name, {_joined(f)} record from raw_{n}" for n, f in _RAW_FIELDS.items()))
def scan_raw_csv_all(spark, sf):
    """All five raw tables written as CSV and read back as text, one record a row."""
    root = _root(spark, sf, "raw_csv")
    for name, df in _raw_tables(Star(spark, sf)).items():
        IO.sink_clean_csv(df, f"{root}/{name}.csv")
    tables, _ = IO.scan_raw_all(spark, root)
    parts = [df.select(F.lit(n).alias("table_name"), F.concat_ws("|", *[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in df.columns])
                       .alias("record")) for n, df in tables.items()]
    return reduce(DataFrame.union, parts)


_DAMAGED = """(select *, case when product_id % 5 = 0 then product_id || ',' || product_name
        when product_id % 7 = 0 then product_id || ',' || product_name || ',' || category || ',1,2,3'
        when product_id % 11 = 0 then product_id || ',"' || product_name || ',' || category || ',1,2' end damaged
    from dim_product)"""


@query("quarantine_csv", f"""
select 'bad' kind, damaged record from {_DAMAGED} where damaged is not null
union all
select 'good', product_id || '|' || product_name || '|' || category || '|' || cost || '|' || price from {_DAMAGED}
where damaged is null""")
def quarantine_csv(spark, sf):
    """Raw lines of which some are too short, too long or have an open quote: the good
    records' fields, and the bad ones whole."""
    k, name, kind = F.col("product_id"), F.col("product_name"), F.col("category")
    line = (F.when(k % 5 == 0, F.concat_ws(",", k, name)).when(k % 7 == 0, F.concat(F.concat_ws(",", k, name, kind), F.lit(",1,2,3")))
             .when(k % 11 == 0, F.concat(k, F.lit(',"'), F.concat_ws(",", name, kind), F.lit(",1,2")))
             .otherwise(F.concat_ws(",", k, name, kind, "cost", "price")))
    path = _root(spark, sf, "damaged_csv")
    Star(spark, sf).dim_product.select(line.alias("value")).write.text(path)
    good, bad = IO.split_raw_csv(spark, path, "products", header=False)
    return bad.select(F.lit("bad").alias("kind"), "record").union(
        good.select(F.lit("good"), F.concat_ws("|", *[F.col(c) for c in good.columns])))


@query("clean_report", " union all ".join(f"""
select '{n}' table_name, count(*) rows_before, (select count(*) from (select distinct * from raw_{n})) rows_after,
       (select count(*) from (select distinct * from raw_{n}){where}) rows_written from raw_{n}""" for n, where in (
    ("products", ""), ("suppliers", ""), ("inventory", ""), ("orders", " where delivery_date >= order_date"),
    ("sales", " where revenue > 0 and quantity > 0"))))
def clean_report(spark, sf):
    """Every raw table cleaned and written as CSV; rows before and after the dedup and rows
    written, as counted by those jobs."""
    _, report = C.clean_all(_raw_tables(Star(spark, sf)), _root(spark, sf, "cleaned"))
    return spark.createDataFrame(report, "table_name string, rows_before long, rows_after long, rows_written long")


@query("scan_clean_csv_all", """
select 'orders' table_name, cast(order_id as varchar) id, order_date "date", quantity from fact_orders_clean
union all select 'sales', cast(sale_id as varchar), sale_date, quantity from fact_sales""")
def scan_clean_csv_all(spark, sf):
    """Cleaned tables written as CSV and all read back with their dates; those with dates are returned."""
    st, root = Star(spark, sf), _root(spark, sf, "clean_csv")
    tables = {"products": st.dim_product, "suppliers": st.dim_supplier, "inventory": st.inventory,
              "orders": st.fact_orders_clean, "sales": st.fact_sales}
    for n, df in tables.items():
        IO.sink_clean_csv(df, f"{root}/{n}_clean.csv")
    back = IO.scan_clean_all(spark, root, {n: df.schema for n, df in tables.items()})
    o = back["orders"].select(F.lit("orders").alias("table_name"), F.col("order_id").cast("string").alias("id"),
                              F.col("order_date").alias("date"), "quantity")
    return o.union(back["sales"].select(F.lit("sales"), F.col("sale_id").cast("string"), "sale_date", "quantity"))


@query("gen_date_spine", "select * from dim_date")
def gen_date_spine(spark, sf):
    """Daily calendar with ten attributes (explode(sequence(start, end)))."""
    return Star(spark, sf).dim_date


@query("model_save")
def model_save(spark, sf):
    """Fit the stock-out forest, save it, load it back and score all rows."""
    IO.output_root(spark)                          # a checkpoint folder is set
    features = Star(spark, sf).stockout_features.checkpoint(eager=True)
    model, _ = CL.fit_stockout(features)
    path = _root(spark, sf, "stockout_model")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    return CL.scored(back, features).select("product_id", CL.LABEL, "prediction")


@query("clean_then_orphans", """
with s as (select distinct * from fact_sales where revenue > 0 and quantity > 0)
select count(*) orphan_sales from s where product_id not in (select product_id from dim_product)""")
def clean_then_orphans(spark, sf):
    """Cross-check after cleaning: cleaned sales with unknown products."""
    st = Star(spark, sf)
    s = C.filter_positive_sales(C.drop_duplicates(st.fact_sales))
    return C.orphans(s, st.dim_product).agg(F.count(F.lit(1)).alias("orphan_sales"))

