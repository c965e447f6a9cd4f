"""Cleaning queries: every cleaning step applied to tables of the test data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import standardize_columns as _std, str_title
from ..operators import clean as C
from ..sources.tpch import Star
from .registry import query

# DuckDB form of Python's str.title() on ASCII text
_TITLE = ("array_to_string(list_transform(regexp_extract_all(lower({x}), '([a-z]+|[^a-z]+)'), "
          "lambda y: upper(y[1]) || y[2:]), '')")


def _title(x: str) -> str:
    return _TITLE.format(x=x)


@query("standardize_columns", """
select sale_id, product_id, sale_date, quantity, cast(revenue as double) revenue_rs from fact_sales""")
def standardize_columns(spark, sf):
    """Raw-style headers (spaces, hyphens, brackets) normalised to snake_case."""
    s = Star(spark, sf).fact_sales.select(
        F.col("sale_id").alias(" Sale_ID"), F.col("product_id").alias("Product ID"),
        F.col("sale_date").alias("Sale-Date "), F.col("quantity").alias("QUANTITY"),
        F.col("revenue").cast("double").alias("Revenue  (Rs)"))
    return _std(s)


@query("drop_duplicates", "select distinct * from raw_orders")
def drop_duplicates(spark, sf):
    return C.drop_duplicates(Star(spark, sf).raw_orders)


@query("coerce_int", """
select cast(cast(sale_id as varchar) as bigint) sale_id, cast(cast(product_id as varchar) as bigint) product_id
from fact_sales""")
def coerce_int(spark, sf):
    s = Star(spark, sf).fact_sales.select(F.col("sale_id").cast("string").alias("sale_id"),
                                          F.col("product_id").cast("string").alias("product_id"))
    return C.coerce_int(s, ["sale_id", "product_id"])


@query("coerce_numeric", """
select o_orderkey, try_cast(cast(o_totalprice as varchar) as double) total_text,
       try_cast(o_orderpriority as double) priority_text from orders""")
def coerce_numeric(spark, sf):
    """Numeric text -> double; free text (order priority) -> NULL."""
    o = Star(spark, sf).table("orders").select(
        "o_orderkey", F.col("o_totalprice").cast("string").alias("total_text"),
        F.col("o_orderpriority").alias("priority_text"))
    return C.coerce_numeric(o, ["total_text", "priority_text"])


@query("parse_dates", """
select o_orderkey,
       cast(coalesce(try_strptime(order_date_text, '%Y-%m-%d %H:%M:%S'), try_strptime(order_date_text, '%Y-%m-%d'))
            as date) order_date_text,
       cast(coalesce(try_strptime(bad_text, '%Y-%m-%d %H:%M:%S'), try_strptime(bad_text, '%Y-%m-%d')) as date) bad_text
from (select o_orderkey, cast(o_orderdate as varchar) order_date_text, o_orderpriority bad_text from orders)""")
def parse_dates(spark, sf):
    """Date text -> DATE; unparsable text -> NULL."""
    o = Star(spark, sf).table("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("string").alias("order_date_text"),
        F.col("o_orderpriority").alias("bad_text"))
    return C.parse_dates(o, ["order_date_text", "bad_text"])


@query("impute_median", """
with u as (select product_id, cast(cost as double) cost from raw_products)
select product_id, coalesce(cost, (select quantile_cont(cost, 0.5) from u)) cost from u""")
def impute_median(spark, sf):
    """Cost of every product row; missing costs get the median."""
    p = Star(spark, sf).raw_products.select("product_id", F.col("cost").cast("double").alias("cost"))
    return C.impute_median(p, ["cost"])


@query("cap_outliers", """
with q as (select quantile_cont(cast(revenue as double), 0.25) q1, quantile_cont(cast(revenue as double), 0.75) q3
           from raw_sales)
select sale_id, product_id, sale_date, quantity,
       case when revenue is null then null else
         least(greatest(cast(revenue as double), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) end revenue
from raw_sales, q""")
def cap_outliers(spark, sf):
    return C.cap_outliers(Star(spark, sf).raw_sales, "revenue")


@query("cap_outliers_grouped", """
with q as (select product_id, quantile_cont(cast(quantity as double), 0.25) q1,
                  quantile_cont(cast(quantity as double), 0.75) q3 from fact_sales group by product_id)
select s.sale_id, s.product_id, s.sale_date,
       case when s.quantity is null then null else
         least(greatest(cast(s.quantity as double), q1 - 1.5 * (q3 - q1)), q3 + 1.5 * (q3 - q1)) end quantity,
       cast(s.revenue as double) revenue
from fact_sales s left join q on s.product_id = q.product_id""")
def cap_outliers_grouped(spark, sf):
    """IQR capping with fences per product (grouped variant)."""
    s = Star(spark, sf).fact_sales.withColumn("revenue", F.col("revenue").cast("double"))
    return C.cap_outliers(s, "quantity", by=["product_id"]).select(
        "sale_id", "product_id", "sale_date", "quantity", "revenue")


@query("margin_cols", """
select product_id, product_name, category, cast(cost as double) cost, cast(price as double) price,
       cast(price as double) - cast(cost as double) margin,
       round((cast(price as double) - cast(cost as double)) / nullif(cast(price as double), 0) * 100, 2) margin_pct
from dim_product""")
def margin_cols(spark, sf):
    return C.margin_cols(Star(spark, sf).dim_product.withColumns(
        {"cost": F.col("cost").cast("double"), "price": F.col("price").cast("double")}))


@query("str_title", f"select distinct category, {_title('category')} category_title from dim_product")
def str_title_q(spark, sf):
    c = Star(spark, sf).dim_product.select("category").distinct()
    return c.withColumn("category_title", str_title("category"))


@query("unit_price", """
select sale_id, product_id, cast(revenue as double) revenue, quantity,
       cast(revenue as double) / nullif(cast(quantity as double), 0) unit_price from fact_sales""")
def unit_price(spark, sf):
    s = Star(spark, sf).fact_sales.select("sale_id", "product_id", F.col("revenue").cast("double").alias("revenue"),
                                          "quantity")
    return C.unit_price(s)


@query("sale_date_parts", """
select sale_id, sale_date, cast(year(sale_date) as int) "year", cast(month(sale_date) as int) "month",
       cast(quarter(sale_date) as int) "quarter", cast(weekofyear(sale_date) as int) "week" from fact_sales""")
def sale_date_parts(spark, sf):
    return C.sale_date_parts(Star(spark, sf).fact_sales.select("sale_id", "sale_date"))


@query("dim_date_attrs", "select * from dim_date")
def dim_date_attrs(spark, sf):
    """Calendar attributes (date key, names, ISO week, weekend flag) of every day."""
    return Star(spark, sf).dim_date


@query("filter_positive_sales", """
select * from raw_sales where revenue > 0 and quantity > 0""")
def filter_positive_sales(spark, sf):
    return C.filter_positive_sales(Star(spark, sf).raw_sales)


def _cap(x: str, q: str = "q") -> str:
    return (f"case when {x} is null then null else least(greatest({x}, {q}.q1 - 1.5 * ({q}.q3 - {q}.q1)), "
            f"{q}.q3 + 1.5 * ({q}.q3 - {q}.q1)) end")


@query("clean_products", f"""
with d as (select distinct * from raw_products),
t as (select product_id, product_name, category, cast(cost as double) cost, cast(price as double) price from d),
m as (select quantile_cont(cost, 0.5) mc, quantile_cont(price, 0.5) mp from t),
i as (select product_id, product_name, category, coalesce(cost, mc) cost, coalesce(price, mp) price from t, m),
g as (select *, price - cost margin, round((price - cost) / nullif(price, 0) * 100, 2) margin_pct,
             {_title('category')} category_t from i),
qc as (select quantile_cont(cost, 0.25) q1, quantile_cont(cost, 0.75) q3 from g),
c1 as (select product_id, product_name, category_t category, {_cap('cost', 'qc')} cost, price, margin, margin_pct
       from g, qc),
qp as (select quantile_cont(price, 0.25) q1, quantile_cont(price, 0.75) q3 from c1)
select product_id, product_name, category, cost, {_cap('price', 'qp')} price, margin, margin_pct from c1, qp""")
def clean_products(spark, sf):
    return C.clean_products(Star(spark, sf).raw_products)


@query("clean_suppliers", f"""
select distinct supplier_id, supplier_name, cast(lead_time as double) lead_time, {_title('location')} location,
       coalesce(cast(lead_time as double) > 30, false) long_lead_flag
from raw_suppliers""")
def clean_suppliers(spark, sf):
    return C.clean_suppliers(Star(spark, sf).raw_suppliers)


@query("clean_inventory", """
select distinct product_id, warehouse,
       case when stock_level is null then null else greatest(cast(stock_level as double), 0) end stock_level,
       cast(reorder_level as double) reorder_level,
       coalesce(greatest(cast(stock_level as double), 0) <= cast(reorder_level as double), false) needs_reorder
from raw_inventory""")
def clean_inventory(spark, sf):
    return C.clean_inventory(Star(spark, sf).raw_inventory)


@query("clean_orders", f"""
with d as (select distinct * from raw_orders),
f as (select order_id, product_id, order_date, delivery_date, cast(quantity as double) quantity,
             cast(datediff('day', order_date, delivery_date) as int) fulfilment_days
      from d where delivery_date >= order_date),
q as (select quantile_cont(quantity, 0.25) q1, quantile_cont(quantity, 0.75) q3 from f)
select order_id, product_id, order_date, delivery_date, {_cap('quantity')} quantity, fulfilment_days from f, q""")
def clean_orders(spark, sf):
    return C.clean_orders(Star(spark, sf).raw_orders)


@query("clean_sales", f"""
with d as (select distinct * from raw_sales),
f as (select sale_id, product_id, sale_date, cast(quantity as double) quantity, cast(revenue as double) revenue
      from d where revenue > 0 and quantity > 0),
q as (select quantile_cont(revenue, 0.25) q1, quantile_cont(revenue, 0.75) q3 from f)
select sale_id, product_id, sale_date, quantity, {_cap('revenue')} revenue,
       cast(year(sale_date) as int) "year", cast(month(sale_date) as int) "month",
       cast(quarter(sale_date) as int) "quarter", cast(weekofyear(sale_date) as int) "week",
       revenue / nullif(quantity, 0) unit_price
from f, q""")
def clean_sales(spark, sf):
    return C.clean_sales(Star(spark, sf).raw_sales)


@query("anti_orphans", """
select s.* from raw_sales s where not exists (select 1 from dim_product p where p.product_id = s.product_id)""")
def anti_orphans(spark, sf):
    """Sales whose product is unknown (NULL product ids included)."""
    st = Star(spark, sf)
    return C.orphans(st.raw_sales, st.dim_product)


@query("orphan_counts", """
select (select count(*) from raw_sales s where not exists
          (select 1 from dim_product p where p.product_id = s.product_id)) orphan_sales,
       (select count(*) from raw_orders o where not exists
          (select 1 from dim_product p where p.product_id = o.product_id)) orphan_orders""")
def orphan_counts(spark, sf):
    from ..operators.ordered import with_scalars
    st = Star(spark, sf)
    a = C.orphans(st.raw_sales, st.dim_product).agg(F.count(F.lit(1)).alias("orphan_sales"))
    b = C.orphans(st.raw_orders, st.dim_product).agg(F.count(F.lit(1)).alias("orphan_orders"))
    return with_scalars(a, b)
