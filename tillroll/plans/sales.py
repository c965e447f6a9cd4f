"""Sales queries of the SQL library and notebook."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import sales as S
from ..sources.tpch import SQL_YEARS, Star
from .registry import query


@query("join_sales_product", """
select s.sale_id, s.product_id, s.sale_date, s.quantity, cast(s.revenue as double) revenue,
       p.product_name, p.category, cast(p.cost as double) cost, cast(p.price as double) price
from fact_sales s join dim_product p on s.product_id = p.product_id""")
def join_sales_product(spark, sf):
    st = Star(spark, sf)
    j = st.fact_sales.join(st.dim_product, "product_id")
    return j.select("sale_id", "product_id", "sale_date", "quantity", F.col("revenue").cast("double").alias("revenue"),
                    "product_name", "category", F.col("cost").cast("double").alias("cost"),
                    F.col("price").cast("double").alias("price"))


_PER_PRODUCT = """per_product as (
  select product_id, sum(quantity) q, sum(revenue) r, count(revenue) n from fact_sales group by product_id)"""
_PER_DAY = """per_day as (
  select sale_date, sum(revenue) r, sum(quantity) q from fact_sales where sale_date is not null group by sale_date)"""


@query("total_kpis", f"""
with {_PER_PRODUCT}, ids as (select sale_id from fact_sales where sale_id is not null group by sale_id)
select (select count(*) from ids) total_transactions, cast(sum(q) as bigint) total_units_sold,
       cast(round(sum(r), 2) as double) total_revenue, round(cast(sum(r) as double) / sum(n), 2) avg_order_value
from per_product""")
def total_kpis(spark, sf):
    return S.total_kpis(Star(spark, sf).fact_sales)


@query("total_kpis_profit", f"""
with {_PER_PRODUCT},
known as (select t.*, t.r - t.q * d.cost gain from per_product t join dim_product d using (product_id)),
ids as (select sale_id from fact_sales where product_id in (select product_id from known) group by sale_id)
select (select count(*) from ids) total_transactions, cast(sum(q) as bigint) total_units_sold,
       cast(round(sum(r), 2) as double) total_revenue, round(cast(sum(r) as double) / sum(n), 2) avg_order_value,
       cast(round(sum(gain), 2) as double) gross_profit
from known""")
def total_kpis_profit(spark, sf):
    st = Star(spark, sf)
    return S.total_kpis_profit(st.fact_sales, st.dim_product)


@query("monthly_revenue", f"""
with {_PER_DAY}
select cast(year(sale_date) as int) "year", cast(month(sale_date) as int) "month", strftime(sale_date, '%B') month_name,
       cast(round(sum(r), 2) as double) monthly_revenue, cast(sum(q) as bigint) units_sold
from per_day group by all""")
def monthly_revenue(spark, sf):
    return S.monthly_revenue(Star(spark, sf).fact_sales)


@query("monthly_revenue_series", """
select cast(date_trunc('month', sale_date) as date) "month", cast(coalesce(sum(revenue), 0) as double) revenue
from fact_sales where sale_date is not null group by 1""")
def monthly_revenue_series(spark, sf):
    return S.monthly_revenue_series(Star(spark, sf).fact_sales)


@query("quarterly_revenue", f"""
with {_PER_DAY}
select cast(year(sale_date) as int) "year", cast(quarter(sale_date) as int) "quarter",
       cast(round(sum(r), 2) as double) quarterly_revenue, cast(sum(q) as bigint) units_sold
from per_day group by all""")
def quarterly_revenue(spark, sf):
    return S.quarterly_revenue(Star(spark, sf).fact_sales)


def _top_sql(n: int, way: str = "desc", rank: str = "") -> str:
    """SQL: the ``n`` known products of the most (least) revenue, from each product's totals."""
    return f"""
with {_PER_PRODUCT},
best as (select *{rank} from per_product semi join dim_product using (product_id) order by r {way}, product_id limit {n})
select product_id, product_name, category, cast(q as bigint) units_sold, cast(round(r, 2) as double) total_revenue
       {", revenue_rank" if rank else ""}
from best join dim_product using (product_id)"""


@query("top10_products", _top_sql(10))
def top10_products(spark, sf):
    st = Star(spark, sf)
    return S.top_products(st.fact_sales, st.dim_product, 10)


@query("rank_products", _top_sql(
    10, rank=", cast(rank() over (order by r desc) as int) revenue_rank"))
def rank_products(spark, sf):
    st = Star(spark, sf)
    return S.top_products(st.fact_sales, st.dim_product, 10, with_rank=True)


@query("bottom10_products", _top_sql(10, "asc"))
def bottom10_products(spark, sf):
    st = Star(spark, sf)
    return S.top_products(st.fact_sales, st.dim_product, 10, ascending=True)


@query("top8_products", _top_sql(8))
def top8_products(spark, sf):
    st = Star(spark, sf)
    return S.top_products(st.fact_sales, st.dim_product, 8)


@query("top_products_qty", f"""
with {_PER_PRODUCT}
select product_name, cast(sum(coalesce(q, 0)) as bigint) quantity
from per_product join dim_product using (product_id) where product_name is not null
group by product_name order by quantity desc, product_name limit 10""")
def top_products_qty(spark, sf):
    st = Star(spark, sf)
    return S.top_products_qty(st.fact_sales, st.dim_product, 10)


@query("category_revenue", """
select p.category, cast(round(coalesce(sum(s.revenue), 0), 2) as double) revenue
from fact_sales s join dim_product p on s.product_id = p.product_id
where p.category is not null group by p.category""")
def category_revenue(spark, sf):
    st = Star(spark, sf)
    return S.category_revenue(st.fact_sales, st.dim_product)


@query("category_performance", f"""
with {_PER_PRODUCT}
select category, count(*) product_count, cast(sum(q) as bigint) units_sold, cast(round(sum(r), 2) as double) total_revenue,
       round(cast(sum(r) as double) / sum(n), 2) avg_sale_value
from per_product join dim_product using (product_id) group by category""")
def category_performance(spark, sf):
    st = Star(spark, sf)
    return S.category_performance(st.fact_sales, st.dim_product)


@query("category_share", """
with c as (select p.category, sum(s.revenue) rev from fact_sales s join dim_product p
           on s.product_id = p.product_id group by p.category)
select category, cast(round(rev, 2) as double) revenue,
       round(cast(rev as double) / cast(sum(rev) over () as double) * 100, 2) share_pct from c""")
def category_share(spark, sf):
    st = Star(spark, sf)
    return S.category_share(st.fact_sales, st.dim_product)


@query("revenue_by_weekday", """
select strftime(sale_date, '%A') day_name, cast(isodow(sale_date) - 1 as int) weekday,
       cast(round(sum(revenue), 2) as double) revenue, cast(sum(quantity) as bigint) units_sold
from fact_sales group by 1, 2 order by 2""")
def revenue_by_weekday(spark, sf):
    return S.revenue_by_weekday(Star(spark, sf).fact_sales)


def _quarter_year_sql() -> str:
    cols = ", ".join(f"cast(round(sum(r) filter (year(sale_date) = {y}), 2) as double) \"{y}\"" for y in SQL_YEARS)
    return f"""
with {_PER_DAY}
select cast(quarter(sale_date) as int) "quarter", {cols} from per_day group by 1"""


@query("revenue_by_quarter_year", _quarter_year_sql())
def revenue_by_quarter_year(spark, sf):
    return S.revenue_by_quarter_year(Star(spark, sf).fact_sales)
