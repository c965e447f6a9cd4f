"""Sales analysis: KPIs, period and category aggregates, top-k products.

Facts are aggregated to the join key first (partial aggregation combines
map-side), and only then joined to their dimension, so a product that holds
a third of all sales becomes one row before any join.  Calendar and
warehouse dimensions are bounded by construction and broadcast; the product
dimension grows with the data and is left to Catalyst's size check and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import date_spine, money
from ..session import ensure_checkpoint_dir
from .distinct import distinct_count, distinct_states
from .ordered import top_k, with_scalars


def _per_product(sales: DataFrame) -> DataFrame:
    return sales.groupBy("product_id").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("revenue").alias("revenue_sum"),
        F.count("revenue").alias("revenue_n"),
        F.count(F.lit(1)).alias("rows"))


def _per_day(sales: DataFrame) -> DataFrame:
    """Daily totals: at most one row per calendar day."""
    return sales.groupBy("sale_date").agg(
        F.sum("quantity").alias("units_sold"),
        F.sum("revenue").alias("revenue_sum"),
        F.count("revenue").alias("revenue_n"))


def _on_calendar(sales: DataFrame, dim_date: DataFrame | None) -> DataFrame:
    """Daily totals with the calendar's columns.  Without a calendar the totals are
    checkpointed, at most one row a day, and it runs over their years, so that the
    fact is read once.  Sales without a date are on no calendar."""
    d = _per_day(sales)
    if dim_date is None:
        ensure_checkpoint_dir(sales.sparkSession)
        d = d.checkpoint(eager=True)
        dim_date = date_spine(d, "sale_date")
    return d.join(F.broadcast(dim_date), F.col("sale_date") == F.col("full_date"))


def total_kpis(sales: DataFrame) -> DataFrame:
    """Transactions (distinct sale ids, as bitmaps: no id shuffles), units, revenue, mean revenue."""
    sums = sales.agg(
        F.sum("quantity").cast("bigint").alias("total_units_sold"),
        money(F.sum("revenue")).alias("total_revenue"),
        F.round(F.avg(F.col("revenue").cast("double")), 2).alias("avg_order_value"))
    return with_scalars(distinct_count(distinct_states(sales, "sale_id"), "total_transactions"), sums)


def total_kpis_profit(sales: DataFrame, product: DataFrame) -> DataFrame:
    """KPIs of sales with a known product plus gross profit."""
    known = product.select("product_id", "cost")
    # one row per product before the join; only the distinct sales need their rows
    per = sales.groupBy("product_id").agg(
        F.sum("quantity").alias("_qty"), F.sum("revenue").alias("_rev"), F.count("revenue").alias("_n")).join(
        known, "product_id")
    sums = per.agg(F.sum("_qty").cast("bigint").alias("total_units_sold"), money(F.sum("_rev")).alias("total_revenue"),
                   F.round(F.sum("_rev").cast("double") / F.sum("_n"), 2).alias("avg_order_value"),
                   money(F.sum(F.col("_rev") - F.col("_qty") * F.col("cost"))).alias("gross_profit"))
    sold = sales.select("sale_id", "product_id").join(known.select("product_id"), "product_id", "left_semi")
    return with_scalars(distinct_count(distinct_states(sold, "sale_id"), "total_transactions"), sums)


def monthly_revenue(sales: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Revenue and units by year, month and month name."""
    return (_on_calendar(sales, dim_date).groupBy("year", "month", "month_name")
             .agg(money(F.sum("revenue_sum")).alias("monthly_revenue"),
                  F.sum("units_sold").cast("bigint").alias("units_sold"))
             .orderBy("year", "month"))


def monthly_revenue_series(sales: DataFrame) -> DataFrame:
    """Revenue per calendar month present in the data (no gap filling).

    pandas-derived: rows without a date are not grouped, an all-missing sum is 0.
    """
    return (sales.where(F.col("sale_date").isNotNull())
                 .groupBy(F.trunc("sale_date", "month").alias("month"))
                 .agg(F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("revenue")))


def quarterly_revenue(sales: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Revenue and units by year and quarter."""
    return (_on_calendar(sales, dim_date).groupBy("year", "quarter")
             .agg(money(F.sum("revenue_sum")).alias("quarterly_revenue"),
                  F.sum("units_sold").cast("bigint").alias("units_sold"))
             .orderBy("year", "quarter"))


def product_revenue(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Per known product: name, category, units, exact revenue (decimal)."""
    return (_per_product(sales)
            .join(product.select("product_id", "product_name", "category", "cost"), "product_id"))


def top_products(sales: DataFrame, product: DataFrame, n: int = 10, ascending: bool = False,
                 with_rank: bool = False) -> DataFrame:
    """Top (or bottom) ``n`` products by revenue; ties broken by product_id."""
    pr = product_revenue(sales, product).select(
        "product_id", "product_name", "category",
        F.col("units_sold").cast("bigint").alias("units_sold"),
        F.col("revenue_sum").alias("_rev"))
    o = F.col("_rev").asc() if ascending else F.col("_rev").desc()
    top = top_k(pr, n, [o, F.col("product_id").asc()])
    if with_rank:
        # RANK over all products equals RANK inside the top n: every product
        # with a strictly higher revenue is itself in the top n.
        top = top.withColumn("revenue_rank", F.rank().over(Window.orderBy(o)))
    return top.withColumn("total_revenue", money("_rev")).drop("_rev")


def top_products_qty(sales: DataFrame, product: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` product *names* by units sold (names may repeat across ids).

    pandas-derived: NULL names are not grouped, an all-missing sum is 0.
    """
    s = (_per_product(sales).join(product.select("product_id", "product_name"), "product_id")
         .where(F.col("product_name").isNotNull())
         .groupBy("product_name").agg(F.coalesce(F.sum("units_sold"), F.lit(0)).cast("bigint").alias("quantity")))
    return top_k(s, n, [F.col("quantity").desc(), F.col("product_name").asc()])


def category_revenue(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue by category (pandas-derived: NULL category dropped, empty sum 0)."""
    return (product_revenue(sales, product).where(F.col("category").isNotNull()).groupBy("category")
            .agg(money(F.coalesce(F.sum("revenue_sum"), F.lit(0))).alias("revenue")))


def category_performance(sales: DataFrame, product: DataFrame) -> DataFrame:
    pr = product_revenue(sales, product)
    return (pr.groupBy("category")
              .agg(F.count_distinct("product_id").alias("product_count"),
                   F.sum("units_sold").cast("bigint").alias("units_sold"),
                   money(F.sum("revenue_sum")).alias("total_revenue"),
                   F.round(F.sum("revenue_sum").cast("double") / F.sum("revenue_n"), 2).alias("avg_sale_value"))
              .orderBy(F.col("total_revenue").desc()))


def category_share(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Each category's percent of total revenue (pie / donut data)."""
    c = product_revenue(sales, product).groupBy("category").agg(F.sum("revenue_sum").alias("_rev"))
    total = c.agg(F.sum("_rev").alias("_tot"))
    return with_scalars(c, total).select(
        "category", money("_rev").alias("revenue"),
        F.round(F.col("_rev").cast("double") / F.col("_tot").cast("double") * 100, 2).alias("share_pct"))


def revenue_by_weekday(sales: DataFrame) -> DataFrame:
    d = _per_day(sales)
    return (d.groupBy(F.date_format("sale_date", "EEEE").alias("day_name"),
                      F.weekday("sale_date").alias("weekday"))
              .agg(money(F.sum("revenue_sum")).alias("revenue"),
                   F.sum("units_sold").cast("bigint").alias("units_sold"))
              .orderBy("weekday"))


def revenue_by_quarter_year(sales: DataFrame, years=None) -> DataFrame:
    """Quarter rows, one revenue column per year (clustered-bar data).

    The days' totals are checkpointed, at most one row a day; ``years``, the pivot
    values, are all years from their first to their last unless given.
    """
    ensure_checkpoint_dir(sales.sparkSession)
    d = _per_day(sales).where(F.col("sale_date").isNotNull()).withColumn("year", F.year("sale_date")).checkpoint(eager=True)
    if years is None:
        r = d.agg(F.min("year").alias("a"), F.max("year").alias("b")).first()
        years = range(r.a, r.b + 1) if r.a is not None else ()
    return (d.groupBy(F.quarter("sale_date").alias("quarter")).pivot("year", list(years))
             .agg(money(F.sum("revenue_sum"))))
