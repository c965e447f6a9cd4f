"""Profiling queries (notebook checks and the DB-overview section)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import profile as P
from ..sources.tpch import Star
from .registry import query

STAR_TABLES = ("dim_product", "dim_supplier", "dim_warehouse", "dim_date", "fact_sales", "fact_orders",
               "fact_inventory")
# source table each star table is derived from (row-verification expectations)
STAR_SOURCES = {"dim_product": "part", "dim_supplier": "supplier", "dim_warehouse": "region",
                "fact_sales": "lineitem", "fact_orders": "lineitem", "fact_inventory": "part"}


def _star_tables(st: Star) -> dict:
    return {t: getattr(st, t) for t in STAR_TABLES}


@query("profile_head", """
select * from dim_product order by product_id limit 5""")
def profile_head(spark, sf):
    return P.head(Star(spark, sf).dim_product, "product_id", 5)


@query("profile_shape", " union all ".join(
    f"select '{t}' table_name, count(*) \"rows\", {n} \"columns\" from {t}"
    for t, n in (("dim_product", 5), ("dim_supplier", 4), ("dim_warehouse", 2), ("dim_date", 10),
                 ("fact_sales", 5), ("fact_orders", 5), ("fact_inventory", 4))))
def profile_shape(spark, sf):
    return P.shape(_star_tables(Star(spark, sf)))


@query("table_counts", " union all ".join(
    f"select '{t}' table_name, count(*) row_count from {t}" for t in STAR_TABLES))
def table_counts(spark, sf):
    return P.table_counts(_star_tables(Star(spark, sf)))


def _verification_sql() -> str:
    parts = []
    for t in STAR_TABLES:
        exp = (f"(select count(*) from {STAR_SOURCES[t]})" if t in STAR_SOURCES else
               "(select cast(max(make_date(year(sale_date), 12, 31)) - min(make_date(year(sale_date), 1, 1)) as bigint) + 1 "
               "from fact_sales)")
        parts.append(f"select '{t}' table_name, {exp} expected_rows, (select count(*) from {t}) actual_rows")
    return "select *, expected_rows = actual_rows matches from (" + " union all ".join(parts) + ")"


@query("row_verification", _verification_sql())
def row_verification(spark, sf):
    """Expected (source) vs actual row counts of every star table."""
    st = Star(spark, sf)
    actual = P.table_counts(_star_tables(st)).withColumnRenamed("row_count", "actual_rows")
    srcs = {t: st.table(s) for t, s in STAR_SOURCES.items()}
    exp = P.table_counts(srcs).withColumnRenamed("row_count", "expected_rows")
    years = st.fact_sales.agg(F.year(F.min("sale_date")).alias("a"), F.year(F.max("sale_date")).alias("b"))
    days = years.select(F.lit("dim_date").alias("table_name"), (F.datediff(
        F.make_date("b", F.lit(12), F.lit(31)), F.make_date("a", F.lit(1), F.lit(1))) + 1).cast("bigint").alias("expected_rows"))
    exp = exp.unionByName(days)
    return (exp.join(actual, "table_name")
               .select("table_name", "expected_rows", "actual_rows",
                       (F.col("expected_rows") == F.col("actual_rows")).alias("matches")))


_PRODUCT_COLS = (("product_id", "bigint"), ("product_name", "string"), ("category", "string"),
                 ("cost", "decimal(14,4)"), ("price", "decimal(12,2)"))


@query("profile_info", " union all ".join(
    f"select '{c}' column_name, count({c}) non_null, '{t}' dtype from dim_product" for c, t in _PRODUCT_COLS))
def profile_info(spark, sf):
    return P.info(Star(spark, sf).dim_product)


@query("profile_nulls", " union all ".join(
    f"select '{c}' column_name, cast(count_if({c} is null) as bigint) nulls from raw_orders"
    for c in ("order_id", "product_id", "order_date", "delivery_date", "quantity")))
def profile_nulls(spark, sf):
    return P.nulls(Star(spark, sf).raw_orders)


@query("profile_duplicates", """
select cast(coalesce(sum(n - 1), 0) as bigint) duplicate_rows
from (select count(*) n from raw_orders group by order_id, product_id, order_date, delivery_date, quantity)""")
def profile_duplicates(spark, sf):
    return P.duplicates(Star(spark, sf).raw_orders)


def _describe_sql(table: str, cols) -> str:
    return " union all ".join(f"""
select '{c}' column_name, count(x) "count", avg(x) mean, stddev_samp(x) std, min(x) "min",
       quantile_cont(x, 0.25) p25, quantile_cont(x, 0.5) p50, quantile_cont(x, 0.75) p75, max(x) "max"
from (select cast({c} as double) x from {table})""" for c in cols)


@query("profile_describe", _describe_sql("fact_sales", ("quantity", "revenue")))
def profile_describe(spark, sf):
    return P.describe(Star(spark, sf).fact_sales, ["quantity", "revenue"])


_CORR_COLS = ("cost", "price", "quantity", "revenue")


@query("profile_correlation", "with sd as (select cast(p.cost as double) cost, cast(p.price as double) price, "
       "cast(s.quantity as double) quantity, cast(s.revenue as double) revenue from fact_sales s "
       "join dim_product p on s.product_id = p.product_id) " + " union all ".join(
           f"select '{a}' col_a, '{b}' col_b, corr({a}, {b}) corr from sd" for a in _CORR_COLS for b in _CORR_COLS))
def profile_correlation(spark, sf):
    st = Star(spark, sf)
    sd = st.fact_sales.join(st.dim_product, "product_id")
    return P.correlation(sd, list(_CORR_COLS))


@query("profile_boxstats", """
with sd as (select cast(s.revenue as double) x from raw_sales s join dim_product p on s.product_id = p.product_id),
q as (select quantile_cont(x, 0.25) q1, quantile_cont(x, 0.5) median, quantile_cont(x, 0.75) q3 from sd)
select q1, median, q3, q3 - q1 iqr,
       min(case when x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then x end) whisker_low,
       max(case when x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1) then x end) whisker_high,
       cast(count_if(not (x between q1 - 1.5 * (q3 - q1) and q3 + 1.5 * (q3 - q1))) as bigint) outliers
from sd, q group by q1, median, q3""")
def profile_boxstats(spark, sf):
    st = Star(spark, sf)
    return P.boxstats(st.raw_sales.join(st.dim_product, "product_id"), "revenue")
