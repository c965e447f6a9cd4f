"""Product scorecard, margin analysis, category matrix, enriched sales view
and measures under a slicer.

All per-product numbers come from one grouped pass over the sales fact; the
product and inventory sides join by key.  "Best X per category" uses a max
over (value, tie-break) structs, a plain aggregate with map-side combine, so
a category holding a third of all rows is not one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import null_false, safe_divide
from .clean import margin_cols
from .ordered import global_rank


def product_scorecard(sales: DataFrame, product: DataFrame, fact_inventory: DataFrame) -> DataFrame:
    """Per product: revenue, units, gross profit, margin %, stock, alert, revenue rank."""
    s = sales.groupBy("product_id").agg(F.sum("revenue").alias("_rev"), F.sum("quantity").alias("_qty"))
    inv = fact_inventory.groupBy("product_id").agg(
        F.sum("stock_level").alias("_stock"),
        F.max(null_false(F.col("stock_level") <= F.col("reorder_level")).cast("int")).alias("_alert"))
    p = (product.select("product_id", "product_name", "category", "cost")
         .join(s, "product_id", "left").join(inv, "product_id", "left"))
    rev = F.coalesce(F.col("_rev"), F.lit(0))
    qty = F.coalesce(F.col("_qty"), F.lit(0))
    profit = rev - qty * F.col("cost")
    out = p.select(
        "product_id", "product_name", "category",
        rev.alias("revenue_dec"),
        rev.cast("double").alias("revenue"), qty.cast("bigint").alias("units_sold"),
        profit.cast("double").alias("gross_profit"),
        F.round(safe_divide(profit.cast("double"), rev.cast("double")) * 100, 2).alias("margin_pct"),
        F.coalesce(F.col("_stock"), F.lit(0)).cast("bigint").alias("stock"),
        F.coalesce(F.col("_alert") == 1, F.lit(False)).alias("reorder_alert"))
    return global_rank(out, "revenue_dec", "revenue_rank", method="rank").drop("revenue_dec")


def margin_analysis(product: DataFrame) -> DataFrame:
    """Per category: mean / min / max product margin %."""
    m = margin_cols(product.withColumns({"cost": F.col("cost").cast("double"),
                                         "price": F.col("price").cast("double")}))
    return m.groupBy("category").agg(
        F.count(F.lit(1)).alias("products"),
        F.round(F.avg("margin_pct"), 2).alias("avg_margin_pct"),
        F.min("margin_pct").alias("min_margin_pct"), F.max("margin_pct").alias("max_margin_pct"))


def sales_enriched(sales: DataFrame, product: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Sales x product x calendar with line profit (the enriched-sales view)."""
    j = (sales.join(product.select("product_id", "product_name", "category", "cost"), "product_id")
         .join(F.broadcast(dim_date.select("full_date", "year", "quarter", "month", "day_name")),
               F.col("sale_date") == F.col("full_date")))
    return j.select("sale_id", "sale_date", "product_id", "product_name", "category", "quantity",
                    F.col("revenue").cast("double").alias("revenue"), F.col("cost").cast("double").alias("cost"),
                    (F.col("revenue") - F.col("quantity") * F.col("cost")).cast("double").alias("profit"),
                    "year", "quarter", "month", "day_name")


def category_matrix(sales: DataFrame, product: DataFrame, fact_inventory: DataFrame,
                    dim_warehouse: DataFrame) -> DataFrame:
    """Per category: best month and its revenue, best product, critical
    warehouse (most reorder alerts), gross profit and margin %."""
    p = product.select("product_id", "product_name", "category", "cost")
    pm = (sales.groupBy("product_id", F.date_format("sale_date", "yyyy-MM").alias("month"))
          .agg(F.sum("revenue").alias("_r"), F.sum("quantity").alias("_q"))
          .join(p, "product_id"))
    month = (pm.groupBy("category", "month").agg(F.sum("_r").alias("_mr"))
             .groupBy("category").agg(F.max(F.struct(F.col("_mr"), F.col("month"))).alias("_bm")))
    prod = (pm.groupBy("category", "product_id", "product_name").agg(F.sum("_r").alias("_pr"))
            .groupBy("category").agg(F.max(F.struct(F.col("_pr"), (-F.col("product_id")).alias("_k"),
                                                    F.col("product_name"))).alias("_bp")))
    money = pm.groupBy("category").agg(F.sum("_r").alias("_rev"),
                                       F.sum(F.col("_r") - F.col("_q") * F.col("cost")).alias("_gp"))
    alerts = (fact_inventory.where(F.col("stock_level") <= F.col("reorder_level"))
              .join(p.select("product_id", "category"), "product_id")
              .join(dim_warehouse, "warehouse_id")
              .groupBy("category", "warehouse_name").agg(F.count(F.lit(1)).alias("_a"))
              .groupBy("category").agg(F.min(F.struct((-F.col("_a")).alias("_na"),
                                                      F.col("warehouse_name"))).alias("_cw")))
    out = money.join(month, "category", "left").join(prod, "category", "left").join(alerts, "category", "left")
    return out.select(
        "category",
        F.col("_bm.month").alias("best_month"), F.col("_bm._mr").cast("double").alias("best_month_revenue"),
        F.col("_bp.product_name").alias("best_product"),
        F.col("_cw.warehouse_name").alias("critical_warehouse"),
        F.col("_gp").cast("double").alias("gross_profit"),
        (safe_divide(F.col("_gp").cast("double"), F.col("_rev").cast("double"), 0) * 100).alias("gross_margin_pct"))


def quarterly_pivot(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Year rows x quarter columns q1..q4 of revenue."""
    d = (sales.groupBy("sale_date").agg(F.sum("revenue").alias("_r"))
         .join(F.broadcast(dim_date), F.col("sale_date") == F.col("full_date")))
    p = d.groupBy("year").pivot("quarter", [1, 2, 3, 4]).agg(F.sum("_r"))
    return p.select("year", *[F.round(F.col(str(q)), 2).cast("double").alias(f"q{q}") for q in (1, 2, 3, 4)])


def sliced_measures(sales: DataFrame, product: DataFrame, slicers: Sequence[str]) -> DataFrame:
    """Total revenue, gross profit and margin % under every value of the
    slicer columns (product attributes such as category)."""
    p = product.select("product_id", "cost", *slicers)
    s = sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"), F.sum("quantity").alias("_q")).join(
        p, "product_id")
    g = s.groupBy(*slicers).agg(F.sum("_r").alias("_rev"), F.sum(F.col("_r") - F.col("_q") * F.col("cost")).alias("_gp"))
    return g.select(*slicers, F.col("_rev").cast("double").alias("total_revenue"),
                    F.col("_gp").cast("double").alias("gross_profit"),
                    (safe_divide(F.col("_gp").cast("double"), F.col("_rev").cast("double"), 0) * 100)
                    .alias("gross_margin_pct"))
