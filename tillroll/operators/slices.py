"""Every page slicer of every measure in one pass: measures for each category, each
warehouse, each pair of them and for all, by grouping sets over mergeable states.

A category reaches sales and stock through the product, a warehouse reaches stock
only, so sales measures are the same under every warehouse.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import null_false, safe_divide
from .distinct import distinct_grouping_sets, distinct_states
from .ordered import null_safe_join

SETS = ((), ("category",), ("warehouse_name",), ("category", "warehouse_name"))


def _sales(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue, units, profit and transactions for each category (_set 1) and all (_set 0)."""
    p = product.select("product_id", "category", "cost")
    per = sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"), F.sum("quantity").alias("_q")).join(p, "product_id")
    sums = per.groupingSets([[F.col("category")], []], "category").agg(
        (F.lit(1) - F.grouping("category")).cast("int").alias("_set"),
        F.sum("_r").alias("_rev"), F.sum("_q").cast("bigint").alias("units_sold"),
        F.sum(F.col("_r") - F.col("_q") * F.col("cost")).alias("_gp"))
    states = distinct_states(sales.join(p.select("product_id", "category"), "product_id"), "sale_id", ["category"])
    return null_safe_join(sums, distinct_grouping_sets(states, "transactions", [(), ("category",)]), ["_set", "category"])


def _stock(inventory: DataFrame, product: DataFrame, warehouse: DataFrame) -> DataFrame:
    """Stock, alerts and SKUs for all four groupings (_set by position in SETS)."""
    i = (inventory.join(product.select("product_id", "category"), "product_id")
         .join(warehouse.select("warehouse_id", "warehouse_name"), "warehouse_id"))
    alert = null_false(F.col("stock_level") <= F.col("reorder_level"))
    fine = i.groupBy("category", "warehouse_name").agg(
        F.sum("stock_level").alias("_s"), F.count("stock_level").alias("_sn"), F.sum("reorder_level").alias("_r"),
        F.count("reorder_level").alias("_rn"), F.count_if(alert).alias("_a"))
    sums = fine.groupingSets([[F.col(c) for c in s] for s in SETS], "category", "warehouse_name").agg(
        ((F.lit(1) - F.grouping("category")) + 2 * (F.lit(1) - F.grouping("warehouse_name"))).cast("int").alias("_set"),
        F.sum("_a").cast("bigint").alias("reorder_alert_count"),
        safe_divide(F.sum("_s").cast("double") / F.sum("_sn"), F.sum("_r").cast("double") / F.sum("_rn"), 0).alias("avg_stock_coverage"))
    states = distinct_states(i, "product_id", ["category", "warehouse_name"])
    skus = distinct_grouping_sets(states, "total_skus", SETS)
    return null_safe_join(sums, skus, ["_set", "category", "warehouse_name"])


def slicer_table(sales: DataFrame, product: DataFrame, inventory: DataFrame, warehouse: DataFrame) -> DataFrame:
    """One row for each choice of the two slicers that has stock: category_sliced,
    warehouse_sliced (whether the slicer is set), category, warehouse_name, and the
    measures under it."""
    stock = _stock(inventory, product, warehouse).withColumn("_by", F.col("_set") % 2)
    sold = _sales(sales, product).withColumnsRenamed({"_set": "_by"})
    j = null_safe_join(stock, sold, ["_by", "category"], "left")
    rev, profit = F.col("_rev").cast("double"), F.col("_gp").cast("double")
    return j.select(
        (F.col("_by") == 1).alias("category_sliced"), (F.col("_set") >= 2).alias("warehouse_sliced"), "category", "warehouse_name",
        F.coalesce("transactions", F.lit(0)).alias("transactions"), "units_sold", rev.alias("total_revenue"),
        profit.alias("gross_profit"), (safe_divide(profit, rev, 0) * 100).alias("gross_margin_pct"), "total_skus",
        "reorder_alert_count", (safe_divide(F.col("reorder_alert_count").cast("double"), F.col("total_skus"), 0) * 100)
        .alias("reorder_alert_pct"), "avg_stock_coverage")
