"""Inventory analysis: stock by warehouse, reorder alerts, coverage, turnover.

``fact_inventory`` has one row per (product, warehouse).  Warehouses are a
small dimension that Catalyst broadcasts by its size; products are joined by key and left
to Catalyst/AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import null_false, safe_divide
from .ordered import global_rank, top_k, with_scalars

# Overstock multiple, dead-stock horizon (days), row statuses.
OVERSTOCK_FACTOR = 3
DEAD_STOCK_DAYS = 90


def _alert() -> F.Column:
    return null_false(F.col("stock_level") <= F.col("reorder_level"))


def warehouse_stock(inventory: DataFrame) -> DataFrame:
    """Sum of stock by warehouse name (inventory with a ``warehouse`` column).

    pandas-derived: NULL warehouses are not grouped, an all-missing sum is 0.
    """
    return (inventory.where(F.col("warehouse").isNotNull()).groupBy("warehouse")
            .agg(F.coalesce(F.sum("stock_level"), F.lit(0)).cast("bigint").alias("stock_level")))


def warehouse_stock_vs_reorder(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("warehouse").agg(
        F.sum("stock_level").cast("bigint").alias("total_stock"),
        F.sum("reorder_level").cast("bigint").alias("total_reorder"))


def inventory_detail(inventory: DataFrame) -> DataFrame:
    """Per warehouse and product: stock and coverage (avg stock / avg reorder)."""
    return inventory.groupBy("warehouse", "product_id").agg(
        F.sum("stock_level").cast("bigint").alias("stock_level"),
        F.round(safe_divide(F.avg("stock_level"), F.avg("reorder_level"), 0), 2).alias("coverage_ratio"))


def reorder_alerts_by_warehouse(fact_inventory: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    """Alerts and mean stock over mean reorder level: sums per warehouse id first, names last."""
    ids = fact_inventory.groupBy("warehouse_id").agg(
        F.count_if(_alert()).alias("_alerts"), F.sum("stock_level").alias("_s"), F.count("stock_level").alias("_sn"),
        F.sum("reorder_level").alias("_r"), F.count("reorder_level").alias("_rn"))
    mean = lambda total, n: safe_divide(F.sum(total).cast("double"), F.sum(n))
    return (ids.join(dim_warehouse, "warehouse_id").groupBy("warehouse_name")
               .agg(F.sum("_alerts").cast("bigint").alias("alert_count"),
                    F.round(safe_divide(mean("_s", "_sn"), mean("_r", "_rn")), 2).alias("coverage_ratio"))
               .orderBy(F.col("alert_count").desc()))


def _alerts(fact_inventory: DataFrame, dim_product: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    i = fact_inventory.where(F.col("stock_level") <= F.col("reorder_level"))
    return (i.join(dim_product.select("product_id", "product_name", "category"), "product_id")
             .join(dim_warehouse, "warehouse_id")
             .withColumn("deficit", F.col("reorder_level") - F.col("stock_level")))


def inventory_alerts(fact_inventory, dim_product, dim_warehouse, limit: int | None = 20) -> DataFrame:
    """Rows at or below reorder level with product and warehouse, worst first."""
    a = _alerts(fact_inventory, dim_product, dim_warehouse)
    cols = ["product_name", "category", "warehouse_name", "stock_level", "reorder_level", "deficit"]
    if limit is None:
        return a.select(*cols)
    return top_k(a, limit, [F.col("deficit").desc(), F.col("product_id").asc(),
                            F.col("warehouse_id").asc()]).select(*cols)


def overstocked(fact_inventory: DataFrame, factor: int = OVERSTOCK_FACTOR) -> DataFrame:
    return fact_inventory.where(F.col("stock_level") > F.lit(factor) * F.col("reorder_level"))


def warehouse_overview(fact_inventory: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    j = fact_inventory.join(dim_warehouse, "warehouse_id")
    return j.groupBy("warehouse_id", "warehouse_name").agg(
        F.count_distinct("product_id").alias("skus"),
        F.sum("stock_level").cast("bigint").alias("total_stock"),
        F.sum("reorder_level").cast("bigint").alias("total_reorder"),
        F.sum(F.when(_alert(), 1).otherwise(0)).cast("bigint").alias("alerts"),
        F.round(safe_divide(F.avg("stock_level"), F.avg("reorder_level")), 2).alias("coverage_ratio"))


def turnover_ratio(sales: DataFrame, fact_inventory: DataFrame) -> DataFrame:
    """Per product: units sold / stock on hand (all warehouses)."""
    units = sales.groupBy("product_id").agg(F.sum("quantity").alias("units_sold"))
    stock = fact_inventory.groupBy("product_id").agg(F.sum("stock_level").alias("stock"))
    return (stock.join(units, "product_id", "left")
                 .select("product_id",
                         F.coalesce(F.col("units_sold"), F.lit(0)).cast("bigint").alias("units_sold"),
                         F.col("stock").cast("bigint").alias("stock"),
                         safe_divide(F.coalesce(F.col("units_sold"), F.lit(0)).cast("double"),
                                     F.col("stock").cast("double")).alias("turnover")))


def dead_stock(sales: DataFrame, fact_inventory: DataFrame, days: int = DEAD_STOCK_DAYS) -> DataFrame:
    """Stocked rows whose product has no sale in the last ``days`` days of data."""
    last = sales.groupBy("product_id").agg(F.max("sale_date").alias("last_sale"))
    horizon = sales.agg(F.date_sub(F.max("sale_date"), days).alias("_cutoff"))
    j = with_scalars(fact_inventory.where(F.col("stock_level") > 0).join(last, "product_id", "left"), horizon)
    return (j.where(F.col("last_sale").isNull() | (F.col("last_sale") < F.col("_cutoff")))
             .select("product_id", "warehouse_id", "stock_level", "last_sale"))


def distinct_warehouses(inventory: DataFrame) -> DataFrame:
    """Warehouse dimension from inventory names: 1-based id in name order.

    Like ``unique()``, a missing name is a member too (it sorts last), so the
    null-safe join of the star load gives those inventory rows an id.
    """
    names = inventory.select(F.col("warehouse").alias("warehouse_name")).distinct()
    return global_rank(names, "warehouse_name", "warehouse_id", method="dense", descending=False)


def row_status_reorder(fact_inventory: DataFrame) -> DataFrame:
    """Row colour of the inventory table: 3 (red) when max stock <= max reorder."""
    g = fact_inventory.groupBy("product_id", "warehouse_id").agg(
        F.max("stock_level").alias("stock_level"), F.max("reorder_level").alias("reorder_level"))
    return g.withColumn("reorder_status", F.when(F.col("stock_level") <= F.col("reorder_level"), 3).otherwise(1))


def cross_category_warehouse(sales, dim_product, fact_inventory, dim_warehouse) -> DataFrame:
    """Category x warehouse: stock of the category's SKUs and their revenue."""
    rev = sales.groupBy("product_id").agg(F.sum("revenue").alias("_rev"))
    inv = (fact_inventory.join(dim_product.select("product_id", "category"), "product_id")
           .join(dim_warehouse, "warehouse_id")
           .join(rev, "product_id", "left"))
    return inv.groupBy("category", "warehouse_name").agg(
        F.count_distinct("product_id").alias("skus"),
        F.sum("stock_level").cast("bigint").alias("total_stock"),
        F.round(F.coalesce(F.sum("_rev"), F.lit(0)), 2).cast("double").alias("revenue"))
