"""ABC segmentation, revenue ranks and contribution shares.

Cumulative shares need a running sum over *all* products in value order.
``prefix_sum`` computes it without a single-partition window, so the number
of products may grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_divide
from .ordered import global_rank, prefix_sum_totals, with_scalars

# Class limits (cumulative %, inclusive) and the SQL labels.
ABC_A_LIMIT = 80
ABC_B_LIMIT = 95
ABC_SQL_LABELS = ("A — Star", "B — Core", "C — Long Tail")
ABC_LABELS = ("A", "B", "C")


def _classify(pct: F.Column, labels) -> F.Column:
    # a NULL share fails both tests and falls to the last class
    return F.when(pct <= ABC_A_LIMIT, labels[0]).when(pct <= ABC_B_LIMIT, labels[1]).otherwise(labels[2])


def _cumulative(df: DataFrame, value: str, key: str) -> DataFrame:
    """Adds ``_cum`` (running sum, value desc then key) and ``_tot`` (grand total)."""
    order = [F.col(value).desc_nulls_last(), F.col(key).asc()]
    pc, tot = prefix_sum_totals(df, order, [value], suffix="_cum")  # both from one checkpointed pass
    return with_scalars(pc.withColumnRenamed(f"{value}_cum", "_cum"), tot.withColumnRenamed(f"{value}_total", "_tot"))


def abc_sql(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Revenue ABC of the SQL library: revenue rounded to 2, cumulative %
    rounded to 2 before the class test."""
    pr = (sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
          .join(product.select("product_id", "product_name", "category"), "product_id")
          .withColumn("total_revenue", F.round("_r", 2)).drop("_r"))
    c = _cumulative(pr, "total_revenue", "product_id")
    pct = F.round(F.col("_cum").cast("double") / F.col("_tot").cast("double") * 100, 2)
    return c.select("product_id", "product_name", "category",
                    F.col("total_revenue").cast("double").alias("total_revenue"),
                    pct.alias("cumulative_pct"),
                    _classify(pct, ABC_SQL_LABELS).alias("abc_segment"))


def abc_classification(items: DataFrame) -> DataFrame:
    """Annual value = demand x unit cost; unrounded cumulative %; A/B/C.

    ``items`` has product_id, annual_demand, unit_cost.
    """
    v = items.withColumn("annual_value", F.col("annual_demand") * F.col("unit_cost"))
    c = _cumulative(v, "annual_value", "product_id")
    pct = F.col("_cum").cast("double") / F.col("_tot").cast("double") * 100
    return c.select("product_id", "annual_demand", F.col("unit_cost").cast("double").alias("unit_cost"),
                    F.col("annual_value").cast("double").alias("annual_value"),
                    pct.alias("cumulative_percentage"),
                    _classify(pct, ABC_LABELS).alias("abc_class"))


def abc_items(sales: DataFrame, product: DataFrame) -> DataFrame:
    """ABC input from the star: units sold per product and its unit cost.

    Units are summed over the whole calendar; dividing by a constant number
    of years would not change any class.
    """
    u = sales.groupBy("product_id").agg(F.sum("quantity").alias("annual_demand"))
    return u.join(product.select("product_id", F.col("cost").alias("unit_cost")), "product_id")


def dense_rank_products(sales: DataFrame, product: DataFrame) -> DataFrame:
    """RANKX(ALL(product_name), revenue, DESC, DENSE) for every product name."""
    r = (sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
         .join(product.select("product_id", "product_name"), "product_id")
         .groupBy("product_name").agg(F.sum("_r").alias("revenue")))
    out = global_rank(r, "revenue", "revenue_rank", method="dense")
    return out.select("product_name", F.col("revenue").cast("double").alias("revenue"), "revenue_rank")


def revenue_contribution_pct(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Each product's share of the all-product revenue total, in percent."""
    r = (sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
         .join(product.select("product_id", "product_name"), "product_id"))
    tot = r.agg(F.sum("_r").alias("_t"))
    return with_scalars(r, tot).select(
        "product_id", "product_name", F.col("_r").cast("double").alias("revenue"),
        (safe_divide(F.col("_r").cast("double"), F.col("_t").cast("double"), 0) * 100).alias("contribution_pct"))
