"""Stock over time: dated arrivals and sales, running balances, observed stock-outs.

A product's balance begins with its opening stock, falls with its sales and rises
with its replenishments: what an order takes is ordered again and arrives the
product's lead time after that order's delivery.  Movements are summed per product
and day before anything is ordered, so a window sees one row per day of a product,
however many sales the product has.

The classifier's features are those known on a date; its label is what the balance
then did in the days after it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ordered import with_scalars

# Days of a label after the features' date, days of demand before it, lead time of a product.
HORIZON_DAYS = 180
DEMAND_DAYS = 365
LEAD_LEAST, LEAD_RANGE = 2, 13


def lead_days(product: str = "product_id") -> F.Column:
    return (F.lit(LEAD_LEAST) + F.pmod(F.col(product), F.lit(LEAD_RANGE))).cast("int")


def daily_movements(sales: DataFrame, orders: DataFrame) -> DataFrame:
    """Per product and day: sold and arrived units.  Movements without a product or a day
    are not counted."""
    out = sales.select("product_id", F.col("sale_date").alias("day"), F.col("quantity").alias("sold"), F.lit(0).alias("arrived"))
    back = orders.select("product_id", F.date_add("delivery_date", lead_days()).alias("day"), F.lit(0).alias("sold"),
                         F.col("quantity").alias("arrived"))
    return (out.union(back).where(F.col("product_id").isNotNull() & F.col("day").isNotNull()).groupBy("product_id", "day")
               .agg(F.coalesce(F.sum("sold"), F.lit(0)).alias("sold"), F.coalesce(F.sum("arrived"), F.lit(0)).alias("arrived")))


def stock_balance(fact_inventory: DataFrame, movements: DataFrame) -> DataFrame:
    """Per product in stock and day with movements: balance at the day's end and the
    lowest balance up to it."""
    opening = fact_inventory.groupBy("product_id").agg(F.sum("stock_level").alias("_open"))
    day = Window.partitionBy("product_id").orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    b = movements.join(opening, "product_id").withColumn("balance", F.col("_open") + F.sum(F.col("arrived") - F.col("sold")).over(day))
    return b.withColumn("lowest", F.least("_open", F.min("balance").over(day))).drop("_open")


def stockout_features(fact_inventory: DataFrame, sales: DataFrame, orders: DataFrame, horizon: int = HORIZON_DAYS,
                      demand_days: int = DEMAND_DAYS) -> DataFrame:
    """Per product in stock, as of ``horizon`` days before the last sale: current_stock (the
    balance then), lead_time, avg_daily_demand (units sold in the ``demand_days`` before,
    per day), and ``stockout``: 1 if the balance falls below zero in the ``horizon`` after."""
    moves = daily_movements(sales, orders)
    last = sales.agg(F.date_sub(F.max("sale_date"), horizon).alias("_as_of"))
    b = with_scalars(stock_balance(fact_inventory, moves), last)
    known = F.col("day") <= F.col("_as_of")
    recent = known & (F.col("day") > F.date_sub("_as_of", demand_days))
    per = b.groupBy("product_id").agg(
        F.max_by("balance", F.when(known, F.col("day"))).alias("_balance"),
        F.sum(F.when(recent, F.col("sold")).otherwise(0)).alias("_sold"),
        F.max((~known & (F.col("day") <= F.date_add("_as_of", horizon)) & (F.col("balance") < 0)).cast("int")).alias("_out"))
    opening = fact_inventory.groupBy("product_id").agg(F.sum("stock_level").alias("_open"))
    return opening.join(per, "product_id", "left").select(
        "product_id", F.coalesce("_balance", "_open").cast("bigint").alias("current_stock"), lead_days().alias("lead_time"),
        (F.coalesce("_sold", F.lit(0)).cast("double") / float(demand_days)).alias("avg_daily_demand"),
        F.coalesce("_out", F.lit(0)).alias("stockout"))
