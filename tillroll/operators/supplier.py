"""Supplier and fulfilment analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import status_flag
from .ordered import exact_quantiles, with_scalars

# On-time limit (days), lead-time status thresholds, delivery buckets.
ON_TIME_DAYS = 10
LEAD_GREEN, LEAD_AMBER = 7, 10
DELIVERY_BUCKETS = (("0-3", 0, 3), ("4-7", 4, 7), ("8-10", 8, 10))
DELIVERY_OVERFLOW = ">10"
HISTOGRAM_BINS = 20


def supplier_by_location(dim_supplier: DataFrame) -> DataFrame:
    return dim_supplier.groupBy("location").agg(
        F.count(F.lit(1)).alias("total_suppliers"),
        F.round(F.avg("lead_time"), 2).alias("avg_lead_time"),
        F.sum("lead_time").cast("bigint").alias("sum_lead_time"))


def v_supplier_performance(dim_supplier: DataFrame) -> DataFrame:
    """Suppliers by location plus the lead-time traffic light."""
    s = supplier_by_location(dim_supplier)
    return s.withColumn("lead_time_status", status_flag("avg_lead_time", LEAD_GREEN, LEAD_AMBER, False))


def row_status_lead_time(dim_supplier: DataFrame) -> DataFrame:
    return dim_supplier.select("supplier_id", "supplier_name", "lead_time",
                               status_flag("lead_time", LEAD_GREEN, LEAD_AMBER, False).alias("lead_time_status"))


def supplier_scorecard(dim_supplier: DataFrame, gross_margin: DataFrame) -> DataFrame:
    """Location, suppliers, sum of lead time and the (unrelated) gross margin %.

    Suppliers have no relationship to sales, so the margin column repeats the
    grand total on every row; ``gross_margin`` is that one-row measure.
    """
    s = dim_supplier.groupBy("location").agg(
        F.count(F.lit(1)).alias("total_suppliers"),
        F.sum("lead_time").cast("bigint").alias("sum_lead_time"))
    return with_scalars(s, gross_margin)


def fulfilment_stats(orders_clean: DataFrame) -> DataFrame:
    base = orders_clean.agg(
        F.count("fulfilment_days").alias("orders"),
        F.round(F.avg("fulfilment_days"), 4).alias("mean_days"),
        F.min("fulfilment_days").alias("min_days"),
        F.max("fulfilment_days").alias("max_days"))
    q = exact_quantiles(orders_clean, "fulfilment_days", [0.25, 0.5, 0.75],
                        names=["p25_days", "median_days", "p75_days"])
    return with_scalars(base, q)


def delivery_bucket(days: str = "fulfilment_days") -> F.Column:
    c = F.col(days)
    e = None
    for label, lo, hi in DELIVERY_BUCKETS:
        cond = (c >= lo) & (c <= hi)
        e = F.when(cond, label) if e is None else e.when(cond, label)
    return e.when(c > DELIVERY_BUCKETS[-1][2], DELIVERY_OVERFLOW)


def delivery_buckets(orders_clean: DataFrame) -> DataFrame:
    return (orders_clean.groupBy(delivery_bucket().alias("bucket"))
            .agg(F.count(F.lit(1)).alias("orders")))


def mean_delivery_time(orders: DataFrame) -> DataFrame:
    """Mean order-to-delivery days over all orders (no date filter)."""
    return orders.agg(F.avg(F.datediff("delivery_date", "order_date")).alias("mean_delivery_days"))


def histogram(df: DataFrame, col: str, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Equal-width histogram between min and max; the top edge is closed.

    min/max is a one-row aggregate broadcast back; counting is a grouped
    aggregate with map-side combine.
    """
    mm = df.agg(F.min(col).cast("double").alias("_mn"), F.max(col).cast("double").alias("_mx"))
    j = with_scalars(df.select(col).where(F.col(col).isNotNull()), mm)
    width = (F.col("_mx") - F.col("_mn")) / bins
    b = F.least(F.floor((F.col(col) - F.col("_mn")) / width), F.lit(bins - 1))
    b = F.when(F.col("_mx") == F.col("_mn"), 0).otherwise(b).cast("int")
    g = j.groupBy(b.alias("bin"), "_mn", "_mx").agg(F.count(F.lit(1)).alias("count"))
    w = (F.col("_mx") - F.col("_mn")) / bins
    return g.select("bin", (F.col("_mn") + F.col("bin") * w).alias("lower"),
                    (F.col("_mn") + (F.col("bin") + 1) * w).alias("upper"), "count")


def delivery_histogram(orders: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    d = orders.select(F.datediff("delivery_date", "order_date").alias("delivery_time"))
    return histogram(d, "delivery_time", bins)
