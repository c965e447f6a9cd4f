"""Dashboard measures as DataFrame aggregates.

A measure is ``metric(tables..., by=[...])``: with ``by=[]`` it returns one
row (the card value); with grouping columns it returns one row per group
(the same measure under a slicer / filter context).  DIVIDE(a, b, alt) is
``safe_divide``.  Top-1 text measures return NULL when several members tie,
like SELECTEDVALUE over a TOPN that kept more than one row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import null_false, safe_divide, status_flag
from .distinct import distinct_count, distinct_states
from .ordered import with_scalars

# Fixed values of the KPI cards: (measure, green, amber, higher_is_better).
STATUS_RULES = (
    ("yoy_growth_pct", 5, 0, True),
    ("gross_margin_pct", 30, 20, True),
    ("reorder_alert_pct", 10, 20, False),
    ("avg_stock_coverage", 3, 2, True),
    ("avg_lead_time", 7, 10, False),
    ("avg_fulfilment", 8, 12, False),
    ("fulfilment_gap_days", 0, 2, False),
    ("on_time_pct", 90, 75, True),
    ("forecast_accuracy_pct", 85, 70, True),
)
ON_TIME_DAYS = 10
DAYS_PER_YEAR = 365


def slice_facts(fact: DataFrame, product: DataFrame | None = None, category: str | None = None,
                warehouse_id: int | None = None) -> DataFrame:
    """Page slicers applied through the model's relationships.

    A category slicer filters the product dimension and reaches the fact
    through ``product_id`` (a semi join: the fact keeps its rows and
    columns).  A warehouse slicer filters facts that carry ``warehouse_id``
    (inventory); facts without that relationship (sales, orders) are not
    filtered by it, as in the report's model.
    """
    out = fact
    if category is not None:
        keys = product.where(F.col("category") == category).select("product_id")
        out = out.join(keys, "product_id", "left_semi")
    if warehouse_id is not None and "warehouse_id" in fact.columns:
        out = out.where(F.col("warehouse_id") == warehouse_id)
    return out


def _sales_cost(sales: DataFrame, product: DataFrame) -> DataFrame:
    """Per product exact sums, then the cost lookup (RELATED)."""
    p = sales.groupBy("product_id").agg(F.sum("revenue").alias("_rev"), F.sum("quantity").alias("_qty"))
    return p.join(product.select("product_id", "cost"), "product_id", "left")


def total_revenue(sales: DataFrame, by: Sequence[str] = (), product: DataFrame | None = None,
                  category: str | None = None) -> DataFrame:
    sales = slice_facts(sales, product, category)
    return sales.groupBy(*by).agg(F.sum("revenue").cast("double").alias("total_revenue"))


def gross_profit(sales: DataFrame, product: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """SUMX(revenue - quantity * RELATED(cost)).

    Without ``by`` the row-level sum is regrouped per product first:
    sum(revenue) - cost * sum(quantity) is the same exact decimal value.
    """
    if by:
        s = sales.join(product.select("product_id", "cost"), "product_id", "left")
        return s.groupBy(*by).agg(
            F.sum(F.col("revenue") - F.col("quantity") * F.col("cost")).cast("double").alias("gross_profit"))
    p = _sales_cost(sales, product)
    return p.agg(F.sum(F.col("_rev") - F.col("_qty") * F.col("cost")).cast("double").alias("gross_profit"))


def gross_margin_pct(sales: DataFrame, product: DataFrame, category: str | None = None) -> DataFrame:
    p = _sales_cost(slice_facts(sales, product, category), product)
    gp = F.sum(F.col("_rev") - F.col("_qty") * F.col("cost")).cast("double")
    return p.agg((safe_divide(gp, F.sum("_rev").cast("double"), 0) * 100).alias("gross_margin_pct"))


def avg_order_value(sales: DataFrame, product: DataFrame | None = None, category: str | None = None) -> DataFrame:
    sales = slice_facts(sales, product, category)
    return sales.agg(safe_divide(F.sum("revenue").cast("double"), F.count(F.lit(1)), 0).alias("avg_order_value"))


def top1(df: DataFrame, label: str, value: str, out: str, ascending: bool = False) -> DataFrame:
    """Label of the single best row of an aggregated frame; NULL on a tie."""
    best = df.agg((F.min(value) if ascending else F.max(value)).alias("_best"))
    hits = with_scalars(df, best).where(F.col(value) == F.col("_best"))
    return hits.agg(F.when(F.count(F.lit(1)) == 1, F.min(label)).alias(out))


def top_category(sales: DataFrame, product: DataFrame) -> DataFrame:
    c = (sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
         .join(product.select("product_id", "category"), "product_id")
         .groupBy("category").agg(F.sum("_r").alias("rev")))
    return top1(c, "category", "rev", "top_category")


def best_product(sales: DataFrame, product: DataFrame) -> DataFrame:
    c = (sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
         .join(product.select("product_id", "product_name"), "product_id")
         .groupBy("product_name").agg(F.sum("_r").alias("rev")))
    return top1(c, "product_name", "rev", "best_product")


def peak_day(sales: DataFrame, dim_date: DataFrame) -> DataFrame:
    d = (sales.groupBy("sale_date").agg(F.sum("revenue").alias("_r"))
         .join(F.broadcast(dim_date), F.col("sale_date") == F.col("full_date"))
         .groupBy("day_name").agg(F.sum("_r").alias("rev")))
    return top1(d, "day_name", "rev", "peak_day")


def best_month(sales: DataFrame) -> DataFrame:
    m = (sales.groupBy(F.date_format("sale_date", "yyyy-MM").alias("month"))
         .agg(F.sum("revenue").alias("rev")))
    return top1(m, "month", "rev", "best_month")


def total_skus(fact_inventory: DataFrame) -> DataFrame:
    """Distinct products in stock, as bitmaps."""
    return distinct_count(distinct_states(fact_inventory, "product_id"), "total_skus")


def reorder_alerts(fact_inventory: DataFrame, product: DataFrame | None = None, category: str | None = None,
                   warehouse_id: int | None = None) -> DataFrame:
    """Alert count, alert % of SKUs, and average stock coverage in one pass
    (optionally under the category / warehouse slicers)."""
    fact_inventory = slice_facts(fact_inventory, product, category, warehouse_id)
    alert = null_false(F.col("stock_level") <= F.col("reorder_level"))
    return fact_inventory.agg(
        F.count_if(alert).alias("reorder_alert_count"),
        (safe_divide(F.count_if(alert), F.count_distinct("product_id"), 0) * 100).alias("reorder_alert_pct"),
        safe_divide(F.avg("stock_level"), F.avg("reorder_level"), 0).alias("avg_stock_coverage"))


def critical_warehouse(fact_inventory: DataFrame, dim_warehouse: DataFrame) -> DataFrame:
    alert = null_false(F.col("stock_level") <= F.col("reorder_level"))
    w = (fact_inventory.join(dim_warehouse, "warehouse_id")
         .groupBy("warehouse_name").agg(F.count_if(alert).alias("alerts")))
    return top1(w, "warehouse_name", "alerts", "critical_warehouse")


def inventory_turnover(sales: DataFrame, fact_inventory: DataFrame) -> DataFrame:
    """Units sold / average stock, and days of inventory outstanding."""
    units = sales.agg(F.sum("quantity").cast("double").alias("_units"))
    stock = fact_inventory.agg(F.avg("stock_level").alias("_avg_stock"))
    j = with_scalars(units, stock)
    return j.select(
        safe_divide(F.col("_units"), F.col("_avg_stock"), 0).alias("inventory_turnover"),
        safe_divide(F.col("_avg_stock"), safe_divide(F.col("_units"), F.lit(DAYS_PER_YEAR), 0), 0)
        .alias("days_inventory_outstanding"))


def supplier_count(dim_supplier: DataFrame) -> DataFrame:
    """Suppliers and their mean lead time, from the dimension alone."""
    return dim_supplier.agg(F.count(F.lit(1)).alias("total_suppliers"), F.avg("lead_time").alias("avg_lead_time"))


def supplier_measures(dim_supplier: DataFrame, orders_clean: DataFrame) -> DataFrame:
    """Suppliers, mean lead time, mean fulfilment, gap, on-time and late %."""
    s = supplier_count(dim_supplier)
    o = orders_clean.agg(
        F.avg("fulfilment_days").alias("avg_fulfilment"),
        (safe_divide(F.count_if(F.col("fulfilment_days") <= ON_TIME_DAYS), F.count(F.lit(1)), 0) * 100)
        .alias("on_time_pct"),
        (safe_divide(F.count_if(F.col("fulfilment_days") > ON_TIME_DAYS), F.count(F.lit(1)), 0) * 100)
        .alias("late_pct"))
    j = with_scalars(s, o)
    return j.withColumn("fulfilment_gap_days", F.col("avg_fulfilment") - F.col("avg_lead_time"))


def fastest_origin(dim_supplier: DataFrame) -> DataFrame:
    loc = dim_supplier.groupBy("location").agg(F.avg("lead_time").alias("avg_lt"))
    return top1(loc, "location", "avg_lt", "fastest_origin", ascending=True)


def kpi_status(values: DataFrame) -> DataFrame:
    """Traffic-light status (1/2/3) for every measure column present."""
    cols = set(values.columns)
    out = [status_flag(m, g, a, hi).alias(f"{m}_status") for m, g, a, hi in STATUS_RULES if m in cols]
    return values.select("*", *out)


# -- helpers of the inventory_kpi module (scalar ratios, rounded to 2) -------
def kpi_ratio(num: str, den: str, pct: bool, out: str):
    def f(df: DataFrame) -> DataFrame:
        r = safe_divide(F.col(num).cast("double"), F.col(den).cast("double"))
        return df.select("*", F.round(r * 100 if pct else r, 2).alias(out))
    return f


def yoy_card(sales: DataFrame, calendar_start: str, calendar_end: str) -> DataFrame:
    """YoY Growth % with no filter: all revenue vs SAMEPERIODLASTYEAR of the
    whole calendar (dates one year before the calendar range)."""
    d = F.col("sale_date")
    start, end = F.to_date(F.lit(calendar_start)), F.to_date(F.lit(calendar_end))
    in_cal = (d >= start) & (d <= end)
    in_ly = (d >= F.add_months(start, -12)) & (d <= F.add_months(end, -12))
    r = sales.agg(F.sum(F.when(in_cal, F.col("revenue"))).cast("double").alias("total_revenue"),
                  F.sum(F.when(in_ly, F.col("revenue"))).cast("double").alias("revenue_ly"))
    return r.withColumn("yoy_growth_pct", safe_divide(F.col("total_revenue") - F.col("revenue_ly"),
                                                      F.col("revenue_ly"), 0) * 100)
