"""Dashboard measures (one-row results) and the KPI helper ratios."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import measures as M
from ..operators.ordered import with_scalars
from ..sources.tpch import Star
from .registry import query

_PP = "(select product_id, sum(revenue) rev, sum(quantity) qty from fact_sales group by product_id)"


@query("m_total_revenue", "select cast(sum(revenue) as double) total_revenue from fact_sales")
def m_total_revenue(spark, sf):
    return M.total_revenue(Star(spark, sf).fact_sales)


@query("m_gross_profit", f"""
select cast(sum(p.rev - p.qty * d.cost) as double) gross_profit
from {_PP} p left join dim_product d on p.product_id = d.product_id""")
def m_gross_profit(spark, sf):
    st = Star(spark, sf)
    return M.gross_profit(st.fact_sales, st.dim_product)


@query("related_lookup", """
select d.category, cast(sum(s.revenue - s.quantity * d.cost) as double) gross_profit
from fact_sales s left join dim_product d on s.product_id = d.product_id group by d.category""")
def related_lookup(spark, sf):
    """Gross profit by category: the row-level RELATED(cost) lookup form."""
    st = Star(spark, sf)
    s = st.fact_sales.join(st.dim_product.select("product_id", "category"), "product_id", "left")
    return M.gross_profit(s, st.dim_product, by=["category"])


@query("m_gross_margin_pct", f"""
select case when sum(p.rev) = 0 or sum(p.rev) is null then 0 else
       cast(sum(p.rev - p.qty * d.cost) as double) / cast(sum(p.rev) as double) end * 100 gross_margin_pct
from {_PP} p left join dim_product d on p.product_id = d.product_id""")
def m_gross_margin_pct(spark, sf):
    st = Star(spark, sf)
    return M.gross_margin_pct(st.fact_sales, st.dim_product)


@query("m_avg_order_value", """
select case when count(*) = 0 then 0 else cast(sum(revenue) as double) / count(*) end avg_order_value
from fact_sales""")
def m_avg_order_value(spark, sf):
    return M.avg_order_value(Star(spark, sf).fact_sales)


def _top1_sql(inner: str, label: str, out: str, agg: str = "max") -> str:
    return f"""
with t as ({inner}), b as (select {agg}(rev) best from t)
select case when count(*) = 1 then min(t.{label}) end {out} from t, b where t.rev = b.best"""


@query("m_top_category", _top1_sql(
    "select d.category, sum(s.revenue) rev from fact_sales s join dim_product d on s.product_id = d.product_id "
    "group by d.category", "category", "top_category"))
def m_top_category(spark, sf):
    st = Star(spark, sf)
    return M.top_category(st.fact_sales, st.dim_product)


@query("m_best_product", _top1_sql(
    "select d.product_name, sum(s.revenue) rev from fact_sales s join dim_product d on s.product_id = d.product_id "
    "group by d.product_name", "product_name", "best_product"))
def m_best_product(spark, sf):
    st = Star(spark, sf)
    return M.best_product(st.fact_sales, st.dim_product)


@query("m_peak_day", _top1_sql(
    "select d.day_name, sum(s.revenue) rev from fact_sales s join dim_date d on s.sale_date = d.full_date "
    "group by d.day_name", "day_name", "peak_day"))
def m_peak_day(spark, sf):
    st = Star(spark, sf)
    return M.peak_day(st.fact_sales, st.dim_date)


@query("m_best_month", _top1_sql(
    "select strftime(sale_date, '%Y-%m') \"month\", sum(revenue) rev from fact_sales group by 1",
    "month", "best_month"))
def m_best_month(spark, sf):
    return M.best_month(Star(spark, sf).fact_sales)


@query("m_total_skus", "select count(distinct product_id) total_skus from fact_inventory")
def m_total_skus(spark, sf):
    return M.total_skus(Star(spark, sf).fact_inventory)


@query("m_reorder_alerts", """
select cast(count_if(coalesce(stock_level <= reorder_level, false)) as bigint) reorder_alert_count,
       case when count(distinct product_id) = 0 then 0 else
         cast(count_if(coalesce(stock_level <= reorder_level, false)) as double) / count(distinct product_id) end * 100
         reorder_alert_pct,
       case when avg(reorder_level) = 0 or avg(reorder_level) is null then 0
            else avg(stock_level) / avg(reorder_level) end avg_stock_coverage
from fact_inventory""")
def m_reorder_alerts(spark, sf):
    """Reorder Alert Count, Reorder Alert % and Avg Stock Coverage."""
    return M.reorder_alerts(Star(spark, sf).fact_inventory)


@query("m_critical_warehouse", _top1_sql(
    "select w.warehouse_name, count_if(i.stock_level <= i.reorder_level) rev from fact_inventory i "
    "join dim_warehouse w on i.warehouse_id = w.warehouse_id group by w.warehouse_name",
    "warehouse_name", "critical_warehouse"))
def m_critical_warehouse(spark, sf):
    st = Star(spark, sf)
    return M.critical_warehouse(st.fact_inventory, st.dim_warehouse)


@query("m_inventory_turnover", """
with u as (select cast(sum(quantity) as double) units from fact_sales),
     s as (select avg(stock_level) avg_stock from fact_inventory)
select case when s.avg_stock = 0 or s.avg_stock is null then 0 else u.units / s.avg_stock end inventory_turnover,
       case when u.units / 365 = 0 or u.units is null then 0 else s.avg_stock / (u.units / 365) end
         days_inventory_outstanding
from u, s""")
def m_inventory_turnover(spark, sf):
    """Inventory Turnover and Days Inventory Outstanding."""
    st = Star(spark, sf)
    return M.inventory_turnover(st.fact_sales, st.fact_inventory)


_SUPPLIER_MEASURES = """
with s as (select count(*) total_suppliers, avg(lead_time) avg_lead_time from dim_supplier),
     o as (select avg(fulfilment_days) avg_fulfilment,
                  case when count(*) = 0 then 0 else cast(count_if(fulfilment_days <= 10) as double) / count(*) end
                    * 100 on_time_pct,
                  case when count(*) = 0 then 0 else cast(count_if(fulfilment_days > 10) as double) / count(*) end
                    * 100 late_pct
           from fact_orders_clean)
select s.total_suppliers, s.avg_lead_time, o.avg_fulfilment, o.on_time_pct, o.late_pct,
       o.avg_fulfilment - s.avg_lead_time fulfilment_gap_days
from s, o"""


@query("m_supplier_measures", _SUPPLIER_MEASURES)
def m_supplier_measures(spark, sf):
    """Total Suppliers, Avg Lead Time, Avg Fulfilment, gap, On-Time and Late %."""
    st = Star(spark, sf)
    return M.supplier_measures(st.dim_supplier, st.fact_orders_clean)


@query("m_total_suppliers", "select count(*) total_suppliers from dim_supplier")
def m_total_suppliers(spark, sf):
    return M.supplier_count(Star(spark, sf).dim_supplier).select("total_suppliers")


@query("m_avg_lead_time", "select avg(lead_time) avg_lead_time from dim_supplier")
def m_avg_lead_time(spark, sf):
    return M.supplier_count(Star(spark, sf).dim_supplier).select("avg_lead_time")


@query("m_fastest_origin", _top1_sql(
    "select location, avg(lead_time) rev from dim_supplier group by location", "location", "fastest_origin", "min"))
def m_fastest_origin(spark, sf):
    return M.fastest_origin(Star(spark, sf).dim_supplier)


@query("status_flag", f"""
with v as ({_SUPPLIER_MEASURES})
select *, case when avg_lead_time <= 7 then 1 when avg_lead_time <= 10 then 2 else 3 end avg_lead_time_status,
       case when avg_fulfilment <= 8 then 1 when avg_fulfilment <= 12 then 2 else 3 end avg_fulfilment_status,
       case when fulfilment_gap_days <= 0 then 1 when fulfilment_gap_days <= 2 then 2 else 3 end
         fulfilment_gap_days_status,
       case when on_time_pct >= 90 then 1 when on_time_pct >= 75 then 2 else 3 end on_time_pct_status
from v""")
def status_flag(spark, sf):
    """Traffic-light statuses of the supplier KPI cards."""
    st = Star(spark, sf)
    return M.kpi_status(M.supplier_measures(st.dim_supplier, st.fact_orders_clean))


@query("kpi_status_inventory", """
with v as (select case when count(distinct product_id) = 0 then 0 else
                    cast(count_if(stock_level <= reorder_level) as double) / count(distinct product_id) end * 100
                    reorder_alert_pct,
                  case when avg(reorder_level) = 0 then 0 else avg(stock_level) / avg(reorder_level) end
                    avg_stock_coverage
           from fact_inventory)
select *, case when reorder_alert_pct <= 10 then 1 when reorder_alert_pct <= 20 then 2 else 3 end
            reorder_alert_pct_status,
          case when avg_stock_coverage >= 3 then 1 when avg_stock_coverage >= 2 then 2 else 3 end
            avg_stock_coverage_status
from v""")
def kpi_status_inventory(spark, sf):
    """Traffic lights of the inventory KPI cards."""
    r = M.reorder_alerts(Star(spark, sf).fact_inventory).select("reorder_alert_pct", "avg_stock_coverage")
    return M.kpi_status(r)


@query("kpi_inventory_turnover", """
with c as (select sum(cast(s.quantity as decimal(18,0)) * d.cost) cogs from fact_sales s
           join dim_product d on s.product_id = d.product_id),
     i as (select avg(cast(f.stock_level as decimal(18,0)) * d.cost) avg_inv from fact_inventory f
           join dim_product d on f.product_id = d.product_id)
select cast(c.cogs as double) cost_of_goods_sold, cast(i.avg_inv as double) average_inventory,
       round(cast(c.cogs as double) / cast(i.avg_inv as double), 2) inventory_turnover
from c, i""")
def kpi_inventory_turnover(spark, sf):
    """round(COGS / average inventory value, 2)."""
    st = Star(spark, sf)
    cost = st.dim_product.select("product_id", "cost")
    cogs = (st.fact_sales.groupBy("product_id").agg(F.sum("quantity").alias("_q")).join(cost, "product_id")
            .agg(F.sum(F.col("_q").cast("decimal(18,0)") * F.col("cost")).alias("_c")))
    inv = (st.fact_inventory.join(cost, "product_id")
           .agg(F.avg(F.col("stock_level").cast("decimal(18,0)") * F.col("cost")).cast("double").alias("_i")))
    j = with_scalars(cogs, inv).select(F.col("_c").cast("double").alias("cost_of_goods_sold"),
                                       F.col("_i").alias("average_inventory"))
    return M.kpi_ratio("cost_of_goods_sold", "average_inventory", False, "inventory_turnover")(j)


@query("kpi_stockout_rate", """
select cast(count_if(stockout = 1) as bigint) stockout_orders, count(*) total_orders,
       round(cast(count_if(stockout = 1) as double) / count(*) * 100, 2) stockout_rate
from stockout_features""")
def kpi_stockout_rate(spark, sf):
    """round(stock-outs / total * 100, 2) over the product-warehouse positions."""
    s = Star(spark, sf).stockout_features.agg(F.count_if(F.col("stockout") == 1).alias("stockout_orders"),
                                              F.count(F.lit(1)).alias("total_orders"))
    return M.kpi_ratio("stockout_orders", "total_orders", True, "stockout_rate")(s)


@query("kpi_fill_rate", """
select cast(count_if(delivery_date >= order_date) as bigint) filled_orders, count(*) total_orders,
       round(cast(count_if(delivery_date >= order_date) as double) / count(*) * 100, 2) fill_rate
from fact_orders""")
def kpi_fill_rate(spark, sf):
    """round(filled / total * 100, 2); an order is filled once delivered on/after its date."""
    o = Star(spark, sf).fact_orders.agg(
        F.count_if(F.col("delivery_date") >= F.col("order_date")).alias("filled_orders"),
        F.count(F.lit(1)).alias("total_orders"))
    return M.kpi_ratio("filled_orders", "total_orders", True, "fill_rate")(o)


@query("kpi_status_sales", f"""
with g as (select case when sum(p.rev) = 0 or sum(p.rev) is null then 0 else
                    cast(sum(p.rev - p.qty * d.cost) as double) / cast(sum(p.rev) as double) end * 100 gross_margin_pct
           from {_PP} p left join dim_product d on p.product_id = d.product_id),
c as (select min(full_date) lo, max(full_date) hi from dim_date),
y as (select cast(sum(case when sale_date between c.lo and c.hi then revenue end) as double) total_revenue,
             cast(sum(case when sale_date between c.lo - interval 12 month and c.hi - interval 12 month
                           then revenue end) as double) revenue_ly
      from fact_sales, c),
m as (select cast(date_trunc('month', sale_date) as date) mo, sum(revenue) v from fact_sales group by 1),
span as (select min(mo) a, max(mo) b from m),
spine as (select cast(unnest(generate_series(a, b, interval 1 month)) as date) mo from span),
s as (select last_day(spine.mo) month_end, cast(coalesce(m.v, 0) as double) revenue from spine left join m
      on spine.mo = m.mo),
f as (select month_end, revenue,
             case when count(revenue) over w = 3 then avg(revenue) over w end ma3
      from s window w as (order by month_end rows between 2 preceding and current row)),
last as (select 100.0 - case when revenue = 0 or revenue is null then 0 else abs(revenue - ma3) / revenue end * 100
                forecast_accuracy_pct from f where month_end = (select max(month_end) from f))
select g.gross_margin_pct,
       case when y.revenue_ly = 0 or y.revenue_ly is null then 0 else (y.total_revenue - y.revenue_ly) / y.revenue_ly
       end * 100 yoy_growth_pct,
       last.forecast_accuracy_pct,
       case when yoy_growth_pct >= 5 then 1 when yoy_growth_pct >= 0 then 2 else 3 end yoy_growth_pct_status,
       case when g.gross_margin_pct >= 30 then 1 when g.gross_margin_pct >= 20 then 2 else 3 end gross_margin_pct_status,
       case when last.forecast_accuracy_pct >= 85 then 1 when last.forecast_accuracy_pct >= 70 then 2 else 3 end
         forecast_accuracy_pct_status
from g, y, last""")
def kpi_status_sales(spark, sf):
    """Traffic lights of the sales KPI cards: gross margin %, YoY growth %
    (whole calendar vs the same period one year earlier) and forecast
    accuracy % of the latest month."""
    from ..operators import timeseries as T
    st = Star(spark, sf)
    gm = M.gross_margin_pct(st.fact_sales, st.dim_product)
    yoy = M.yoy_card(st.fact_sales, f"{st.years[0]}-01-01", f"{st.years[-1]}-12-31").select("yoy_growth_pct")
    acc = T.forecast_accuracy(st.fact_sales)
    last = acc.agg(F.max("month_end").alias("_last"))
    fa = with_scalars(acc, last).where(F.col("month_end") == F.col("_last")).select("forecast_accuracy_pct")
    vals = with_scalars(with_scalars(gm, yoy), fa).select("gross_margin_pct", "yoy_growth_pct",
                                                          "forecast_accuracy_pct")
    return M.kpi_status(vals)
