"""Remaining SQL-library queries (scorecards, views, pivots) and the
per-measure keys that are projections of a combined measure query."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import inventory as I
from ..operators import scorecard as SC
from ..sources.tpch import Star
from .registry import derive, query


@query("product_scorecard", """
with s as (select product_id, sum(revenue) rev, sum(quantity) qty from fact_sales group by product_id),
i as (select product_id, sum(stock_level) stock, max(case when stock_level <= reorder_level then 1 else 0 end) alert
      from fact_inventory group by product_id),
p as (select d.product_id, d.product_name, d.category, coalesce(s.rev, 0) rev, coalesce(s.qty, 0) qty, d.cost,
             coalesce(i.stock, 0) stock, coalesce(i.alert = 1, false) alert
      from dim_product d left join s on d.product_id = s.product_id left join i on d.product_id = i.product_id)
select product_id, product_name, category, cast(rev as double) revenue, cast(qty as bigint) units_sold,
       cast(rev - qty * cost as double) gross_profit,
       round(cast(rev - qty * cost as double) / nullif(cast(rev as double), 0) * 100, 2) margin_pct,
       cast(stock as bigint) stock, alert reorder_alert,
       cast(rank() over (order by rev desc) as int) revenue_rank
from p""")
def product_scorecard(spark, sf):
    st = Star(spark, sf)
    return SC.product_scorecard(st.fact_sales, st.dim_product, st.fact_inventory)


@query("margin_analysis", """
with m as (select category, round((cast(price as double) - cast(cost as double)) / nullif(cast(price as double), 0)
                  * 100, 2) margin_pct from dim_product)
select category, count(*) products, round(avg(margin_pct), 2) avg_margin_pct, min(margin_pct) min_margin_pct,
       max(margin_pct) max_margin_pct
from m group by category""")
def margin_analysis(spark, sf):
    return SC.margin_analysis(Star(spark, sf).dim_product)


_ENRICHED = """
select s.sale_id, s.sale_date, s.product_id, p.product_name, p.category, s.quantity,
       cast(s.revenue as double) revenue, cast(p.cost as double) cost,
       cast(s.revenue - s.quantity * p.cost as double) profit, d.year, d.quarter, d.month, d.day_name
from fact_sales s join dim_product p on s.product_id = p.product_id
join dim_date d on s.sale_date = d.full_date"""


@query("v_sales_enriched", _ENRICHED)
def v_sales_enriched(spark, sf):
    st = Star(spark, sf)
    return SC.sales_enriched(st.fact_sales, st.dim_product, st.dim_date)


@query("category_matrix", """
with p as (select product_id, product_name, category, cost from dim_product),
pm as (select s.product_id, strftime(s.sale_date, '%Y-%m') "month", sum(s.revenue) r, sum(s.quantity) q
       from fact_sales s group by 1, 2),
j as (select pm.*, p.product_name, p.category, p.cost from pm join p on pm.product_id = p.product_id),
bm as (select category, "month", mr from (select category, "month", sum(r) mr,
         row_number() over (partition by category order by sum(r) desc, "month" desc) rk
         from j group by category, "month") where rk = 1),
bp as (select category, product_name from (select category, product_id, product_name, sum(r) pr,
         row_number() over (partition by category order by sum(r) desc, product_id) rk
         from j group by category, product_id, product_name) where rk = 1),
mo as (select category, sum(r) rev, sum(r - q * cost) gp from j group by category),
al as (select p.category, w.warehouse_name, count(*) a from fact_inventory i
       join p on i.product_id = p.product_id join dim_warehouse w on i.warehouse_id = w.warehouse_id
       where i.stock_level <= i.reorder_level group by 1, 2),
cw as (select category, warehouse_name from (select *, row_number() over (partition by category
         order by a desc, warehouse_name) rk from al) where rk = 1)
select mo.category, bm."month" best_month, cast(bm.mr as double) best_month_revenue, bp.product_name best_product,
       cw.warehouse_name critical_warehouse, cast(mo.gp as double) gross_profit,
       case when mo.rev = 0 or mo.rev is null then 0 else cast(mo.gp as double) / cast(mo.rev as double) end * 100
         gross_margin_pct
from mo left join bm on mo.category = bm.category left join bp on mo.category = bp.category
left join cw on mo.category = cw.category""")
def category_matrix(spark, sf):
    st = Star(spark, sf)
    return SC.category_matrix(st.fact_sales, st.dim_product, st.fact_inventory, st.dim_warehouse)


@query("quarterly_pivot", """
select d.year, """ + ", ".join(
    f"cast(round(sum(case when d.quarter = {q} then s.revenue end), 2) as double) q{q}" for q in (1, 2, 3, 4)) + """
from fact_sales s join dim_date d on s.sale_date = d.full_date group by d.year""")
def quarterly_pivot(spark, sf):
    st = Star(spark, sf)
    return SC.quarterly_pivot(st.fact_sales, st.dim_date)


@query("project_columns", """
with w as (select warehouse_name, cast(dense_rank() over (order by warehouse_name nulls last) as int) warehouse_id
           from (select distinct warehouse warehouse_name from inventory))
select i.product_id, w.warehouse_id, i.stock_level, i.reorder_level,
       coalesce(i.stock_level <= i.reorder_level, false) needs_reorder
from inventory i join w on i.warehouse is not distinct from w.warehouse_name""")
def project_columns(spark, sf):
    """Inventory merged with the generated warehouse ids and projected to the
    fact-table columns (the star-load projection).  The merge is null-safe:
    a missing warehouse name matches the missing-name member."""
    st = Star(spark, sf)
    w = I.distinct_warehouses(st.inventory)
    # no hint: the name list comes from the data, so Catalyst's size check decides
    j = st.inventory.join(w, st.inventory.warehouse.eqNullSafe(w.warehouse_name))
    return j.select("product_id", "warehouse_id", "stock_level", "reorder_level",
                    F.coalesce(F.col("stock_level") <= F.col("reorder_level"), F.lit(False)).alias("needs_reorder"))


@query("slicer_filter", """
with s as (select product_id, sum(revenue) r, sum(quantity) q from fact_sales group by product_id),
j as (select p.category, s.r, s.q, p.cost from s join dim_product p on s.product_id = p.product_id)
select category, cast(sum(r) as double) total_revenue, cast(sum(r - q * cost) as double) gross_profit,
       case when sum(r) = 0 then 0 else cast(sum(r - q * cost) as double) / cast(sum(r) as double) end * 100
         gross_margin_pct
from j group by category""")
def slicer_filter(spark, sf):
    """Revenue, profit and margin % under each value of the category slicer."""
    st = Star(spark, sf)
    return SC.sliced_measures(st.fact_sales, st.dim_product, ["category"])


# -- one key per measure (projections of the combined measure queries) -------
for _name, _base, _cols in (
        ("m_avg_fulfilment", "m_supplier_measures", ["avg_fulfilment"]),
        ("m_fulfilment_gap_days", "m_supplier_measures", ["fulfilment_gap_days"]),
        ("m_on_time_pct", "m_supplier_measures", ["on_time_pct"]),
        ("m_late_pct", "m_supplier_measures", ["late_pct"]),
        ("m_reorder_alert_count", "m_reorder_alerts", ["reorder_alert_count"]),
        ("m_reorder_alert_pct", "m_reorder_alerts", ["reorder_alert_pct"]),
        ("m_avg_stock_coverage", "m_reorder_alerts", ["avg_stock_coverage"]),
        ("m_days_inventory", "m_inventory_turnover", ["days_inventory_outstanding"]),
        ("m_revenue_ytd", "ytd_mtd_running", ["full_date", "revenue_ytd"]),
        ("m_revenue_mtd", "ytd_mtd_running", ["full_date", "revenue_mtd"]),
        ("ytd_running", "ytd_mtd_running", ["full_date", "revenue", "revenue_ytd"]),
        ("mtd_running", "ytd_mtd_running", ["full_date", "revenue", "revenue_mtd"]),
        ("m_revenue_ly", "self_join_prior_year", ["month", "revenue_ly"]),
        ("m_yoy_growth_pct", "self_join_prior_year", ["month", "yoy_growth_pct"]),
        ("forecast_variance", "forecast_accuracy", ["month_end", "forecast_variance"]),
        ("forecast_accuracy_pct", "forecast_accuracy", ["month_end", "forecast_accuracy_pct"]),
        ("exec_growth_pct", "exec_yoy", ["year", "growth_pct"]),
):
    derive(_name, _base, _cols)
