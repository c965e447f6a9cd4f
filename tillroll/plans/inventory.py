"""Inventory queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clean as C
from ..operators import inventory as I
from ..sources.tpch import Star
from .registry import query


@query("warehouse_stock", """
select warehouse, cast(coalesce(sum(stock_level), 0) as bigint) stock_level from inventory
where warehouse is not null group by warehouse""")
def warehouse_stock(spark, sf):
    return I.warehouse_stock(Star(spark, sf).inventory)


@query("warehouse_stock_vs_reorder", """
select warehouse, cast(sum(stock_level) as bigint) total_stock, cast(sum(reorder_level) as bigint) total_reorder
from inventory group by warehouse""")
def warehouse_stock_vs_reorder(spark, sf):
    return I.warehouse_stock_vs_reorder(Star(spark, sf).inventory)


@query("inventory_detail", """
select warehouse, product_id, cast(sum(stock_level) as bigint) stock_level,
       round(case when avg(reorder_level) = 0 or avg(reorder_level) is null then 0
                  else avg(stock_level) / avg(reorder_level) end, 2) coverage_ratio
from inventory group by warehouse, product_id""")
def inventory_detail(spark, sf):
    return I.inventory_detail(Star(spark, sf).inventory)


@query("reorder_alerts_by_warehouse", """
with by_id as (select warehouse_id, count(*) filter (stock_level <= reorder_level) alerts, sum(stock_level) stock,
                      count(stock_level) stocked, sum(reorder_level) wanted, count(reorder_level) levels
               from fact_inventory group by warehouse_id)
select warehouse_name, cast(sum(alerts) as bigint) alert_count,
       round((sum(stock) / sum(stocked)) / (sum(wanted) / sum(levels)), 2) coverage_ratio
from by_id join dim_warehouse using (warehouse_id) group by warehouse_name""")
def reorder_alerts_by_warehouse(spark, sf):
    st = Star(spark, sf)
    return I.reorder_alerts_by_warehouse(st.fact_inventory, st.dim_warehouse)


_DEFICITS = """
with gap as (select product_id, warehouse_id, stock_level, reorder_level, reorder_level - stock_level deficit
             from fact_inventory)
select (select product_name from dim_product d where d.product_id = gap.product_id) product_name,
       (select category from dim_product d where d.product_id = gap.product_id) category,
       (select warehouse_name from dim_warehouse h where h.warehouse_id = gap.warehouse_id) warehouse_name,
       stock_level, reorder_level, deficit
from gap"""
_ALERTS = _DEFICITS + " where deficit >= 0"


@query("inventory_alerts", _ALERTS + " order by deficit desc, product_id, warehouse_id limit 20")
def inventory_alerts(spark, sf):
    st = Star(spark, sf)
    return I.inventory_alerts(st.fact_inventory, st.dim_product, st.dim_warehouse, 20)


@query("v_inventory_alerts", _ALERTS)
def v_inventory_alerts(spark, sf):
    st = Star(spark, sf)
    return I.inventory_alerts(st.fact_inventory, st.dim_product, st.dim_warehouse, None)


@query("join_three_way", _DEFICITS)
def join_three_way(spark, sf):
    st = Star(spark, sf)
    j = (st.fact_inventory.join(st.dim_product.select("product_id", "product_name", "category"), "product_id")
         .join(st.dim_warehouse, "warehouse_id"))
    return j.select("product_name", "category", "warehouse_name", "stock_level", "reorder_level",
                    (F.col("reorder_level") - F.col("stock_level")).alias("deficit"))


@query("join_inventory_product", """
select i.product_id, i.warehouse, i.stock_level, i.reorder_level, p.product_name, p.category,
       cast(p.cost as double) cost, cast(p.price as double) price
from inventory i join dim_product p on i.product_id = p.product_id""")
def join_inventory_product(spark, sf):
    st = Star(spark, sf)
    j = st.inventory.join(st.dim_product, "product_id")
    return j.select("product_id", "warehouse", "stock_level", "reorder_level", "product_name", "category",
                    F.col("cost").cast("double").alias("cost"), F.col("price").cast("double").alias("price"))


@query("join_inventory_warehouse", """
select i.product_id, i.warehouse, w.warehouse_id, i.stock_level, i.reorder_level
from inventory i join dim_warehouse w on i.warehouse = w.warehouse_name""")
def join_inventory_warehouse(spark, sf):
    """Join on differently named keys (warehouse = warehouse_name)."""
    st = Star(spark, sf)
    i, w = st.inventory, st.dim_warehouse
    j = i.join(w, i.warehouse == w.warehouse_name)
    return j.select("product_id", "warehouse", "warehouse_id", "stock_level", "reorder_level")


@query("low_stock", """
select product_id, warehouse, stock_level, reorder_level from inventory where stock_level < reorder_level""")
def low_stock(spark, sf):
    return C.low_stock(Star(spark, sf).inventory)


@query("reorder_trigger", """
select product_id, warehouse, stock_level, reorder_level from inventory where stock_level <= 1.2 * reorder_level""")
def reorder_trigger(spark, sf):
    return C.reorder_trigger(Star(spark, sf).inventory)


@query("needs_reorder", """
select product_id, warehouse, stock_level, reorder_level, coalesce(stock_level <= reorder_level, false) needs_reorder
from inventory""")
def needs_reorder(spark, sf):
    return C.needs_reorder(Star(spark, sf).inventory)


@query("overstocked", """
select product_id, warehouse_id, stock_level, reorder_level from fact_inventory where stock_level > 3 * reorder_level""")
def overstocked(spark, sf):
    return I.overstocked(Star(spark, sf).fact_inventory)


@query("warehouse_overview", """
select w.warehouse_id, w.warehouse_name, count(distinct i.product_id) skus,
       cast(sum(i.stock_level) as bigint) total_stock, cast(sum(i.reorder_level) as bigint) total_reorder,
       cast(sum(case when i.stock_level <= i.reorder_level then 1 else 0 end) as bigint) alerts,
       round(avg(i.stock_level) / avg(i.reorder_level), 2) coverage_ratio
from fact_inventory i join dim_warehouse w on i.warehouse_id = w.warehouse_id
group by w.warehouse_id, w.warehouse_name""")
def warehouse_overview(spark, sf):
    st = Star(spark, sf)
    return I.warehouse_overview(st.fact_inventory, st.dim_warehouse)


@query("turnover_ratio", """
with u as (select product_id, sum(quantity) units from fact_sales group by product_id),
     s as (select product_id, sum(stock_level) stock from fact_inventory group by product_id)
select s.product_id, cast(coalesce(u.units, 0) as bigint) units_sold, cast(s.stock as bigint) stock,
       case when s.stock = 0 then null else cast(coalesce(u.units, 0) as double) / cast(s.stock as double) end turnover
from s left join u on s.product_id = u.product_id""")
def turnover_ratio(spark, sf):
    st = Star(spark, sf)
    return I.turnover_ratio(st.fact_sales, st.fact_inventory)


@query("dead_stock", """
with l as (select product_id, max(sale_date) last_sale from fact_sales group by product_id),
     c as (select max(sale_date) - interval 90 day cutoff from fact_sales)
select i.product_id, i.warehouse_id, i.stock_level, l.last_sale
from fact_inventory i left join l on i.product_id = l.product_id, c
where i.stock_level > 0 and (l.last_sale is null or l.last_sale < cast(c.cutoff as date))""")
def dead_stock(spark, sf):
    st = Star(spark, sf)
    return I.dead_stock(st.fact_sales, st.fact_inventory)


@query("distinct_warehouses", """
select warehouse_name, cast(dense_rank() over (order by warehouse_name nulls last) as int) warehouse_id
from (select distinct warehouse warehouse_name from inventory)""")
def distinct_warehouses(spark, sf):
    return I.distinct_warehouses(Star(spark, sf).inventory)


@query("row_status_reorder", """
select product_id, warehouse_id, max(stock_level) stock_level, max(reorder_level) reorder_level,
       case when max(stock_level) <= max(reorder_level) then 3 else 1 end reorder_status
from fact_inventory group by product_id, warehouse_id""")
def row_status_reorder(spark, sf):
    return I.row_status_reorder(Star(spark, sf).fact_inventory)


@query("cross_analysis", """
with r as (select product_id, sum(revenue) rev from fact_sales group by product_id)
select p.category, w.warehouse_name, count(distinct i.product_id) skus, cast(sum(i.stock_level) as bigint) total_stock,
       cast(round(coalesce(sum(r.rev), 0), 2) as double) revenue
from fact_inventory i join dim_product p on i.product_id = p.product_id
join dim_warehouse w on i.warehouse_id = w.warehouse_id
left join r on i.product_id = r.product_id
group by p.category, w.warehouse_name""")
def cross_analysis(spark, sf):
    st = Star(spark, sf)
    return I.cross_category_warehouse(st.fact_sales, st.dim_product, st.fact_inventory, st.dim_warehouse)


@query("clip_lower", """
select product_id, warehouse_id, case when stock_level - reorder_level is null then null
       else greatest(stock_level - reorder_level, 0) end available
from fact_inventory""")
def clip_lower(spark, sf):
    """Units above the reorder level, clipped at zero (stock clean-up rule)."""
    inv = Star(spark, sf).fact_inventory.select(
        "product_id", "warehouse_id", (F.col("stock_level") - F.col("reorder_level")).alias("available"))
    return C.clip_lower(inv, "available", 0)
