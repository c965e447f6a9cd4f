"""Supplier and fulfilment queries."""

from __future__ import annotations

from ..operators import clean as C
from ..operators import measures as M
from ..operators import supplier as SU
from ..sources.tpch import Star
from .registry import query

_BY_LOC = """
select location, count(*) total_suppliers, round(avg(lead_time), 2) avg_lead_time,
       cast(sum(lead_time) as bigint) sum_lead_time
from dim_supplier group by location"""


@query("supplier_by_location", _BY_LOC)
def supplier_by_location(spark, sf):
    return SU.supplier_by_location(Star(spark, sf).dim_supplier)


@query("v_supplier_performance", f"""
select *, case when avg_lead_time <= 7 then 1 when avg_lead_time <= 10 then 2 else 3 end lead_time_status
from ({_BY_LOC})""")
def v_supplier_performance(spark, sf):
    return SU.v_supplier_performance(Star(spark, sf).dim_supplier)


@query("row_status_lead_time", """
select supplier_id, supplier_name, lead_time,
       case when lead_time <= 7 then 1 when lead_time <= 10 then 2 else 3 end lead_time_status
from dim_supplier""")
def row_status_lead_time(spark, sf):
    return SU.row_status_lead_time(Star(spark, sf).dim_supplier)


_GM = """(select case when sum(p.rev) = 0 or sum(p.rev) is null then 0 else
        cast(sum(p.rev - p.qty * d.cost) as double) / cast(sum(p.rev) as double) end * 100 gross_margin_pct
     from (select product_id, sum(revenue) rev, sum(quantity) qty from fact_sales group by product_id) p
     left join dim_product d on p.product_id = d.product_id)"""


@query("supplier_scorecard", f"""
select s.location, count(*) total_suppliers, cast(sum(s.lead_time) as bigint) sum_lead_time,
       any_value(g.gross_margin_pct) gross_margin_pct
from dim_supplier s, {_GM} g group by s.location""")
def supplier_scorecard(spark, sf):
    st = Star(spark, sf)
    return SU.supplier_scorecard(st.dim_supplier, M.gross_margin_pct(st.fact_sales, st.dim_product))


@query("cross_unrelated", """
select w.warehouse_name, c.total_suppliers
from dim_warehouse w, (select count(*) total_suppliers from dim_supplier) c""")
def cross_unrelated(spark, sf):
    """Supplier count by warehouse: no relationship, so every row repeats the total."""
    from ..operators.ordered import with_scalars
    from pyspark.sql import functions as F
    st = Star(spark, sf)
    c = st.dim_supplier.agg(F.count(F.lit(1)).alias("total_suppliers"))
    return with_scalars(st.dim_warehouse.select("warehouse_name"), c)


@query("fulfilment_stats", """
select count(fulfilment_days) orders, round(avg(fulfilment_days), 4) mean_days,
       min(fulfilment_days) min_days, max(fulfilment_days) max_days,
       quantile_cont(cast(fulfilment_days as double), 0.25) p25_days,
       quantile_cont(cast(fulfilment_days as double), 0.5) median_days,
       quantile_cont(cast(fulfilment_days as double), 0.75) p75_days
from fact_orders_clean""")
def fulfilment_stats(spark, sf):
    return SU.fulfilment_stats(Star(spark, sf).fact_orders_clean)


@query("delivery_buckets", """
select case when fulfilment_days between 0 and 3 then '0-3' when fulfilment_days between 4 and 7 then '4-7'
            when fulfilment_days between 8 and 10 then '8-10' when fulfilment_days > 10 then '>10' end bucket,
       count(*) orders
from fact_orders_clean group by 1""")
def delivery_buckets(spark, sf):
    return SU.delivery_buckets(Star(spark, sf).fact_orders_clean)


@query("mean_delivery_time", """
select avg(datediff('day', order_date, delivery_date)) mean_delivery_days from fact_orders""")
def mean_delivery_time(spark, sf):
    return SU.mean_delivery_time(Star(spark, sf).fact_orders)


@query("profile_histogram", """
with d as (select cast(datediff('day', order_date, delivery_date) as int) x from fact_orders),
     m as (select cast(min(x) as double) mn, cast(max(x) as double) mx from d),
     b as (select cast(case when mx = mn then 0 else least(floor((x - mn) / ((mx - mn) / 20)), 19) end as int) bin,
                  mn, mx from d, m where x is not null)
select bin, mn + bin * ((mx - mn) / 20) lower, mn + (bin + 1) * ((mx - mn) / 20) upper, count(*) "count"
from b group by bin, mn, mx""")
def profile_histogram(spark, sf):
    return SU.delivery_histogram(Star(spark, sf).fact_orders)


@query("fulfilment_days", """
select order_id, product_id, order_date, delivery_date, quantity,
       cast(datediff('day', order_date, delivery_date) as int) fulfilment_days from fact_orders""")
def fulfilment_days(spark, sf):
    return C.fulfilment_days(Star(spark, sf).fact_orders)


@query("filter_valid_orders", """
select * from fact_orders where delivery_date >= order_date""")
def filter_valid_orders(spark, sf):
    return C.filter_valid_orders(Star(spark, sf).fact_orders)


@query("long_lead_flag", """
select supplier_id, supplier_name, lead_time, location, coalesce(lead_time > 30, false) long_lead_flag
from raw_suppliers""")
def long_lead_flag(spark, sf):
    return C.long_lead_flag(Star(spark, sf).raw_suppliers)
