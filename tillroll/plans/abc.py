"""ABC segmentation, dense rank and contribution queries."""

from __future__ import annotations

from ..operators import abc as A
from ..sources.tpch import Star
from .registry import query


@query("abc_sql", """
with totals as (select product_id, round(sum(revenue), 2) earned from fact_sales group by product_id),
known as (select product_id, product_name, category, earned, (select sum(earned) from totals semi join dim_product using (product_id)) everything
          from totals join dim_product using (product_id)),
-- what all lesser products earn together is still to come after this one
share as (select *, round(cast(everything - coalesce(sum(earned) over (order by earned, product_id desc
                                  rows between unbounded preceding and 1 preceding), 0) as double)
                          / cast(everything as double) * 100, 2) reached from known)
select product_id, product_name, category, cast(earned as double) total_revenue, reached cumulative_pct,
       if(reached > 95, 'C — Long Tail', if(reached > 80, 'B — Core', 'A — Star')) abc_segment
from share""")
def abc_sql(spark, sf):
    st = Star(spark, sf)
    return A.abc_sql(st.fact_sales, st.dim_product)


@query("abc_classification", """
with items as (select u.product_id, u.annual_demand, d.cost unit_cost
               from (select product_id, sum(quantity) annual_demand from fact_sales group by product_id) u
               join dim_product d on u.product_id = d.product_id),
v as (select *, annual_demand * unit_cost annual_value from items),
c as (select *, cast(sum(annual_value) over (order by annual_value desc, product_id
                     rows between unbounded preceding and current row) as double)
                / cast(sum(annual_value) over () as double) * 100 cumulative_percentage from v)
select product_id, cast(annual_demand as bigint) annual_demand, cast(unit_cost as double) unit_cost,
       cast(annual_value as double) annual_value, cumulative_percentage,
       case when cumulative_percentage <= 80 then 'A' when cumulative_percentage <= 95 then 'B' else 'C' end abc_class
from c""")
def abc_classification(spark, sf):
    st = Star(spark, sf)
    return A.abc_classification(A.abc_items(st.fact_sales, st.dim_product))


@query("dense_rank_products", """
with r as (select d.product_name, sum(s.revenue) revenue from fact_sales s
           join dim_product d on s.product_id = d.product_id group by d.product_name)
select product_name, cast(revenue as double) revenue,
       cast(dense_rank() over (order by revenue desc) as int) revenue_rank
from r""")
def dense_rank_products(spark, sf):
    st = Star(spark, sf)
    return A.dense_rank_products(st.fact_sales, st.dim_product)


@query("revenue_contribution_pct", """
with r as (select s.product_id, d.product_name, sum(s.revenue) rev from fact_sales s
           join dim_product d on s.product_id = d.product_id group by s.product_id, d.product_name)
select product_id, product_name, cast(rev as double) revenue,
       case when sum(rev) over () = 0 then 0 else cast(rev as double) / cast(sum(rev) over () as double) end * 100
         contribution_pct
from r""")
def revenue_contribution_pct(spark, sf):
    st = Star(spark, sf)
    return A.revenue_contribution_pct(st.fact_sales, st.dim_product)
