"""Page slicers over the whole model, and the star as SQL views."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import distinct as D
from ..operators import inventory as I
from ..operators import measures as M
from ..operators import sales as S
from ..operators import scorecard as SC
from ..operators import slices as SL
from ..operators import supplier as SU
from ..operators.measures import slice_facts
from ..operators.ordered import with_scalars
from ..sources.tpch import Star
from .registry import query

TABLES = ("dim_product", "dim_supplier", "dim_warehouse", "dim_date", "fact_sales", "fact_orders", "fact_inventory")


class SlicedStar(Star):
    """The star under a category and a warehouse slicer, so that every metric can
    be asked under them: the category reaches each fact through the product, the
    warehouse reaches the facts that carry one (inventory)."""

    def __init__(self, spark: SparkSession, sf_dir: str, category: str | None = None, warehouse: str | None = None):
        super().__init__(spark, sf_dir)
        self.whole, self.category, self.warehouse = Star(spark, sf_dir), category, warehouse

    def _sliced(self, fact: DataFrame) -> DataFrame:
        return slice_facts(fact, self.whole.dim_product, self.category)

    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.whole.dim_product
        return p if self.category is None else p.where(F.col("category") == self.category)

    @cached_property
    def fact_sales(self) -> DataFrame:
        return self._sliced(self.whole.fact_sales)

    @cached_property
    def fact_orders(self) -> DataFrame:
        return self._sliced(self.whole.fact_orders)

    @cached_property
    def fact_inventory(self) -> DataFrame:
        i = self._sliced(self.whole.fact_inventory)
        if self.warehouse is None:
            return i
        ids = self.whole.dim_warehouse.where(F.col("warehouse_name") == self.warehouse).select("warehouse_id")
        return i.join(ids, "warehouse_id", "left_semi").select(*i.columns)


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Register the seven star tables and the three analysis views as temporary
    views of the session, for SQL; their names."""
    star = Star(spark, sf_dir)
    frames = {t: getattr(star, t) for t in TABLES} | {
        "v_sales_enriched": SC.sales_enriched(star.fact_sales, star.dim_product, star.dim_date),
        "v_inventory_alerts": I.inventory_alerts(star.fact_inventory, star.dim_product, star.dim_warehouse, None),
        "v_supplier_performance": SU.v_supplier_performance(star.dim_supplier)}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return list(frames)


@query("slicer_category", """
with p as (select * from dim_product where category = 'PROMO'),
s as (select f.*, p.cost from fact_sales f join p on f.product_id = p.product_id),
i as (select f.* from fact_inventory f join p on f.product_id = p.product_id)
select cast(sum(revenue) as double) total_revenue, cast(sum(revenue - quantity * cost) as double) gross_profit,
       cast(sum(revenue - quantity * cost) as double) / cast(sum(revenue) as double) * 100 gross_margin_pct,
       (select count(distinct product_id) from i) total_skus,
       (select count(*) from i where stock_level <= reorder_level) reorder_alert_count
from s""")
def slicer_category(spark, sf):
    """Sales and stock measures under the category slicer."""
    st = SlicedStar(spark, sf, category="PROMO")
    out = with_scalars(M.total_revenue(st.fact_sales), M.gross_profit(st.fact_sales, st.dim_product))
    out = with_scalars(out, M.gross_margin_pct(st.fact_sales, st.dim_product))
    out = with_scalars(out, M.total_skus(st.fact_inventory))
    return with_scalars(out, M.reorder_alerts(st.fact_inventory).select("reorder_alert_count"))


@query("slicer_warehouse", """
with i as (select f.* from fact_inventory f join dim_warehouse w on f.warehouse_id = w.warehouse_id
           where w.warehouse_name = 'ASIA')
select cast(sum(s.quantity) as bigint) total_units_sold, any_value(a.skus) total_skus, any_value(a.n) reorder_alert_count,
       any_value(a.n) * 100.0::double / any_value(a.skus) reorder_alert_pct
from fact_sales s, (select count(distinct product_id) skus, cast(count_if(stock_level <= reorder_level) as bigint) n from i) a""")
def slicer_warehouse(spark, sf):
    """Stock measures under the warehouse slicer, which sales don't carry."""
    st = SlicedStar(spark, sf, warehouse="ASIA")
    out = with_scalars(S.total_kpis(st.fact_sales).select("total_units_sold"), M.total_skus(st.fact_inventory))
    return with_scalars(out, M.reorder_alerts(st.fact_inventory).select("reorder_alert_count", "reorder_alert_pct"))


@query("slicer_table", """
with s as (select f.*, p.category, p.cost from fact_sales f join dim_product p on f.product_id = p.product_id),
i as (select f.*, p.category, w.warehouse_name from fact_inventory f join dim_product p on f.product_id = p.product_id
      join dim_warehouse w on f.warehouse_id = w.warehouse_id),
sold as (select grouping(category) g, category, count(distinct sale_id) n, sum(quantity) q, sum(revenue) r,
                sum(revenue - quantity * cost) gain from s group by grouping sets ((category), ())),
stock as (select grouping(category) g, grouping(warehouse_name) h, category, warehouse_name, count(distinct product_id) skus,
                 cast(count_if(stock_level <= reorder_level) as bigint) alerts, avg(stock_level) / avg(reorder_level) coverage
          from i group by cube (category, warehouse_name))
select stock.g = 0 category_sliced, h = 0 warehouse_sliced, stock.category, warehouse_name, coalesce(n, 0) transactions,
       cast(q as bigint) units_sold, cast(r as double) total_revenue, cast(gain as double) gross_profit,
       coalesce(cast(gain as double) / nullif(cast(r as double), 0), 0) * 100 gross_margin_pct, skus total_skus,
       alerts reorder_alert_count, alerts * 100.0::double / skus reorder_alert_pct, coverage avg_stock_coverage
from stock left join sold on sold.g = stock.g and sold.category is not distinct from stock.category""")
def slicer_table(spark, sf):
    """All measures under every choice of the category and warehouse slicers, from one pass."""
    st = Star(spark, sf)
    return SL.slicer_table(st.fact_sales, st.dim_product, st.fact_inventory, st.dim_warehouse)


_MONTH_CATEGORY = "from fact_sales s join dim_product p on s.product_id = p.product_id"


@query("distinct_by_slice", f"""
select 'all' slice, null::int "month", null::varchar category, count(distinct sale_id) transactions {_MONTH_CATEGORY}
union all select 'month', cast(month(sale_date) as int), null, count(distinct sale_id) {_MONTH_CATEGORY} group by all
union all select 'category', null, category, count(distinct sale_id) {_MONTH_CATEGORY} group by all""")
def distinct_by_slice(spark, sf):
    """Transactions of all sales, each calendar month and each category from one table of bitmaps."""
    st = Star(spark, sf)
    s = st.fact_sales.join(st.dim_product.select("product_id", "category"), "product_id").withColumn("month", F.month("sale_date"))
    states = D.distinct_states(s, "sale_id", ["month", "category"])
    counts = D.distinct_grouping_sets(states, "transactions", [(), ("month",), ("category",)])
    names = F.array(F.lit("all"), F.lit("month"), F.lit("category"))
    return counts.select(names[F.col("_set")].alias("slice"), "month", "category", "transactions")
