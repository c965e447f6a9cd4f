"""The slicers reach every metric; the star and its views answer SQL."""

from conftest import SF_SMALL

from tillroll.operators import measures as M
from tillroll.plans.slicers import SlicedStar, register_views
from tillroll.sources.tpch import Star


def test_views_answer_sql(spark):
    names = register_views(spark, SF_SMALL)
    assert len(names) == 10
    joined = spark.sql("""select count(*) n, sum(s.revenue) r from fact_sales s join dim_product p using (product_id)
                          join dim_date d on s.sale_date = d.full_date""").first()
    view = spark.sql("select count(*) n, sum(revenue) r from v_sales_enriched").first()
    assert joined.n == view.n > 0 and abs(float(joined.r) - view.r) < 0.01
    alerts = spark.sql("select count(*) n from v_inventory_alerts").first().n
    assert alerts == spark.sql("select count(*) n from fact_inventory where stock_level <= reorder_level").first().n > 0
    assert spark.sql("select count(*) n from v_supplier_performance").first().n > 0


def test_slices_add_up(spark):
    whole = Star(spark, SF_SMALL)
    total = M.total_revenue(whole.fact_sales).first()[0]
    parts = [M.total_revenue(SlicedStar(spark, SF_SMALL, category=r.category).fact_sales).first()[0]
             for r in whole.dim_product.select("category").distinct().collect()]
    assert abs(sum(parts) - total) < 0.01 and all(0 < p < total for p in parts)
    skus = [SlicedStar(spark, SF_SMALL, warehouse=r.warehouse_name).fact_inventory.count()
            for r in whole.dim_warehouse.collect()]
    assert sum(skus) == whole.fact_inventory.count()
    both = SlicedStar(spark, SF_SMALL, "PROMO", "ASIA")
    assert 0 < both.fact_inventory.count() < min(skus)
    assert M.critical_warehouse(both.fact_inventory, both.dim_warehouse).count() == 1
