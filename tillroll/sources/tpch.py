"""Star schema over the driver's TPC-H-like parquet tables.

The retail star schema (dim_product, dim_supplier, dim_warehouse, dim_date,
fact_sales, fact_orders, fact_inventory) is derived from part / supplier /
nation / region / lineitem / orders with plain projections and equi-joins,
so Catalyst prunes columns into the parquet scans and pushes filters down.
Every money column is an exact decimal.

``VIEW_SQL`` holds the same definitions as DuckDB text for the oracle.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import date_spine, dec

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Years that the SQL text of a pivot names as columns (the sale years of the test data).
SQL_YEARS = range(1995, 2002)


class Star:
    """Lazily built star-schema DataFrames for one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    # -- dimensions -------------------------------------------------------
    @cached_property
    def dim_product(self) -> DataFrame:
        p = self.table("part")
        price = F.col("p_retailprice").cast("decimal(12,2)")
        factor = (F.lit(55) + F.col("p_partkey") % 30).cast("decimal(4,0)")
        return p.select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit("Product_"), F.col("p_partkey").cast("string")).alias("product_name"),
            F.col("p_type").alias("category"),
            (price * factor * dec("0.01")).cast("decimal(14,4)").alias("cost"),
            price.alias("price"),
        )

    @cached_property
    def dim_supplier(self) -> DataFrame:
        s, n, r = self.table("supplier"), self.table("nation"), self.table("region")
        return (s.join(n, s.s_nationkey == n.n_nationkey)
                 .join(r, n.n_regionkey == r.r_regionkey)
                 .select(F.col("s_suppkey").alias("supplier_id"),
                         F.col("s_name").alias("supplier_name"),
                         (F.lit(2) + F.col("s_suppkey") % 13).cast("int").alias("lead_time"),
                         F.col("r_name").alias("location")))

    @cached_property
    def dim_warehouse(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_name").alias("warehouse_name"),
            (F.col("r_regionkey") + 1).cast("int").alias("warehouse_id"))

    @cached_property
    def dim_date(self) -> DataFrame:
        """One row per day of the years in which there are sales."""
        return date_spine(self.fact_sales, "sale_date")

    @cached_property
    def years(self) -> list[int]:
        """The years of the calendar; a one-row aggregate is collected."""
        r = self.fact_sales.agg(F.year(F.min("sale_date")).alias("a"), F.year(F.max("sale_date")).alias("b")).first()
        return list(range(r.a, r.b + 1)) if r.a is not None else []

    # -- facts ------------------------------------------------------------
    @cached_property
    def fact_sales(self) -> DataFrame:
        li = self.table("lineitem")
        price = F.col("l_extendedprice").cast("decimal(12,2)")
        disc = F.col("l_discount").cast("decimal(4,2)")
        return li.select(
            (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sale_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("l_shipdate").alias("sale_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
            (price * (F.lit(1) - disc)).cast("decimal(18,4)").alias("revenue"),
        )

    @cached_property
    def fact_orders(self) -> DataFrame:
        li = self.table("lineitem").select("l_orderkey", "l_partkey", "l_shipdate", "l_quantity")
        o = self.table("orders").select("o_orderkey", "o_orderdate")
        # orders is the parent table: at scale both sides are large, so this
        # is a shuffle join on the order key (Catalyst/AQE choose the strategy).
        return li.join(o, li.l_orderkey == o.o_orderkey).select(
            F.col("o_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.to_date("o_orderdate").alias("order_date"),
            F.to_date("l_shipdate").alias("delivery_date"),
            F.col("l_quantity").cast("int").alias("quantity"),
        )

    # -- raw tables: the star with the faults that cleaning looks for -----------
    @cached_property
    def raw_sales(self) -> DataFrame:
        """Sales with missing and unknown products, zero quantities, revenue fifty
        times too high and repeated rows, by remainders of the sale id."""
        k = F.col("sale_id")
        s = self.fact_sales.select(
            "sale_id", F.when(k % 89 == 0, None).when(k % 83 == 0, F.col("product_id") + 10_000_000)
            .otherwise(F.col("product_id")).alias("product_id"), "sale_date",
            F.when(k % 73 == 0, 0).otherwise(F.col("quantity")).alias("quantity"),
            F.when(k % 97 == 0, F.col("revenue") * 50).otherwise(F.col("revenue")).cast("decimal(18,4)").alias("revenue"))
        return s.union(s.where("sale_id % 79 = 0"))

    @cached_property
    def raw_orders(self) -> DataFrame:
        """Orders with missing products and deliveries, odd quantities and repeated rows."""
        k = F.col("order_id")
        o = self.fact_orders.select(
            "order_id", F.when(k % 89 != 0, F.col("product_id")).alias("product_id"), "order_date",
            F.when(k % 71 != 0, F.col("delivery_date")).alias("delivery_date"),
            F.when(k % 97 == 0, F.col("quantity") * 40).otherwise(F.col("quantity")).alias("quantity"))
        return o.union(o.where("order_id % 79 = 0"))

    @cached_property
    def raw_products(self) -> DataFrame:
        """Products with missing costs, odd prices and repeated rows."""
        k = F.col("product_id")
        p = self.dim_product.select(
            "product_id", "product_name", "category", F.when(k % 53 != 0, F.col("cost")).alias("cost"),
            F.when(k % 97 == 0, F.col("price") * 20).otherwise(F.col("price")).cast("decimal(12,2)").alias("price"))
        return p.union(p.where("product_id % 41 = 0"))

    @cached_property
    def raw_suppliers(self) -> DataFrame:
        """Suppliers with lead times ten times too long and repeated rows."""
        s = self.dim_supplier.withColumn("lead_time", F.when(
            F.col("supplier_id") % 7 == 0, F.col("lead_time") * 10).otherwise(F.col("lead_time")))
        return s.union(s.where("supplier_id % 11 = 0"))

    @cached_property
    def raw_inventory(self) -> DataFrame:
        """Stock with negative levels and repeated rows."""
        i = self.inventory.withColumn("stock_level", F.when(
            F.col("product_id") % 31 == 0, -F.col("stock_level")).otherwise(F.col("stock_level")))
        return i.union(i.where("product_id % 37 = 0"))

    @cached_property
    def fact_orders_clean(self) -> DataFrame:
        """fact_orders with the cleaning step's date filter and fulfilment days."""
        from ..operators.clean import fulfilment_days, filter_valid_orders
        return fulfilment_days(filter_valid_orders(self.fact_orders))

    @cached_property
    def fact_inventory(self) -> DataFrame:
        k = F.col("p_partkey")
        return self.table("part").select(
            k.alias("product_id"),
            (k % 5 + 1).cast("int").alias("warehouse_id"),
            ((k * 37) % 1000 + 1).cast("int").alias("stock_level"),
            (F.lit(50) + (k * 53) % 151).cast("int").alias("reorder_level"),
        )

    @cached_property
    def inventory(self) -> DataFrame:
        """Cleaned inventory with the warehouse *name* (the pre-star shape)."""
        w = self.dim_warehouse
        return (self.fact_inventory.join(w, "warehouse_id")
                .select("product_id", F.col("warehouse_name").alias("warehouse"),
                        "stock_level", "reorder_level"))

    @cached_property
    def stock_movements(self) -> DataFrame:
        from ..operators.stock import daily_movements
        return daily_movements(self.fact_sales, self.fact_orders)

    @cached_property
    def stockout_features(self) -> DataFrame:
        from ..operators.stock import stockout_features
        return stockout_features(self.fact_inventory, self.fact_sales, self.fact_orders)


# ---------------------------------------------------------------------------
# DuckDB text of the same views, used by the oracle queries.
VIEW_SQL: dict[str, str] = {
    "dim_product": (
        "select p_partkey product_id, concat('Product_', cast(p_partkey as varchar)) product_name, "
        "p_type category, cast(cast(p_retailprice as decimal(12,2)) * cast(55 + p_partkey % 30 as decimal(4,0)) "
        "* 0.01 as decimal(14,4)) cost, cast(p_retailprice as decimal(12,2)) price from part"),
    "dim_supplier": (
        "select s_suppkey supplier_id, s_name supplier_name, cast(2 + s_suppkey % 13 as int) lead_time, "
        "r_name location from supplier join nation on s_nationkey=n_nationkey "
        "join region on n_regionkey=r_regionkey"),
    "dim_warehouse": "select r_name warehouse_name, cast(r_regionkey + 1 as int) warehouse_id from region",
    "fact_sales": (
        "select l_orderkey*10 + l_linenumber sale_id, l_partkey product_id, cast(l_shipdate as date) sale_date, "
        "cast(l_quantity as int) quantity, cast(cast(l_extendedprice as decimal(12,2)) * "
        "(1 - cast(l_discount as decimal(4,2))) as decimal(18,4)) revenue from lineitem"),
    "fact_orders": (
        "select o_orderkey order_id, l_partkey product_id, cast(o_orderdate as date) order_date, "
        "cast(l_shipdate as date) delivery_date, cast(l_quantity as int) quantity "
        "from lineitem join orders on l_orderkey=o_orderkey"),
    "fact_orders_clean": (
        "select *, cast(datediff('day', order_date, delivery_date) as int) fulfilment_days "
        "from fact_orders where delivery_date >= order_date"),
    "fact_inventory": (
        "select p_partkey product_id, cast(p_partkey % 5 + 1 as int) warehouse_id, "
        "cast((p_partkey*37) % 1000 + 1 as int) stock_level, cast(50 + (p_partkey*53) % 151 as int) reorder_level "
        "from part"),
    "inventory": (
        "select i.product_id, w.warehouse_name warehouse, i.stock_level, i.reorder_level "
        "from fact_inventory i join dim_warehouse w on i.warehouse_id = w.warehouse_id"),
    "raw_sales_once": (
        "select sale_id, case when sale_id % 89 = 0 then null when sale_id % 83 = 0 then product_id + 10000000 "
        "else product_id end product_id, sale_date, case when sale_id % 73 = 0 then 0 else quantity end quantity, "
        "cast(case when sale_id % 97 = 0 then revenue * 50 else revenue end as decimal(18,4)) revenue from fact_sales"),
    "raw_sales": "select * from raw_sales_once union all select * from raw_sales_once where sale_id % 79 = 0",
    "raw_orders_once": (
        "select order_id, case when order_id % 89 <> 0 then product_id end product_id, order_date, "
        "case when order_id % 71 <> 0 then delivery_date end delivery_date, "
        "cast(case when order_id % 97 = 0 then quantity * 40 else quantity end as int) quantity from fact_orders"),
    "raw_orders": "select * from raw_orders_once union all select * from raw_orders_once where order_id % 79 = 0",
    "raw_products_once": (
        "select product_id, product_name, category, case when product_id % 53 <> 0 then cost end cost, "
        "cast(case when product_id % 97 = 0 then price * 20 else price end as decimal(12,2)) price from dim_product"),
    "raw_products": "select * from raw_products_once union all select * from raw_products_once where product_id % 41 = 0",
    "raw_suppliers_once": (
        "select supplier_id, supplier_name, cast(case when supplier_id % 7 = 0 then lead_time * 10 else lead_time end "
        "as int) lead_time, location from dim_supplier"),
    "raw_suppliers": (
        "select * from raw_suppliers_once union all select * from raw_suppliers_once where supplier_id % 11 = 0"),
    "raw_inventory_once": (
        "select product_id, warehouse, case when product_id % 31 = 0 then -stock_level else stock_level end stock_level, "
        "reorder_level from inventory"),
    "raw_inventory": (
        "select * from raw_inventory_once union all select * from raw_inventory_once where product_id % 37 = 0"),
    "stock_movements": (
        "select product_id, cast(d as date) as \"day\", cast(sum(sold) as bigint) sold, cast(sum(arrived) as bigint) arrived from ("
        "select product_id, sale_date d, quantity sold, 0 arrived from fact_sales union all "
        "select product_id, delivery_date + cast(2 + product_id % 13 as int), 0, quantity from fact_orders) "
        "where product_id is not null and d is not null group by 1, 2"),
    "stock_balance": (
        "select *, least(opening, min(balance) over (partition by product_id order by \"day\")) lowest from ("
        "select m.*, opening, opening + sum(arrived - sold) over (partition by m.product_id order by \"day\") balance "
        "from stock_movements m join (select product_id, sum(stock_level) opening from fact_inventory group by 1) o "
        "on m.product_id = o.product_id)"),
    "stockout_features": (
        "select o.product_id, cast(coalesce(arg_max(balance, \"day\") filter (\"day\" <= as_of), any_value(stock)) as bigint) current_stock, "
        "cast(2 + o.product_id % 13 as int) lead_time, "
        "cast(coalesce(sum(sold) filter (\"day\" <= as_of and \"day\" > as_of - 365), 0) as double) / 365.0 avg_daily_demand, "
        "cast(coalesce(bool_or(balance < 0) filter (\"day\" > as_of and \"day\" <= as_of + 180), false) as int) stockout "
        "from (select product_id, sum(stock_level) stock from fact_inventory group by 1) o "
        "cross join (select max(sale_date) - 180 as_of from fact_sales) left join stock_balance b on o.product_id = b.product_id "
        "group by o.product_id"),
    "dim_date": (
        "select cast(d as date) full_date, cast(strftime(d, '%Y%m%d') as int) date_key, "
        "cast(year(d) as int) \"year\", cast(quarter(d) as int) \"quarter\", cast(month(d) as int) \"month\", "
        "strftime(d, '%B') month_name, cast(weekofyear(d) as int) week_of_year, "
        "cast(day(d) as int) day_of_month, strftime(d, '%A') day_name, isodow(d) >= 6 is_weekend "
        "from (select unnest(generate_series(make_timestamp(year(min(sale_date)), 1, 1, 0, 0, 0.0), "
        "make_timestamp(year(max(sale_date)), 12, 31, 0, 0, 0.0), interval 1 day)) d from fact_sales) t"),
}

VIEW_ORDER = ("dim_product", "dim_supplier", "dim_warehouse", "fact_sales", "dim_date", "fact_orders",
              "fact_orders_clean", "fact_inventory", "inventory", "stock_movements", "stock_balance", "stockout_features",
              "raw_sales_once", "raw_sales", "raw_orders_once", "raw_orders", "raw_products_once", "raw_products",
              "raw_suppliers_once", "raw_suppliers", "raw_inventory_once", "raw_inventory")


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the adapter views it references, as CTEs.

    A query that starts with its own ``WITH`` gets the views prepended to
    that list.
    """
    import re
    needed: list[str] = []

    def visit(text: str):
        for name in VIEW_ORDER:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(VIEW_SQL[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEW_SQL[n]})" for n in needed)
    body = sql.strip()
    own = re.match(r"(?is)^with\s+(recursive\s+)?", body)
    if own:
        return f"WITH {own[1] or ''}{ctes},\n{body[own.end():]}"
    return f"WITH {ctes}\n{body}"
