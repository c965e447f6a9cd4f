"""Co-purchase recommender: products ordered on the same date.

Only pairs inside the ``top_n`` most-ordered products are ever used, so the
top-N cut is applied *before* pairing: the top products are counted once and
checkpointed (``top_n`` rows), the orders meet them in a broadcast semi join, and the
pair counts, at most top_n*(top_n-1)/2 rows, are checkpointed too.  Each date then
holds at most ``top_n`` distinct products after the (date, product) dedup, so the
same-date self join emits at most top_n*(top_n-1)/2 pairs per date however skewed
the dates are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..session import ensure_checkpoint_dir
from .ordered import top_k

# Matrix size and number of recommendations.
TOP_PRODUCTS = 50
TOP_RECOMMENDATIONS = 5


def value_counts(orders: DataFrame, key: str = "product_id") -> DataFrame:
    """Rows per key; NULL keys are not counted (pandas ``value_counts``)."""
    return orders.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("count"))


def top_products(orders: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """The ``n`` most frequent product ids (ties: lower id first)."""
    return top_k(value_counts(orders), n, [F.col("count").desc(), F.col("product_id").asc()])


def _top(orders: DataFrame, n: int) -> DataFrame:
    """The ``n`` top products (product_id, count), checkpointed: ``n`` rows that every later
    step reads instead of counting the orders again."""
    ensure_checkpoint_dir(orders.sparkSession)
    return top_products(orders, n).checkpoint(eager=True)


def top_product_dates(orders: DataFrame, n: int = TOP_PRODUCTS, top: DataFrame | None = None) -> DataFrame:
    """Distinct (order_date, product_id) of the top-n products: a semi join with ``n`` broadcast rows."""
    top = _top(orders, n) if top is None else top
    return orders.select("order_date", "product_id").join(F.broadcast(top), "product_id", "left_semi").select(
        "order_date", "product_id").distinct()


def pairs(orders: DataFrame, n: int = TOP_PRODUCTS, top: DataFrame | None = None) -> DataFrame:
    """Unordered same-date pairs (a < b) among the top-n products."""
    d = top_product_dates(orders, n, top)
    a, b = d.alias("a"), d.alias("b")
    return a.join(b, (F.col("a.order_date") == F.col("b.order_date")) &
                  (F.col("a.product_id") < F.col("b.product_id"))).select(
        F.col("a.order_date").alias("order_date"), F.col("a.product_id").alias("product_a"),
        F.col("b.product_id").alias("product_b"))


def cooccurrence_counts(orders: DataFrame, n: int = TOP_PRODUCTS, top: DataFrame | None = None) -> DataFrame:
    """(a, b, number of shared order dates) for a < b."""
    return pairs(orders, n, top).groupBy("product_a", "product_b").agg(F.count(F.lit(1)).alias("cnt"))


def _counted(orders: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """The top products and their pair counts, both checkpointed (``n`` and n (n - 1) / 2 rows)."""
    top = _top(orders, n)
    return top, cooccurrence_counts(orders, n, top).checkpoint(eager=True)


def _both_ways(c: DataFrame) -> DataFrame:
    return c.unionByName(c.select(F.col("product_b").alias("product_a"), F.col("product_a").alias("product_b"), "cnt"))


def similarity_matrix(orders: DataFrame, n: int = TOP_PRODUCTS, dense: bool = False, measure: str = "count") -> DataFrame:
    """Symmetric similarity matrix of the top-n products.

    ``measure`` is "count" (shared order dates, column cnt) or "cosine" (shared dates
    over the root of the product of both products' dates, column similarity).  Long
    sparse form with both orientations; ``dense=True`` pivots to one column per
    product with zeros filled (n columns).
    """
    if measure not in ("count", "cosine"):
        raise ValueError(measure)
    top, c = _counted(orders, n)
    m, value = _both_ways(c), "cnt"
    if measure == "cosine":
        days = top_product_dates(orders, n, top).groupBy("product_id").agg(F.count(F.lit(1)).alias("_d"))
        days = F.broadcast(days.checkpoint(eager=True))                                      # n rows
        m = (m.join(days.select(F.col("product_id").alias("product_a"), F.col("_d").alias("_da")), "product_a")
              .join(days.select(F.col("product_id").alias("product_b"), F.col("_d").alias("_db")), "product_b"))
        value = "similarity"
        m = m.select("product_a", "product_b", (F.col("cnt") / F.sqrt(F.col("_da").cast("double") * F.col("_db"))).alias(value))
    if not dense:
        return m
    ids = [r.product_id for r in top.collect()]                                              # n rows
    full = top.select(F.col("product_id").alias("product_a")).join(m, "product_a", "left")
    return full.groupBy("product_a").pivot("product_b", sorted(ids)).agg(F.first(value)).na.fill(0)


def recommend_all(orders: DataFrame, n: int = TOP_PRODUCTS, k: int = TOP_RECOMMENDATIONS) -> DataFrame:
    """Top-k partners of every top-n product by co-occurrence (ties: lower id).

    Every top product is listed with every other, those without a common date with
    score 0, so zero counts fill up short lists in id order.  That is n (n - 1) rows
    from the checkpointed counts, whatever the number of orders.  Products outside
    the top-n get no rows.
    """
    top, c = _counted(orders, n)
    one = top.select(F.col("product_id"))
    every = one.join(F.broadcast(top.select(F.col("product_id").alias("partner_id"))), F.col("product_id") != F.col("partner_id"))
    scored = every.join(F.broadcast(_both_ways(c)), (F.col("product_id") == F.col("product_a")) & (F.col("partner_id") == F.col("product_b")),
                        "left").select("product_id", "partner_id", F.coalesce("cnt", F.lit(0)).cast("bigint").alias("score"))
    order = Window.partitionBy("product_id").orderBy(F.col("score").desc(), F.col("partner_id").asc())
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "product_id", "rank", "partner_id", "score")


def recommend(orders: DataFrame, product_id: int, n: int = TOP_PRODUCTS, k: int = TOP_RECOMMENDATIONS) -> DataFrame:
    """Recommendations for one product (no rows when it is not in the top-n)."""
    return recommend_all(orders, n, k).where(F.col("product_id") == product_id)
