"""Product-level RFM features and k-means segmentation.

Features are one grouped aggregate per product, written once with their means and
deviations; all restarts of all cluster numbers are fitted in common passes (see
``kmeans``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .kmeans import Points, best_fits, fit_many, nearest, silhouettes, standardise
from .ordered import with_scalars

# Segment labels (best first by mean monetary), k, seed, restarts.
SEGMENT_LABELS = ("Champions", "Loyal", "At-Risk", "Churned")
N_CLUSTERS = 4
SEED = 42
N_INIT = 10
MAX_K = 8
FEATURES = ("recency", "frequency", "monetary")


def rfm_features(sales: DataFrame) -> DataFrame:
    """recency = days from the product's last sale to the last sale overall,
    frequency = number of sales, monetary = revenue sum."""
    # pandas groupby: NULL product ids are not grouped; an all-missing sum is 0
    per = sales.where(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.max("sale_date").alias("_last"), F.count("sale_id").alias("frequency"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("double").alias("monetary"))
    today = sales.agg(F.max("sale_date").alias("_today"))
    return with_scalars(per, today).select(
        "product_id", F.datediff("_today", "_last").alias("recency"), "frequency", "monetary")


def given_centres(k: int) -> list[list[float]]:
    """``k`` fixed centres in z-scores, from long ago and little to lately and much."""
    at = [3.0 * (j + 0.5) / k - 1.5 for j in range(k)]
    return [[-t, t, t] for t in at]


def _fit(sales: DataFrame, ks, n_init: int) -> tuple[Points, dict[int, list[list[float]]]]:
    points = standardise(rfm_features(sales), FEATURES)
    runs = [(k, s) for k in ks for s in range(SEED, SEED + n_init)]
    return points, {k: f.centres.tolist() for k, f in best_fits(fit_many(points, "product_id", runs)).items()}


def rfm_segment(sales: DataFrame, product: DataFrame, k: int = N_CLUSTERS, n_init: int = N_INIT) -> DataFrame:
    """Segment every product; labels follow descending mean monetary value.

    Clusters beyond the number of labels get a NULL label, products without a
    recency a NULL segment.
    """
    points, centres = _fit(sales, [k], n_init)
    return labelled(points, centres.get(k, [[0.0] * len(FEATURES)]), product)


def rfm_segment_given(sales: DataFrame, product: DataFrame, k: int = N_CLUSTERS) -> DataFrame:
    """``rfm_segment`` with ``given_centres`` instead of fitted ones."""
    return labelled(standardise(rfm_features(sales), FEATURES), given_centres(k), product)


def labelled(points: Points, centres, product: DataFrame) -> DataFrame:
    """The products of ``points`` with segment, label by mean monetary value, name and category."""
    seg = points.frame.withColumn("segment", nearest(points.names, centres))
    means = seg.where(F.col("segment").isNotNull()).groupBy("segment").agg(F.avg("monetary").alias("_m"))
    # k rows (one per cluster): rank clusters by mean monetary value
    order = means.select("segment", F.row_number().over(
        Window.orderBy(F.col("_m").desc(), "segment")).alias("_r"))
    labels = F.array(*[F.lit(v) for v in SEGMENT_LABELS])
    lab = order.select("segment", F.when(F.col("_r") <= len(SEGMENT_LABELS),
                                         labels[F.col("_r") - 1]).alias("segment_label"))
    out = (seg.join(F.broadcast(lab), "segment", "left")
           .join(product.select("product_id", "product_name", "category"), "product_id"))
    return out.select("product_id", "recency", "frequency", "monetary", "segment", "segment_label",
                      "product_name", "category")


def rfm_segment_means(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment_label").agg(*[F.round(F.avg(c), 2).alias(c) for c in FEATURES])


def _silhouette_rows(sales: DataFrame, points: Points, centres: dict) -> DataFrame:
    rows = sorted(silhouettes(points, centres).items()) if centres else []
    return sales.sparkSession.createDataFrame(rows, "k int, silhouette double")


def rfm_silhouette(sales: DataFrame, max_k: int = MAX_K, n_init: int = N_INIT) -> DataFrame:
    """Silhouette (squared Euclidean) of the best k-means for k = 2..max_k."""
    points, centres = _fit(sales, range(2, max_k + 1), n_init)
    return _silhouette_rows(sales, points, centres)


def rfm_silhouette_given(sales: DataFrame, max_k: int = MAX_K) -> DataFrame:
    """Silhouette of ``given_centres`` for k = 2..max_k."""
    points = standardise(rfm_features(sales), FEATURES)
    return _silhouette_rows(sales, points, {k: given_centres(k) for k in range(2, max_k + 1)})
