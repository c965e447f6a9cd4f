"""Anomaly detection on a numeric column: z-score and IQR fences.

Statistics are one-row aggregates (mean / sample std, or exact quartiles)
broadcast back to the rows; with ``by`` they are per group and joined on
the group key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .clean import iqr_fences
from .ordered import null_safe_join, with_scalars

# Z threshold and method labels.
Z_THRESHOLD = 3.0
METHOD_Z = "Z-Score"
METHOD_IQR = "IQR"


def _attach(df: DataFrame, stats: DataFrame, by: Sequence[str]) -> DataFrame:
    return null_safe_join(df, stats, list(by), "left") if by else with_scalars(df, stats)


def zscores(df: DataFrame, col: str = "revenue", by: Sequence[str] = ()) -> DataFrame:
    x = F.col(col).cast("double")
    stats = df.groupBy(*by).agg(F.avg(x).alias("_mean"), F.stddev_samp(x).alias("_std"))
    j = _attach(df, stats, by)
    return j.withColumn("z_score", (x - F.col("_mean")) / F.col("_std")).drop("_mean", "_std")


def detect_zscore(df: DataFrame, col: str = "revenue", threshold: float = Z_THRESHOLD,
                  by: Sequence[str] = ()) -> DataFrame:
    return (zscores(df, col, by).where(F.abs("z_score") > threshold)
            .withColumn("method", F.lit(METHOD_Z)))


def detect_iqr(df: DataFrame, col: str = "revenue", by: Sequence[str] = ()) -> DataFrame:
    f = iqr_fences(df, col, by).select(*by, F.col("low").alias("_lo"), F.col("high").alias("_hi"))
    x = F.col(col).cast("double")
    return (_attach(df, f, by).where((x < F.col("_lo")) | (x > F.col("_hi")))
            .drop("_lo", "_hi").withColumn("method", F.lit(METHOD_IQR)))


def label_anomalies(df: DataFrame, col: str = "revenue", threshold: float = Z_THRESHOLD,
                    key: str = "sale_id") -> DataFrame:
    """Every row tagged anomaly/normal.  A row is an anomaly when its key belongs
    to any z-score anomaly (keys need not be unique; a row without a key is normal).

    One pass gives each row's z-score; rows of one key meet in a window on the
    key, no join of the fact with itself."""
    hit = F.coalesce((F.abs("z_score") > threshold) & F.col(key).isNotNull(), F.lit(False))
    spread = F.when(F.col(key).isNull(), F.xxhash64(*df.columns))  # rows without a key don't meet in one task
    z = zscores(df, col).withColumn("_hit", F.max(hit).over(Window.partitionBy(key, spread)))
    return z.withColumn("label", F.when(F.col("_hit"), "anomaly").otherwise("normal")).drop("_hit", "z_score")


def normal_rows(df: DataFrame, col: str = "revenue", threshold: float = Z_THRESHOLD,
                key: str = "sale_id") -> DataFrame:
    """Rows whose key is not among the z-score anomalies."""
    return label_anomalies(df, col, threshold, key).where(F.col("label") == "normal").drop("label")


def anomaly_union(df: DataFrame, col: str = "revenue") -> DataFrame:
    z = detect_zscore(df, col).drop("z_score")
    return z.unionByName(detect_iqr(df, col))


def anomaly_rate(df: DataFrame, col: str = "revenue", threshold: float = Z_THRESHOLD) -> DataFrame:
    """Number of z-score anomalies and their percent of all rows, one pass."""
    z = zscores(df, col)
    hit = F.abs("z_score") > threshold
    return z.agg(F.count_if(hit).alias("anomalies"),
                 (F.count_if(hit) / F.count(F.lit(1)) * 100).alias("anomaly_pct"))
