"""Table profiling: head, shape, info, nulls, duplicates, describe,
correlation, box statistics and table row counts.

Per-column statistics are computed in one aggregate over all columns, and
quantiles for several columns in one grouped pass over an unpivoted
``(column, value)`` frame, so each profile scans its table once or twice.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ordered import exact_quantiles, top_k, with_scalars

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")
IQR_FACTOR = 1.5


def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    return top_k(df, n, [F.col(key).asc()])


def shape(tables: Mapping[str, DataFrame]) -> DataFrame:
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(
        F.lit(name).alias("table_name"), "rows", F.lit(len(df.columns)).alias("columns"))
        for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    return shape(tables).select("table_name", F.col("rows").alias("row_count"))


def _unpivot_counts(df: DataFrame, agg_for, value_name: str) -> DataFrame:
    cols = df.columns
    one = df.agg(*[agg_for(c).alias(c) for c in cols])
    return one.unpivot([], cols, "column_name", value_name)


def info(df: DataFrame) -> DataFrame:
    """Column, non-null count, Spark type (``DataFrame.info``)."""
    counts = _unpivot_counts(df, lambda c: F.count(F.col(c)), "non_null")
    types = df.sparkSession.createDataFrame(df.dtypes, "column_name string, dtype string")
    return counts.join(F.broadcast(types), "column_name")  # one row per column


def nulls(df: DataFrame) -> DataFrame:
    return _unpivot_counts(df, lambda c: F.count_if(F.col(c).isNull()), "nulls")


def duplicates(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier identical row (NULLs compare equal)."""
    g = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return g.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def _long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    return d.unpivot([], list(cols), "column_name", "value")


def describe(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """count, mean, std (sample), min, 25/50/75 % (exact, linear), max per column."""
    cols = list(cols or [c for c, t in df.dtypes if t in NUMERIC or t.startswith("decimal")])
    long = _long(df, cols)
    stats = long.groupBy("column_name").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"), F.max("value").alias("max"))
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], by=["column_name"], names=["p25", "p50", "p75"])
    return stats.join(q, "column_name", "left").select(
        "column_name", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def correlation(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson matrix in long form (col_a, col_b, corr), both triangles."""
    cols = list(cols)
    d = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    one = d.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    long = one.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "corr")
    ab = long.select(F.split("pair", r"\|").getItem(0).alias("col_a"),
                     F.split("pair", r"\|").getItem(1).alias("col_b"), "corr")
    mirrored = ab.where(F.col("col_a") != F.col("col_b")).select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "corr")
    return ab.unionByName(mirrored)


def boxstats(df: DataFrame, col: str, factor: float = IQR_FACTOR) -> DataFrame:
    """Quartiles, whiskers (furthest values inside the fences) and outlier count."""
    q = exact_quantiles(df, col, [0.25, 0.5, 0.75], names=["q1", "median", "q3"])
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = with_scalars(df.select(F.col(col).cast("double").alias("_x")).where(F.col("_x").isNotNull()), q)
    lo = F.col("q1") - factor * F.col("iqr")
    hi = F.col("q3") + factor * F.col("iqr")
    inside = (F.col("_x") >= lo) & (F.col("_x") <= hi)
    return j.groupBy("q1", "median", "q3", "iqr").agg(
        F.min(F.when(inside, F.col("_x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("_x"))).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"))
