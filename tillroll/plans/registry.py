"""Registry of named queries: a Spark callable and, where one exists, the
equivalent DuckDB SQL over the same parquet tables (the correctness oracle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..sources.tpch import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name``.

    ``sql`` may reference the star-schema views (dim_product, fact_sales,
    ...); their definitions are prefixed as CTEs.
    """
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = with_views(sql)
        return fn
    return deco


def derive(name: str, base: str, cols: list[str], doc: str = "") -> None:
    """Register ``name`` as a column projection of an existing query (same
    plan, fewer columns); its oracle SQL projects the base query's SQL."""
    base_fn = QUERIES[base]

    def fn(spark: SparkSession, sf: str) -> DataFrame:
        return base_fn(spark, sf).select(*cols)

    fn.__doc__ = doc or f"{name}: columns {cols} of {base}"
    fn.__name__ = name
    if name in QUERIES:
        raise ValueError(f"duplicate query {name}")
    QUERIES[name] = fn
    if base in ORACLE_SQL:
        quoted = ", ".join(f'"{c}"' for c in cols)
        ORACLE_SQL[name] = f"select {quoted} from ({ORACLE_SQL[base]}) _base"
