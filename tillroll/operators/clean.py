"""Cleaning operators: typed coercion, dedup, imputation, outlier capping, flags.

Each operator is DataFrame -> DataFrame and composes with ``df.transform``.
Statistics (medians, IQR fences) come from ``exact_quantiles``, so a whole column
never lands in one task; those of whole columns are one row, used as literals.
pandas null semantics are kept where the cleaning step relies on them:
comparisons against NULL are False, clipping keeps NULL, NaN becomes NULL.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import clip, null_false, safe_divide, standardize_columns, str_title
from ..session import scratch_path
from ..sources.files import sink_csv_counted
from .ordered import exact_quantiles, null_safe_join, quantile_table

# Fixed values of the cleaning step.
LONG_LEAD_DAYS = 30
IQR_FACTOR = 1.5
REORDER_TRIGGER_FACTOR = 1.2
# Date texts, tried in this order; the first has no shorter texts than itself.
ISO_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")


# -- generic steps -----------------------------------------------------------
def drop_duplicates(df: DataFrame) -> DataFrame:
    """Exact row dedup (NULLs compare equal, as in pandas)."""
    return df.dropDuplicates()


def deduplicated(df: DataFrame, typed: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, dict[str, int]]:
    """Exact row dedup, written once: the distinct rows, and rows_before and rows_after.
    ``typed`` coerces and filters the distinct rows (they are counted before it) in the same
    job, so no pass over the written table parses texts again.

    Both counts come from the writing job, after the shuffle (copies are counted map-side
    and summed), so they cost no scan of their own and a task that runs again after a
    lost executor counts once.  What follows reads the written table, column by column.
    """
    watch, path = Observation(), scratch_path(df.sparkSession, "distinct-rows")
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__n"))
    rows = counted.observe(watch, F.coalesce(F.sum("__n"), F.lit(0)).alias("rows_before"),
                           F.count(F.lit(1)).alias("rows_after")).drop("__n")
    rows = typed(rows) if typed else rows
    rows.write.parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path), watch.get


def coerce_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Strict integer cast: a bad value raises (ANSI cast), like ``astype(int)``."""
    return df.withColumns({c: F.col(c).cast("bigint") for c in cols})


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``to_numeric(errors='coerce')``: bad text -> NULL, NaN -> NULL."""
    out = {}
    for c in cols:
        x = F.col(c).try_cast("double") if dict(df.dtypes)[c] == "string" else F.col(c).cast("double")
        out[c] = F.when(~F.isnan(x), x)
    return df.withColumns(out)


def parse_dates(df: DataFrame, cols: Sequence[str], formats: Sequence[str] = ()) -> DataFrame:
    """``to_datetime(errors='coerce')`` -> DATE; unparsable text becomes NULL.

    String columns are tried against ``formats`` in order (ISO when empty; a text too
    short to hold a time of day is tried as a date only, as failing costs most);
    columns that already hold dates or timestamps are truncated to the day.
    """
    types = dict(df.dtypes)
    out = {}
    for c in cols:
        if types[c] == "string":
            tried = [F.try_to_timestamp(F.col(c), F.lit(f)) for f in list(formats) or ISO_FORMATS]
            if not formats:
                tried[0] = F.when(F.length(c) >= len(ISO_FORMATS[0]), tried[0])
            out[c] = F.to_date(F.coalesce(*tried))
        else:
            out[c] = F.to_date(F.col(c))
    return df.withColumns(out)


def _one_row(df: DataFrame, cols: Sequence[str], probs: Sequence[float], names: Sequence[str]) -> dict[str, Column]:
    """Exact quantiles of whole columns as literals, by ``{column}__{name}``: one row that is
    worked out once, so that what uses it is a plain projection."""
    row = quantile_table(df, cols, probs, names).first()
    keys = [f"{c}__{n}" for c in cols for n in names]
    return {k: F.lit(row[k] if row else None).cast("double") for k in keys}


def impute_median(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Fill NULLs of each column with that column's exact median (one pass)."""
    cols, types = list(cols), dict(df.dtypes)
    meds = _one_row(df, cols, [0.5], ["med"])
    return df.withColumns({c: F.coalesce(F.col(c), meds[f"{c}__med"].cast(types[c])) for c in cols})


def iqr_fences(df: DataFrame, col: str, by: Sequence[str] = (), factor: float = IQR_FACTOR) -> DataFrame:
    """One row per group: q1, q3, low = q1 - f*IQR, high = q3 + f*IQR."""
    q = exact_quantiles(df, col, [0.25, 0.75], by=by, names=["q1", "q3"])
    iqr = F.col("q3") - F.col("q1")
    return q.withColumns({"low": F.col("q1") - factor * iqr, "high": F.col("q3") + factor * iqr})


def cap_outliers(df: DataFrame, cols: str | Sequence[str], by: Sequence[str] = (),
                 factor: float = IQR_FACTOR) -> DataFrame:
    """Winsorise each column to its IQR fences (per group with ``by``);
    NULL stays NULL.  Several columns share one quantile pass; fences come
    from the uncapped values of each column, so capping one column never
    moves another column's fences."""
    cols = [cols] if isinstance(cols, str) else list(cols)
    by = list(by)
    names = [f"{c}__{n}" for c in cols for n in ("q1", "q3")]
    if by:
        q = quantile_table(df, cols, [0.25, 0.75], ["q1", "q3"], by=by)
        j, fence = null_safe_join(df, q, by, "left"), {n: F.col(n) for n in names}
    else:
        j, fence = df, _one_row(df, cols, [0.25, 0.75], ["q1", "q3"])
    out = {}
    for c in cols:
        q1, q3 = fence[f"{c}__q1"], fence[f"{c}__q3"]
        out[c] = clip(F.col(c).cast("double"), q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return j.withColumns(out).drop(*names)


def clip_lower(df: DataFrame, col: str, lower=0) -> DataFrame:
    return df.withColumn(col, clip(col, lower=lower))


# -- derived columns and filters -------------------------------------------------
def margin_cols(df: DataFrame) -> DataFrame:
    """margin = price - cost; margin_pct = round(margin / price * 100, 2)."""
    m = F.col("price").cast("double") - F.col("cost").cast("double")
    return (df.withColumn("margin", m)
              .withColumn("margin_pct", F.round(safe_divide(F.col("margin"), F.col("price").cast("double")) * 100, 2)))


def needs_reorder(df: DataFrame) -> DataFrame:
    return df.withColumn("needs_reorder", null_false(F.col("stock_level") <= F.col("reorder_level")))


def low_stock(df: DataFrame) -> DataFrame:
    """Rows strictly below their reorder level (the notebook's test)."""
    return df.where(F.col("stock_level") < F.col("reorder_level"))


def reorder_trigger(df: DataFrame, factor: float = REORDER_TRIGGER_FACTOR) -> DataFrame:
    """Rows at or below ``factor`` x reorder level (purchase-order trigger)."""
    return df.where(F.col("stock_level") <= F.lit(factor) * F.col("reorder_level"))


def long_lead_flag(df: DataFrame, days: int = LONG_LEAD_DAYS) -> DataFrame:
    return df.withColumn("long_lead_flag", null_false(F.col("lead_time") > days))


def fulfilment_days(df: DataFrame) -> DataFrame:
    """Whole days from order to delivery (inputs are dates)."""
    return df.withColumn("fulfilment_days", F.datediff("delivery_date", "order_date"))


def filter_valid_orders(df: DataFrame) -> DataFrame:
    """Keep orders delivered on or after the order date (NULL dates drop)."""
    return df.where(F.col("delivery_date") >= F.col("order_date"))


def filter_positive_sales(df: DataFrame) -> DataFrame:
    return df.where((F.col("revenue") > 0) & (F.col("quantity") > 0))


def unit_price(df: DataFrame) -> DataFrame:
    return df.withColumn("unit_price", safe_divide(F.col("revenue").cast("double"), F.col("quantity").cast("double")))


def sale_date_parts(df: DataFrame, date_col: str = "sale_date") -> DataFrame:
    d = F.col(date_col)
    return df.withColumns({"year": F.year(d), "month": F.month(d),
                           "quarter": F.quarter(d), "week": F.weekofyear(d)})


def title_case(df: DataFrame, cols: Sequence[str], acronyms: Sequence[str] = ()) -> DataFrame:
    return df.withColumns({c: str_title(c, acronyms) for c in cols})


# -- composed table cleaners -----------------------------------------------------
# Each has two steps: the typed and filtered rows, then what is derived from them.  Tables
# whose columns get medians or fences are written once in between, after the dedup: the
# passes over them then read single typed columns, not the raw table's shuffle again.
def clean_products(raw: DataFrame) -> DataFrame:
    return _products(deduplicated(standardize_columns(raw), _typed_products)[0])


def _typed_products(df: DataFrame) -> DataFrame:
    return coerce_numeric(coerce_int(df, ["product_id"]), ["cost", "price"])


def _products(df: DataFrame) -> DataFrame:
    df = impute_median(df, ["cost", "price"])
    df = title_case(margin_cols(df), ["category"])
    return cap_outliers(df, ["cost", "price"])


def clean_suppliers(raw: DataFrame) -> DataFrame:
    return _suppliers(_typed_suppliers(drop_duplicates(standardize_columns(raw))))


def _typed_suppliers(df: DataFrame) -> DataFrame:
    return coerce_numeric(coerce_int(df, ["supplier_id"]), ["lead_time"])


def _suppliers(df: DataFrame) -> DataFrame:
    return long_lead_flag(title_case(df, ["location"]))


def clean_inventory(raw: DataFrame) -> DataFrame:
    return _inventory(_typed_inventory(drop_duplicates(standardize_columns(raw))))


def _typed_inventory(df: DataFrame) -> DataFrame:
    return coerce_numeric(coerce_int(df, ["product_id"]), ["stock_level", "reorder_level"])


def _inventory(df: DataFrame) -> DataFrame:
    return needs_reorder(clip_lower(df, "stock_level", 0))


def clean_orders(raw: DataFrame) -> DataFrame:
    return _orders(deduplicated(standardize_columns(raw), _typed_orders)[0])


def _typed_orders(df: DataFrame) -> DataFrame:
    df = coerce_numeric(coerce_int(df, ["order_id"]), ["quantity"])
    return filter_valid_orders(parse_dates(df, ["order_date", "delivery_date"]))


def _orders(df: DataFrame) -> DataFrame:
    return cap_outliers(fulfilment_days(df), "quantity")


def clean_sales(raw: DataFrame) -> DataFrame:
    return _sales(deduplicated(standardize_columns(raw), _typed_sales)[0])


def _typed_sales(df: DataFrame) -> DataFrame:
    df = coerce_numeric(coerce_int(df, ["sale_id"]), ["quantity", "revenue"])
    return filter_positive_sales(parse_dates(df, ["sale_date"]))


def _sales(df: DataFrame) -> DataFrame:
    return cap_outliers(unit_price(sale_date_parts(df)), "revenue")


# table: its typed rows, and what is derived from them
CLEANERS = {"products": (_typed_products, _products), "suppliers": (_typed_suppliers, _suppliers),
            "inventory": (_typed_inventory, _inventory), "orders": (_typed_orders, _orders), "sales": (_typed_sales, _sales)}


def clean_all(raws: Mapping[str, DataFrame], root: str) -> tuple[dict[str, str], list[tuple[str, int, int, int]]]:
    """Clean raw tables and write each as CSV below ``root`` (``<table>_clean.csv``): the
    paths, and for each table its rows before and after the dedup and rows written,
    all counted by the jobs that did the work."""
    paths, report = {}, []
    for name, raw in raws.items():
        typed, derived = CLEANERS[name]
        rows, seen = deduplicated(standardize_columns(raw), typed)
        paths[name] = f"{root}/{name}_clean.csv"
        written = sink_csv_counted(derived(rows), paths[name])
        report.append((name, seen["rows_before"], seen["rows_after"], written))
    return paths, report


def orphans(fact: DataFrame, products: DataFrame, key: str = "product_id") -> DataFrame:
    """Fact rows whose product is unknown (NULL keys count as orphans)."""
    known = products.select(key).where(F.col(key).isNotNull()).distinct()
    return fact.join(known, fact[key].eqNullSafe(known[key]), "left_anti")
