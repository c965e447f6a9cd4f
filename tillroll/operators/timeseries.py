"""Monthly series, running totals, moving averages and simple forecasts.

Series are first reduced to one row per (series key, month) or per day, so
every window here runs over at most the calendar's months or days per
series.  Windows are partitioned by the series key (``by``); the global
(all-sales) series is one calendar-sized partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import date_spine, safe_divide
from ..session import ensure_checkpoint_dir
from .ordered import with_scalars

# Moving-average window, horizon, band, growth grid and path.
MA_WINDOW = 3
FORECAST_PERIODS = 6
BAND_LOW, BAND_HIGH = 0.9, 1.1
GROWTH_MIN, GROWTH_MAX = 0, 20
COMPOUND_RATE, COMPOUND_STEPS = 0.02, 5
MONTHS_PER_YEAR = 12


def monthly_totals(sales: DataFrame, by: Sequence[str] = (), value: str = "revenue") -> DataFrame:
    """Exact sum per (series, month start) for months present in the data."""
    return (sales.groupBy(*by, F.trunc("sale_date", "month").alias("month"))
                 .agg(F.sum(value).alias("_v")))


def resample_month(sales: DataFrame, by: Sequence[str] = (), value: str = "revenue") -> DataFrame:
    """Month-end series with empty months filled with 0 (pandas ``resample('M')``).

    Every month present is followed by the empty ones up to the next one present,
    so the fact is aggregated once and nothing is joined.  The window sees one
    row per month of a series.
    """
    by = list(by)
    m = monthly_totals(sales, by, value).where(F.col("month").isNotNull())
    after = F.lead("month").over(Window.partitionBy(*by).orderBy("month"))
    until = F.coalesce(F.add_months(after, -1), F.col("month"))
    s = m.withColumn("_each", until).select(*by, "_v", F.col("month").alias("_first"), F.explode(
        F.sequence("month", "_each", F.expr("interval 1 month"))).alias("month"))
    return s.select(*by, F.last_day("month").alias("month_end"),
                    F.when(F.col("month") == F.col("_first"), F.coalesce(F.col("_v"), F.lit(0))).otherwise(F.lit(0))
                    .cast("double").alias(value))


def _w(by: Sequence[str], order: str = "month_end") -> Window:
    return Window.partitionBy(*by).orderBy(order)


def rolling_mean(series: DataFrame, n: int = MA_WINDOW, by: Sequence[str] = (),
                 value: str = "revenue", out: str | None = None, order: str = "month_end") -> DataFrame:
    """n-row rolling mean that stays NULL until n values exist (pandas ``rolling(n)``)."""
    out = out or f"ma{n}"
    w = _w(by, order).rowsBetween(-(n - 1), 0)
    return series.withColumn(out, F.when(F.count(value).over(w) == n, F.avg(value).over(w)))


def mom_ma3(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Month-on-month change and 3-month moving average on the month spine."""
    s = rolling_mean(resample_month(sales, by), MA_WINDOW, by)
    prev = F.lag("revenue", 1).over(_w(by))
    return (s.withColumn("prev_revenue", prev)
             .withColumn("mom_pct", F.round(safe_divide(F.col("revenue") - F.col("prev_revenue"),
                                                        F.col("prev_revenue")) * 100, 2))
             .withColumn("revenue_trend", F.signum(F.col("revenue") - F.col("prev_revenue")).cast("int")))


def forecast_accuracy(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per month: revenue - MA3 and 100 - |error| / revenue * 100."""
    s = rolling_mean(resample_month(sales, by), MA_WINDOW, by)
    err = F.col("revenue") - F.col("ma3")
    return (s.withColumn("forecast_variance", err)
             .withColumn("forecast_accuracy_pct",
                         F.lit(100.0) - safe_divide(F.abs(err), F.col("revenue"), 0) * 100))


def running_totals(sales: DataFrame) -> DataFrame:
    """Revenue YTD and MTD for every calendar day (TOTALYTD / TOTALMTD).

    The days' totals are checkpointed, at most one row a day, and the calendar runs
    over their years; the fact is read once.
    """
    ensure_checkpoint_dir(sales.sparkSession)
    daily = sales.groupBy("sale_date").agg(F.sum("revenue").alias("_r")).checkpoint(eager=True)
    d = (date_spine(daily, "sale_date").select("full_date", "year", "month")
         .join(daily, F.col("full_date") == F.col("sale_date"), "left")
         .select("full_date", "year", "month", F.coalesce("_r", F.lit(0)).alias("_r")))
    ytd = Window.partitionBy("year").orderBy("full_date").rowsBetween(Window.unboundedPreceding, 0)
    mtd = Window.partitionBy("year", "month").orderBy("full_date").rowsBetween(Window.unboundedPreceding, 0)
    return d.select("full_date", F.col("_r").cast("double").alias("revenue"),
                    F.sum("_r").over(ytd).cast("double").alias("revenue_ytd"),
                    F.sum("_r").over(mtd).cast("double").alias("revenue_mtd"))


def revenue_ly(sales: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per month: revenue, same month one year earlier, YoY growth % (0 if no LY).

    The earlier value is the one exactly twelve months before in a RANGE frame over
    month numbers (not ``lag(12)``), so gaps in the data cannot shift the comparison
    and the fact is aggregated once.
    """
    by = list(by)
    m = monthly_totals(sales, by)
    number = F.year("month") * MONTHS_PER_YEAR + F.month("month")
    year_before = Window.partitionBy(*by).orderBy(number).rangeBetween(-MONTHS_PER_YEAR, -MONTHS_PER_YEAR)
    j = m.withColumn("_ly", F.when(F.col("month").isNotNull(), F.max("_v").over(year_before)))
    rev, prev = F.col("_v").cast("double"), F.col("_ly").cast("double")
    return j.select(*by, "month", rev.alias("revenue"), prev.alias("revenue_ly"),
                    (safe_divide(rev - prev, prev, 0) * 100).alias("yoy_growth_pct"))


def exec_yoy(sales: DataFrame) -> DataFrame:
    """Yearly revenue with the previous year's revenue and growth %."""
    y = sales.groupBy(F.year("sale_date").alias("year")).agg(F.sum("revenue").alias("_v"))
    p = y.select((F.col("year") + 1).alias("year"), F.col("_v").alias("_p"))
    j = y.join(p, "year", "left")
    return j.select("year", F.round("_v", 2).cast("double").alias("revenue"),
                    F.round("_p", 2).cast("double").alias("prev_revenue"),
                    F.round(safe_divide(F.col("_v").cast("double") - F.col("_p").cast("double"),
                                        F.col("_p").cast("double")) * 100, 2).alias("growth_pct"))


def _last_ma(sales: DataFrame, n: int, by: Sequence[str]) -> DataFrame:
    """Per series: last month end and the n-month moving average there."""
    s = rolling_mean(resample_month(sales, by), n, by)
    last = s.groupBy(*by).agg(F.max("month_end").alias("last_month_end"))
    j = s.join(last, list(by)) if by else with_scalars(s, last)
    return (j.where(F.col("month_end") == F.col("last_month_end"))
             .select(*by, "last_month_end", F.col(f"ma{n}").alias("base")))


def ma_forecast(sales: DataFrame, window: int = MA_WINDOW, periods: int = FORECAST_PERIODS,
                by: Sequence[str] = (), band: bool = False) -> DataFrame:
    """Last n-month moving average repeated over the next ``periods`` month ends."""
    b = _last_ma(sales, window, by)
    f = b.select(*by, "base", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("step"),
                 "last_month_end")
    f = f.select(*by, "step", F.last_day(F.add_months("last_month_end", F.col("step"))).alias("month_end"),
                 F.col("base").alias("forecast_ma"))
    if band:
        f = f.withColumns({"lower": F.col("forecast_ma") * BAND_LOW, "upper": F.col("forecast_ma") * BAND_HIGH})
    return f


def projected_annual(sales: DataFrame) -> DataFrame:
    b = _last_ma(sales, MA_WINDOW, [])
    return b.select("last_month_end", "base", (F.col("base") * MONTHS_PER_YEAR).alias("projected_annual"))


def scenario_growth(sales: DataFrame, spark_range_end: int = GROWTH_MAX) -> DataFrame:
    """MA3 base x (1 + g/100) for every growth rate g in 0..20 (what-if grid)."""
    b = _last_ma(sales, MA_WINDOW, []).select("base")
    grid = b.sparkSession.range(GROWTH_MIN, spark_range_end + 1).select(F.col("id").cast("int").alias("growth_rate"))
    return with_scalars(grid, b).select(
        "growth_rate", "base", (F.col("base") * (1 + F.col("growth_rate") / 100.0)).alias("adjusted_forecast"))


def scenario_compound(sales: DataFrame, rate: float = COMPOUND_RATE, steps: int = COMPOUND_STEPS) -> DataFrame:
    """MA3 base compounded monthly: base * (1 + rate)^k for k = 0..steps."""
    b = _last_ma(sales, MA_WINDOW, [])
    f = b.select("base", "last_month_end", F.explode(F.sequence(F.lit(0), F.lit(steps))).alias("k"))
    return f.select("k", F.last_day(F.add_months("last_month_end", F.col("k") + 1)).alias("month_end"),
                    (F.col("base") * F.pow(F.lit(1.0 + rate), F.col("k"))).alias("forecast"))


def ma3_base_daily(sales: DataFrame, months: int = MA_WINDOW) -> DataFrame:
    """DAX reading of MA3 Base at month grain: the mean *daily* revenue over
    the dates in (EDATE(month_end, -months), month_end], days without sales
    skipped (AVERAGEX ignores blanks).

    Each day can only fall in the windows of its own month end and the next
    ``months`` month ends, so days are fanned out to those candidates (a
    bounded x(months+1)) and filtered, instead of a range join.
    """
    daily = (sales.groupBy("sale_date").agg(F.sum("revenue").alias("_r"))
             .where(F.col("_r").isNotNull()))
    ends = resample_month(sales).select("month_end")
    cand = daily.select("sale_date", "_r", F.explode(F.sequence(F.lit(0), F.lit(months))).alias("_k"))
    cand = cand.select("sale_date", "_r", F.last_day(F.add_months("sale_date", F.col("_k"))).alias("month_end"))
    inside = (F.col("sale_date") > F.add_months("month_end", -months)) & (F.col("sale_date") <= F.col("month_end"))
    agg = cand.where(inside).groupBy("month_end").agg(F.avg(F.col("_r").cast("double")).alias("ma3_daily"))
    return ends.join(agg, "month_end", "left")
