"""Time-series, running-total, prior-year and forecast queries."""

from __future__ import annotations

from ..operators import timeseries as T
from ..sources.tpch import Star
from .registry import query

_SPINE = """
m as (select cast(date_trunc('month', sale_date) as date) "month", sum(revenue) v from fact_sales group by 1),
span as (select min("month") a, max("month") b from m),
spine as (select cast(unnest(generate_series(a, b, interval 1 month)) as date) "month" from span),
series as (select last_day(spine."month") month_end, cast(coalesce(m.v, 0) as double) revenue
           from spine left join m on spine."month" = m."month")"""

_MA3 = """case when count(revenue) over (order by month_end rows between 2 preceding and current row) = 3
     then avg(revenue) over (order by month_end rows between 2 preceding and current row) end"""


@query("resample_month", f"with {_SPINE} select * from series")
def resample_month(spark, sf):
    return T.resample_month(Star(spark, sf).fact_sales)


@query("rolling_mean", f"with {_SPINE} select *, {_MA3} ma3 from series")
def rolling_mean(spark, sf):
    return T.rolling_mean(T.resample_month(Star(spark, sf).fact_sales), 3)


@query("ma3_base", f"with {_SPINE} select *, {_MA3} ma3 from series")
def ma3_base(spark, sf):
    """MA3 Base at month grain: mean of the last three months' revenue."""
    return T.rolling_mean(T.resample_month(Star(spark, sf).fact_sales), T.MA_WINDOW)


@query("mom_ma3", f"""
with {_SPINE}, s as (select *, {_MA3} ma3, lag(revenue) over (order by month_end) prev_revenue from series)
select month_end, revenue, ma3, prev_revenue,
       round((revenue - prev_revenue) / nullif(prev_revenue, 0) * 100, 2) mom_pct,
       cast(sign(revenue - prev_revenue) as int) revenue_trend
from s""")
def mom_ma3(spark, sf):
    return T.mom_ma3(Star(spark, sf).fact_sales)


@query("revenue_trend", f"""
with {_SPINE}
select month_end, revenue, cast(sign(revenue - lag(revenue) over (order by month_end)) as int) revenue_trend
from series""")
def revenue_trend(spark, sf):
    return T.mom_ma3(Star(spark, sf).fact_sales).select("month_end", "revenue", "revenue_trend")


@query("forecast_accuracy", f"""
with {_SPINE}, s as (select *, {_MA3} ma3 from series)
select *, revenue - ma3 forecast_variance,
       100.0 - case when revenue = 0 or revenue is null then 0 else abs(revenue - ma3) / revenue end * 100
         forecast_accuracy_pct
from s""")
def forecast_accuracy(spark, sf):
    """Forecast Variance and Forecast Accuracy % per month."""
    return T.forecast_accuracy(Star(spark, sf).fact_sales)


@query("ytd_mtd_running", """
with d as (select sale_date, sum(revenue) r from fact_sales group by sale_date),
     c as (select dd.full_date, dd.year, dd.month, coalesce(d.r, 0) r
           from dim_date dd left join d on dd.full_date = d.sale_date)
select full_date, cast(r as double) revenue,
       cast(sum(r) over (partition by year order by full_date rows between unbounded preceding and current row)
            as double) revenue_ytd,
       cast(sum(r) over (partition by year, month order by full_date
                         rows between unbounded preceding and current row) as double) revenue_mtd
from c""")
def ytd_mtd_running(spark, sf):
    """Revenue YTD / MTD for every calendar day."""
    return T.running_totals(Star(spark, sf).fact_sales)


_LY = """
with m as (select cast(date_trunc('month', sale_date) as date) "month", sum(revenue) v from fact_sales group by 1)
select a."month", cast(a.v as double) revenue, cast(b.v as double) revenue_ly,
       case when b.v = 0 or b.v is null then 0 else (cast(a.v as double) - cast(b.v as double)) / cast(b.v as double)
       end * 100 yoy_growth_pct
from m a left join m b on b."month" + interval 12 month = a."month" """


@query("self_join_prior_year", _LY)
def self_join_prior_year(spark, sf):
    """Revenue LY and YoY Growth % per month from the month exactly twelve before."""
    return T.revenue_ly(Star(spark, sf).fact_sales)


@query("exec_yoy", """
with y as (select cast(year(sale_date) as int) "year", sum(revenue) v from fact_sales group by 1)
select a."year", cast(round(a.v, 2) as double) revenue, cast(round(b.v, 2) as double) prev_revenue,
       round((cast(a.v as double) - cast(b.v as double)) / nullif(cast(b.v as double), 0) * 100, 2) growth_pct
from y a left join y b on b."year" + 1 = a."year" """)
def exec_yoy(spark, sf):
    """Year totals with the previous year and growth %."""
    return T.exec_yoy(Star(spark, sf).fact_sales)


_LAST = f"""
with {_SPINE}, s as (select *, {_MA3} ma3 from series),
last as (select month_end last_month_end, ma3 base from s where month_end = (select max(month_end) from s))"""


@query("ma_forecast", f"""{_LAST}
select step, last_day(last_month_end + to_months(step)) month_end, base forecast_ma
from last, (select cast(unnest(generate_series(1, 6)) as int) step)""")
def ma_forecast(spark, sf):
    return T.ma_forecast(Star(spark, sf).fact_sales, 3, 6)


@query("ma_forecast_band", f"""{_LAST}
select step, last_day(last_month_end + to_months(step)) month_end, base forecast_ma,
       base * 0.9 lower, base * 1.1 upper
from last, (select cast(unnest(generate_series(1, 6)) as int) step)""")
def ma_forecast_band(spark, sf):
    return T.ma_forecast(Star(spark, sf).fact_sales, 3, 6, band=True)


@query("m_projected_annual", f"{_LAST} select last_month_end, base, base * 12 projected_annual from last")
def m_projected_annual(spark, sf):
    return T.projected_annual(Star(spark, sf).fact_sales)


@query("scenario_growth", f"""{_LAST}
select cast(g as int) growth_rate, base, base * (1 + cast(g as int) / 100.0) adjusted_forecast
from last, (select unnest(generate_series(0, 20)) g)""")
def scenario_growth(spark, sf):
    return T.scenario_growth(Star(spark, sf).fact_sales)


@query("scenario_compound", f"""{_LAST}
select cast(k as int) k, last_day(last_month_end + to_months(cast(k as int) + 1)) month_end,
       base * pow(1.02, k) forecast
from last, (select unnest(generate_series(0, 5)) k)""")
def scenario_compound(spark, sf):
    return T.scenario_compound(Star(spark, sf).fact_sales)


@query("ma3_base_daily", f"""
with {_SPINE},
d as (select sale_date, sum(revenue) r from fact_sales group by sale_date having sum(revenue) is not null)
select s.month_end,
       (select avg(cast(d.r as double)) from d where d.sale_date > s.month_end - interval 3 month
          and d.sale_date <= s.month_end) ma3_daily
from series s""")
def ma3_base_daily(spark, sf):
    """MA3 Base read as in the dashboard measure: mean daily revenue over the
    three months ending at each month end."""
    return T.ma3_base_daily(Star(spark, sf).fact_sales)
