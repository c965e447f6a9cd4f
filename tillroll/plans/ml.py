"""Anomaly, recommender, RFM, classifier and forecast queries, plus the
joins, top-k and group operators they are built from."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import anomaly as AN
from ..operators import classify as CL
from ..operators import forecast as FC
from ..operators import recommend as R
from ..operators import segment as SG
from ..operators import stock as ST
from ..operators.ordered import top_k
from ..sources.tpch import Star
from .registry import query

# -- anomalies (revenue of raw_sales) -----------------------------------------
_Z = """with st as (select avg(cast(revenue as double)) m, stddev_samp(cast(revenue as double)) sd from raw_sales),
z as (select s.*, (cast(s.revenue as double) - st.m) / st.sd z_score from raw_sales s, st)"""
_IQR = """with q as (select quantile_cont(cast(revenue as double), 0.25) q1,
                  quantile_cont(cast(revenue as double), 0.75) q3 from raw_sales)"""


@query("detect_zscore", f"{_Z} select *, 'Z-Score' method from z where abs(z_score) > 3")
def detect_zscore(spark, sf):
    return AN.detect_zscore(Star(spark, sf).raw_sales)


@query("detect_iqr", f"""{_IQR}
select s.*, 'IQR' method from raw_sales s, q
where cast(s.revenue as double) < q1 - 1.5 * (q3 - q1) or cast(s.revenue as double) > q3 + 1.5 * (q3 - q1)""")
def detect_iqr(spark, sf):
    return AN.detect_iqr(Star(spark, sf).raw_sales)


@query("detect_zscore_by_category", """
with s as (select f.*, p.category from fact_sales f join dim_product p on f.product_id = p.product_id),
st as (select category, avg(cast(revenue as double)) m, stddev_samp(cast(revenue as double)) sd from s
       group by category),
z as (select s.*, (cast(s.revenue as double) - st.m) / st.sd z_score from s left join st on s.category = st.category)
select *, 'Z-Score' method from z where abs(z_score) > 3""")
def detect_zscore_by_category(spark, sf):
    """Z-score anomalies against each category's own mean and std."""
    st = Star(spark, sf)
    s = st.fact_sales.join(st.dim_product.select("product_id", "category"), "product_id")
    return AN.detect_zscore(s, by=["category"])


@query("anomaly_union", f"""{_Z}, q as (select quantile_cont(cast(revenue as double), 0.25) q1,
                  quantile_cont(cast(revenue as double), 0.75) q3 from raw_sales)
select sale_id, product_id, sale_date, quantity, revenue, 'Z-Score' method from z where abs(z_score) > 3
union all
select s.*, 'IQR' method from raw_sales s, q
where cast(s.revenue as double) < q1 - 1.5 * (q3 - q1) or cast(s.revenue as double) > q3 + 1.5 * (q3 - q1)""")
def anomaly_union(spark, sf):
    return AN.anomaly_union(Star(spark, sf).raw_sales)


@query("label_anomalies", f"""{_Z}, a as (select distinct sale_id from z where abs(z_score) > 3)
select s.*, case when a.sale_id is not null then 'anomaly' else 'normal' end label
from raw_sales s left join a on s.sale_id = a.sale_id""")
def label_anomalies(spark, sf):
    return AN.label_anomalies(Star(spark, sf).raw_sales)


@query("anti_normal", f"""{_Z}
select s.* from raw_sales s where s.sale_id not in (select sale_id from z where abs(z_score) > 3)""")
def anti_normal(spark, sf):
    """Sales that are not anomalies (anti join on sale_id)."""
    return AN.normal_rows(Star(spark, sf).raw_sales)


@query("anomaly_rate", f"""{_Z}
select cast(count_if(abs(z_score) > 3) as bigint) anomalies, cast(count_if(abs(z_score) > 3) as double) / count(*) * 100 anomaly_pct
from z""")
def anomaly_rate(spark, sf):
    return AN.anomaly_rate(Star(spark, sf).raw_sales)


# -- recommender (clean orders) ---------------------------------------------------
_TOP50 = """top as (select product_id, count(*) c from fact_orders_clean where product_id is not null group by 1
             order by c desc, product_id limit 50),
pd as (select distinct order_date, product_id from fact_orders_clean where product_id in (select product_id from top)),
pairs as (select a.order_date, a.product_id product_a, b.product_id product_b from pd a join pd b
          on a.order_date = b.order_date and a.product_id < b.product_id),
cooc as (select product_a, product_b, count(*) cnt from pairs group by 1, 2)"""


@query("value_counts", 'select product_id, count(*) "count" from fact_orders_clean where product_id is not null '
       'group by 1')
def value_counts(spark, sf):
    return R.value_counts(Star(spark, sf).fact_orders_clean)


@query("top50_products", f'with {_TOP50} select product_id, c "count" from top')
def top50_products(spark, sf):
    return R.top_products(Star(spark, sf).fact_orders_clean, 50)


@query("semi_top_products", f"with {_TOP50} select * from pd")
def semi_top_products(spark, sf):
    """(date, product) rows of the top-50 products: a semi join on the id list (an `isin` filter)."""
    return R.top_product_dates(Star(spark, sf).fact_orders_clean, 50)


@query("self_join_pairs", f"with {_TOP50} select * from pairs")
def self_join_pairs(spark, sf):
    return R.pairs(Star(spark, sf).fact_orders_clean, 50)


@query("cooccurrence_counts", f"with {_TOP50} select * from cooc")
def cooccurrence_counts(spark, sf):
    return R.cooccurrence_counts(Star(spark, sf).fact_orders_clean, 50)


@query("similarity_matrix", f"""with {_TOP50}
select product_a, product_b, cnt from cooc union all select product_b, product_a, cnt from cooc""")
def similarity_matrix(spark, sf):
    return R.similarity_matrix(Star(spark, sf).fact_orders_clean, 50)


@query("similarity_cosine", f"""with {_TOP50}, days as (select product_id, count(*) n from pd group by 1),
sim as (select product_a, product_b, cnt / sqrt(cast(a.n as double) * b.n) similarity from cooc
        join days a on a.product_id = product_a join days b on b.product_id = product_b)
select product_a, product_b, similarity from sim union all select product_b, product_a, similarity from sim""")
def similarity_cosine(spark, sf):
    """Cosine similarity of the top products' order dates."""
    return R.similarity_matrix(Star(spark, sf).fact_orders_clean, 50, measure="cosine")


@query("recommend", f"""with {_TOP50},
sym as (select product_a, product_b, cnt from cooc union all select product_b, product_a, cnt from cooc),
cand as (select t1.product_id, t2.product_id partner_id, coalesce(s.cnt, 0) score
         from top t1 join top t2 on t1.product_id <> t2.product_id
         left join sym s on s.product_a = t1.product_id and s.product_b = t2.product_id),
r as (select *, row_number() over (partition by product_id order by score desc, partner_id) rk from cand)
select product_id, cast(rk as int) "rank", partner_id, cast(score as bigint) score from r where rk <= 5""")
def recommend(spark, sf):
    """Top-5 co-purchase partners of every top-50 product (batch form)."""
    return R.recommend_all(Star(spark, sf).fact_orders_clean, 50, 5)


# -- RFM ------------------------------------------------------------------------
_RFM = """rfm as (select product_id,
       cast(datediff('day', max(sale_date), (select max(sale_date) from fact_sales)) as int) recency,
       count(sale_id) frequency, cast(coalesce(sum(revenue), 0) as double) monetary from fact_sales
       where product_id is not null group by product_id)"""


@query("rfm_features", f"with {_RFM} select * from rfm")
def rfm_features(spark, sf):
    return SG.rfm_features(Star(spark, sf).fact_sales)


@query("join_rfm_product", f"""with {_RFM}
select r.*, p.product_name, p.category from rfm r join dim_product p on r.product_id = p.product_id""")
def join_rfm_product(spark, sf):
    st = Star(spark, sf)
    return SG.rfm_features(st.fact_sales).join(
        st.dim_product.select("product_id", "product_name", "category"), "product_id")


@query("rfm_segment")
def rfm_segment(spark, sf):
    st = Star(spark, sf)
    return SG.rfm_segment(st.fact_sales, st.dim_product)


@query("rfm_segment_means")
def rfm_segment_means(spark, sf):
    st = Star(spark, sf)
    return SG.rfm_segment_means(SG.rfm_segment(st.fact_sales, st.dim_product))


@query("rfm_silhouette")
def rfm_silhouette(spark, sf):
    return SG.rfm_silhouette(Star(spark, sf).fact_sales)


def _assigned(k: int) -> str:
    """SQL: nearest of the given centres for the z-scores of every product."""
    centres = ", ".join(f"({j}, {a!r}, {b!r}, {c!r})" for j, (a, b, c) in enumerate(SG.given_centres(k)))
    return f"""
z as (select product_id, recency, frequency, monetary, (recency - avg(recency) over ()) / stddev_samp(recency) over () a,
      (frequency - avg(frequency) over ()) / stddev_samp(frequency) over () b,
      (monetary - avg(monetary) over ()) / stddev_samp(monetary) over () c from rfm),
centre{k}(j, ca, cb, cc) as (values {centres}),
seg{k} as (select z.*, j segment from z, centre{k}
          qualify row_number() over (partition by product_id
                  order by (a - ca) * (a - ca) + (b - cb) * (b - cb) + (c - cc) * (c - cc), j) = 1)"""


@query("rfm_segment_given", f"""with {_RFM}, {_assigned(SG.N_CLUSTERS)},
m as (select segment, row_number() over (order by avg(monetary) desc, segment) r from seg{SG.N_CLUSTERS} group by segment)
select s.product_id, s.recency, s.frequency, s.monetary, s.segment,
       case r when 1 then 'Champions' when 2 then 'Loyal' when 3 then 'At-Risk' when 4 then 'Churned' end segment_label,
       p.product_name, p.category
from seg{SG.N_CLUSTERS} s join m on s.segment = m.segment join dim_product p on s.product_id = p.product_id""")
def rfm_segment_given(spark, sf):
    """Segments for fixed centres: assignment, labels and joins of ``rfm_segment``."""
    st = Star(spark, sf)
    return SG.rfm_segment_given(st.fact_sales, st.dim_product)


def _silhouette_sql(k: int) -> str:
    """SQL: mean silhouette for ``k`` given centres, by all squared distances to cluster sums."""
    return f"""select {k} k, avg(case when n < 2 or other is null then 0 else (other - own) / greatest(own, other) end) silhouette
from (select x.product_id, max(case when y.segment = x.segment then y.n end) n,
        max(case when y.segment = x.segment and y.n > 1 then (y.n * sq + y.ss - 2 * (x.a * y.sa + x.b * y.sb + x.c * y.sc)) / (y.n - 1) end) own,
        min(case when y.segment <> x.segment then (y.n * sq + y.ss - 2 * (x.a * y.sa + x.b * y.sb + x.c * y.sc)) / y.n end) other
      from (select *, a * a + b * b + c * c sq from seg{k}) x,
           (select segment, count(*) n, sum(a) sa, sum(b) sb, sum(c) sc, sum(a * a + b * b + c * c) ss from seg{k} group by segment) y
      group by x.product_id)"""


_ALL_K = range(2, SG.MAX_K + 1)


@query("rfm_silhouette_given", f"""with {_RFM}, {_assigned(2)}, """ + ", ".join(
    _assigned(k)[_assigned(k).index(f"centre{k}"):] for k in _ALL_K if k > 2) + "\n" + "\nunion all\n".join(map(_silhouette_sql, _ALL_K)))
def rfm_silhouette_given(spark, sf):
    """Silhouettes of fixed centres, k = 2..8: the figures of ``rfm_silhouette`` for centres known in advance."""
    return SG.rfm_silhouette_given(Star(spark, sf).fact_sales)


# -- stock-out classifier ----------------------------------------------------------
@query("stock_balance", """
select product_id, "day", sold, arrived, cast(balance as bigint) balance, cast(lowest as bigint) lowest from stock_balance""")
def stock_balance(spark, sf):
    """Running balance and lowest balance so far of each product, by day with movements."""
    st = Star(spark, sf)
    return ST.stock_balance(st.fact_inventory, st.stock_movements)


@query("stockout_features", "select * from stockout_features")
def stockout_features(spark, sf):
    """Features as of a date and the stock-out observed in the days after it."""
    return Star(spark, sf).stockout_features


@query("stockout_train_test_split", f"""
select *, case when (((product_id % 1073741824) * {CL.HASH_FACTOR} + {CL.SEED * CL.HASH_STEP}) % 4294967296) / 4294967296.0
               < {CL.TEST_FRACTION} then 'test' else 'train' end split
from stockout_features""")
def stockout_train_test_split(spark, sf):
    return CL.train_test_split(Star(spark, sf).stockout_features, "product_id")


@query("stockout_forest")
def stockout_forest(spark, sf):
    """Train/test sizes and test accuracy of the random forest."""
    return CL.stockout_report(Star(spark, sf).stockout_features)


# -- per-series forecasts ------------------------------------------------------------
def _by_category(st: Star):
    return st.fact_sales.join(st.dim_product.select("product_id", "category"), "product_id")


@query("arima_forecast")
def arima_forecast(spark, sf):
    """ARIMA(1,1,1) mean and 95 % interval, 6 months, one model per category."""
    return FC.series_forecast(_by_category(Star(spark, sf)), ["category"], "arima")


_GIVEN = (0.4, -0.3)


@query("arima_given", f"""
with recursive m as (
  select p.category, cast(date_trunc('month', sale_date) as date) "month", sum(revenue) v
  from fact_sales s join dim_product p on s.product_id = p.product_id group by 1, 2),
spine as (select category, cast(unnest(generate_series(min("month"), max("month"), interval 1 month)) as date) "month"
          from m group by 1),
y as (select category, "month", cast(coalesce(v, 0) as double) y, row_number() over (partition by category order by "month") t
      from spine left join m using (category, "month")),
d as (select category, t - 1 t, "month", y, y - lag(y) over w d from y window w as (partition by category order by t) qualify t > 1),
-- innovations, one after the other
a as (select category, 1::bigint t, d, 0.0::double e from d where t = 1
      union all select d.category, d.t, d.d, d.d - {_GIVEN[0]} * a.d - ({_GIVEN[1]}) * a.e
      from a join d on d.category = a.category and d.t = a.t + 1),
ends as (select category, arg_max(d, t) d, arg_max(e, t) e, sum(e * e) / (count(*) - 1) s2 from a group by category),
last as (select category, arg_max(y, t) y, max("month") "month" from d group by category),
h as (select unnest(range(1, {FC.PERIODS + 1})) step),
psi as (select step, 1 + ({_GIVEN[0]} + ({_GIVEN[1]})) * coalesce(list_sum(list_transform(range(0, step - 1), lambda j: pow({_GIVEN[0]}, j))), 0) total from h),
f as (select category, step, last_day(cast("month" + to_months(cast(step as int)) as date)) month_end,
             y + ({_GIVEN[0]} * d + ({_GIVEN[1]}) * e) * list_sum(list_transform(range(0, step), lambda j: pow({_GIVEN[0]}, j))) forecast,
             sqrt(s2 * (select sum(total * total) from psi where psi.step <= h.step)) se
      from ends join last using (category), h)
select category, cast(step as int) step, month_end, round(forecast, 2) forecast, round(forecast - {FC.Z95} * se, 2) lower,
       round(forecast + {FC.Z95} * se, 2) upper, 'arima' model, 0 season from f""")
def arima_given(spark, sf):
    """The recursion of ``arima_forecast`` with given coefficients, to the cent."""
    out = FC.series_forecast(_by_category(Star(spark, sf)), ["category"], "arima", given=_GIVEN)
    return out.withColumns({c: F.round(c, 2) for c in ("forecast", "lower", "upper")})


@query("ets_forecast")
def ets_forecast(spark, sf):
    """Additive Holt-Winters, 6 months, 95 % interval, one model per category."""
    return FC.series_forecast(_by_category(Star(spark, sf)), ["category"], "ets")


@query("arima_forecast_total")
def arima_forecast_total(spark, sf):
    """ARIMA(1,1,1) of all revenue, 6 months."""
    return FC.series_forecast(Star(spark, sf).fact_sales, [], "arima")


@query("ets_forecast_total")
def ets_forecast_total(spark, sf):
    """Additive Holt-Winters of all revenue, 6 months."""
    return FC.series_forecast(Star(spark, sf).fact_sales, [], "ets")


# -- joins / top-k / group operators ---------------------------------------------------
@query("join_sales_date", """
select s.sale_id, s.sale_date, cast(s.revenue as double) revenue, d.year, d.quarter, d.month, d.day_name
from fact_sales s join dim_date d on s.sale_date = d.full_date""")
def join_sales_date(spark, sf):
    st = Star(spark, sf)
    j = st.fact_sales.join(F.broadcast(st.dim_date), F.col("sale_date") == F.col("full_date"))  # calendar
    return j.select("sale_id", "sale_date", F.col("revenue").cast("double").alias("revenue"),
                    "year", "quarter", "month", "day_name")


@query("sort_values", """
select product_id, cast(sum(revenue) as double) revenue from fact_sales group by product_id
order by sum(revenue) desc, product_id""")
def sort_values(spark, sf):
    """Products sorted by revenue (global range-partitioned sort)."""
    s = Star(spark, sf).fact_sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
    return s.orderBy(F.col("_r").desc(), "product_id").select("product_id",
                                                              F.col("_r").cast("double").alias("revenue"))


@query("topn_per_group", """
with r as (select p.category, s.product_id, sum(s.revenue) rev from fact_sales s
           join dim_product p on s.product_id = p.product_id group by 1, 2),
k as (select *, row_number() over (partition by category order by rev desc, product_id) rk from r)
select category, product_id best_product_id, cast(rev as double) revenue from k where rk = 1""")
def topn_per_group(spark, sf):
    """Best product of each category (TOPN(1) per filter context).

    A max over (revenue, -product_id) structs: partial aggregation per
    task, so a category holding a third of all products is never one task.
    """
    st = Star(spark, sf)
    r = (st.fact_sales.groupBy("product_id").agg(F.sum("revenue").alias("_r"))
         .join(st.dim_product.select("product_id", "category"), "product_id"))
    best = r.groupBy("category").agg(F.max(F.struct(F.col("_r"), (-F.col("product_id")).alias("_k"))).alias("_b"))
    return best.select("category", (-F.col("_b._k")).alias("best_product_id"),
                       F.col("_b._r").cast("double").alias("revenue"))


@query("top_rows", """
select product_id, warehouse_id, stock_level from fact_inventory order by stock_level desc, product_id limit 20""")
def top_rows(spark, sf):
    """Top-k rows by a column (TakeOrderedAndProject)."""
    return top_k(Star(spark, sf).fact_inventory.select("product_id", "warehouse_id", "stock_level"), 20,
                 [F.col("stock_level").desc(), F.col("product_id").asc()])
