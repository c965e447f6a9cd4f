"""Balances over time and the observed stock-out label, on small hand-made movements."""

import datetime as dt

from pyspark.sql import functions as F

from conftest import SF_SMALL
from tillroll.operators import stock as ST

D = dt.date


def _tables(spark):
    inv = spark.createDataFrame([(1, 10), (2, 5), (3, 7), (4, None)], "product_id long, stock_level int")
    sales = spark.createDataFrame([(1, D(2024, 1, 1), 4), (1, D(2024, 1, 1), 3), (1, D(2024, 1, 2), 5), (2, D(2024, 1, 3), 5),
                                   (2, D(2024, 2, 1), 1), (None, D(2024, 1, 1), 9), (1, None, 9), (9, D(2024, 1, 1), 1)],
                                  "product_id long, sale_date date, quantity int")
    orders = spark.createDataFrame([(1, D(2024, 1, 1), 7), (2, None, 50)], "product_id long, delivery_date date, quantity int")
    return inv, sales, orders


def test_balance_and_its_minimum(spark):
    inv, sales, orders = _tables(spark)
    got = {(r.product_id, r.day): (r.balance, r.lowest) for r in ST.stock_balance(inv, ST.daily_movements(sales, orders)).collect()}
    assert got == {(1, D(2024, 1, 1)): (3, 3), (1, D(2024, 1, 2)): (-2, -2), (1, D(2024, 1, 4)): (5, -2),   # arrives 3 days later
                   (2, D(2024, 1, 3)): (0, 0), (2, D(2024, 2, 1)): (-1, -1)}


def test_features_look_back_and_the_label_ahead(spark):
    inv, sales, orders = _tables(spark)
    got = {r.product_id: r for r in ST.stockout_features(inv, sales, orders, horizon=10, demand_days=20).collect()}
    assert (got[1].current_stock, got[1].lead_time, got[1].avg_daily_demand, got[1].stockout) == (5, 3, 0.0, 0)
    assert (got[2].current_stock, got[2].avg_daily_demand, got[2].stockout) == (0, 5 / 20, 1)
    assert (got[3].current_stock, got[3].stockout) == (7, 0) and got[4].current_stock is None


def test_label_is_no_function_of_the_features(spark):
    """Products alike in all three features, apart in what happened next."""
    inv = spark.createDataFrame([(1, 5), (14, 5)], "product_id long, stock_level int")       # same lead time
    sales = spark.createDataFrame([(1, D(2024, 1, 5), 3), (14, D(2024, 1, 5), 3), (1, D(2024, 2, 1), 9), (14, D(2024, 2, 1), 2)],
                                  "product_id long, sale_date date, quantity int")
    orders = spark.createDataFrame([], "product_id long, delivery_date date, quantity int")
    rows = ST.stockout_features(inv, sales, orders, horizon=10, demand_days=60).orderBy("product_id").collect()
    assert rows[0][1:4] == rows[1][1:4] and (rows[0].stockout, rows[1].stockout) == (1, 0)


def test_stockouts_occur_in_the_star(spark):
    from tillroll.sources.tpch import Star
    f = Star(spark, SF_SMALL).stockout_features
    n, out = f.agg(F.count("*"), F.sum("stockout")).first()
    assert n > 0 and 0 < out < n / 2


def test_a_saved_model_scores_as_the_fitted_one(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from tillroll.operators import classify as CL
    rows = [(i, (i * 37) % 100, i % 13 + 2, (i % 17) / 3.0, int((i * 37) % 100 < 3 * (i % 17))) for i in range(400)]
    df = spark.createDataFrame(rows, "product_id long, current_stock long, lead_time int, avg_daily_demand double, stockout int")
    model = CL.stockout_pipeline(n_trees=5, max_depth=6).fit(df)
    model.write().save(str(tmp_path / "m"))
    score = lambda m: sorted((r.product_id, r.prediction, tuple(r.probability)) for r in m.transform(df).collect())
    assert score(PipelineModel.load(str(tmp_path / "m"))) == score(model)
    assert {p for _, p, _ in score(model)} == {0.0, 1.0}


def test_a_model_scores_after_an_observed_query(spark):
    """An observation makes the session unserializable, and a fitted model must not hold the session."""
    from pyspark.sql import Observation
    from tillroll.operators import classify as CL
    rows = [(i, i % 50, i % 13 + 2, (i % 17) / 3.0, int(i % 50 < 9)) for i in range(300)]
    df = spark.createDataFrame(rows, "product_id long, current_stock long, lead_time int, avg_daily_demand double, stockout int")
    watch = Observation()
    df.observe(watch, F.count(F.lit(1)).alias("n")).collect()
    assert watch.get["n"] == 300
    model = CL.stockout_pipeline(n_trees=3, max_depth=4).fit(df)
    assert not model.stages[-1].hasSummary and model.transform(df).where("prediction = 1").count() > 0
    got = CL.stockout_report(df).first()
    assert got.n_train + got.n_test == 300 and got.accuracy > 0.9


def test_training_rows_are_dealt_by_their_number_and_key(spark, monkeypatch):
    """Few tasks for few rows, and the same forest however the rows lay before."""
    from tillroll.operators import classify as CL
    rows = [(i, (i * 37) % 100, i % 13 + 2, (i % 17) / 3.0, int((i * 37) % 100 < 3 * (i % 17))) for i in range(600)]
    df = spark.createDataFrame(rows, "product_id long, current_stock long, lead_time int, avg_daily_demand double, stockout int")
    assert CL._training(df.repartition(30), "product_id").rdd.getNumPartitions() == 1
    monkeypatch.setattr(CL, "TRAIN_ROWS", 250)
    forests = []
    for k in (2, 30):
        lay = df.repartition(k, F.hash("product_id", F.lit(k)))
        train = CL._training(lay, "product_id")
        assert train.rdd.getNumPartitions() == 3
        model = CL.stockout_pipeline(n_trees=4, max_depth=6).fit(train).stages[-1]
        assert model.getCacheNodeIds()
        forests.append(model.toDebugString.split("\n", 1)[1])
    assert forests[0] == forests[1]


def test_a_saved_model_scores_features_made_once(spark):
    import __spark_entry__ as E
    out = E.queries()["model_save"](spark, SF_SMALL)
    assert "lineitem" not in out._jdf.queryExecution().executedPlan().toString() and out.count() > 0
