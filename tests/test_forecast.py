"""Per-series forecasts: shape, finite values, intervals; and the fit code
reaches Python workers that cannot import the package (another cwd)."""

import math
import os
import subprocess
import sys

import numpy as np

from conftest import ROOT, SF_SMALL
from tillroll.operators import forecast as FC


def _arma(rng, n, phi, theta):
    a, d = rng.normal(size=n + 50), np.zeros(n + 50)
    for t in range(1, n + 50):
        d[t] = phi * d[t - 1] + a[t] + theta * a[t - 1]
    return d[50:]


def test_arima_recovers_its_coefficients():
    rng = np.random.default_rng(1)
    for phi, theta in ((0.6, 0.3), (-0.5, -0.4), (0.2, -0.7)):
        p, q, s2 = FC.fit_arima111(np.cumsum(_arma(rng, 4000, phi, theta)))
        assert abs(p - phi) < 0.08 and abs(q - theta) < 0.08 and abs(s2 - 1) < 0.1


def test_arima_has_no_drift_and_covers():
    rng = np.random.default_rng(2)
    inside, drift = 0, []
    for _ in range(200):
        y = np.cumsum(_arma(rng, 126, 0.4, 0.2))
        mean, se = FC._arima111(y[:120], 6)
        inside += abs(y[125] - mean[5]) <= FC.Z95 * se[5]
        drift.append(mean[5] - mean[4])
    assert 0.88 <= inside / 200 <= 0.99 and abs(np.mean(drift)) < 0.1
    line = FC._arima111(np.arange(60.0) * 5, 60)[0]
    assert line[-1] - line[-2] < 5 and FC._arima111(np.arange(6.0), 6) is None


def test_holt_winters_interval_and_seasons():
    rng = np.random.default_rng(3)
    _, se = FC._holt_winters(rng.normal(0, 9.3, 84), 6)
    assert 6 < se[5] < 16  # noise does not pile up to sqrt(6) times its width
    assert np.allclose(FC.holt_winters_se(2.0, 0.5, 0.1, 0.3, 3, 2), 2 * np.sqrt(
        [1, 1 + 0.55 ** 2, 1 + 0.55 ** 2 + (0.5 * 1.2 + 0.3 * 0.5) ** 2]))
    t = np.arange(60)
    y = 100 + 2 * t + 10 * np.sin(2 * np.pi * t / 12)
    mean, _ = FC._holt_winters(y, 12)
    ahead = np.arange(60, 72)
    assert np.abs(mean - (100 + 2 * ahead + 10 * np.sin(2 * np.pi * ahead / 12))).max() < 2.5


def test_total_series_and_short_series(spark):
    import __spark_entry__ as E
    for name in ("arima_forecast_total", "ets_forecast_total"):
        rows = E.queries()[name](spark, SF_SMALL).collect()
        assert [r.step for r in rows] == [1, 2, 3, 4, 5, 6]
    short = spark.createDataFrame([("2024-01-05", 10.0), ("2024-02-05", 20.0)], "d string, revenue double").selectExpr(
        "cast(d as date) sale_date", "revenue")
    rows = FC.series_forecast(short, [], "arima").collect()
    assert {r.model for r in rows} == {"moving_average"} and {r.forecast for r in rows} == {15.0}


def test_forecast_shapes(spark):
    import __spark_entry__ as E
    for name in ("arima_forecast", "ets_forecast"):
        rows = E.queries()[name](spark, SF_SMALL).collect()
        cats = {r.category for r in rows}
        assert len(rows) == 6 * len(cats) and len(cats) > 0
        for r in rows:
            assert all(math.isfinite(x) for x in (r.forecast, r.lower, r.upper))
            assert r.lower <= r.forecast <= r.upper


def test_forecast_from_other_cwd():
    code = (f"import sys; sys.path.insert(0, {ROOT!r}); "
            "import __spark_entry__ as E; from tillroll.session import get_session; "
            "s = get_session(master='local[2]', shuffle_partitions=2); "
            f"print('rows', E.queries()['ets_forecast'](s, {SF_SMALL!r}).count())")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd="/", env=env, capture_output=True, text=True,
                         timeout=600)
    assert "rows " in out.stdout, out.stderr[-2000:]


def test_seasons_are_found():
    """Periods 4, 6, 12 and none are told apart, with trend and noise."""
    right = {0: 0, 4: 0, 6: 0, 12: 0}
    for k in range(25):
        rng = np.random.default_rng(k)
        t = np.arange(96)
        for period in right:
            wave = rng.normal(size=period) if period else np.zeros(1)
            wave = 12 * (wave - wave.mean()) / max(wave.std(), 1e-9)
            y = 200 + rng.uniform(-1, 1) * t + wave[t % len(wave)] + rng.normal(0, 5, len(t))
            right[period] += FC.choose_season(y) == period
    assert all(v >= 21 for v in right.values()), right


def test_season_of_short_and_flat_series():
    for y in (np.ones(40), np.arange(40.0), np.zeros(3), np.array([1.0, 2.0]), np.tile([1.0, 5.0], 2)):
        season = FC.choose_season(y)
        mean, se = FC._holt_winters(y, 6)
        assert 0 <= season <= len(y) // 2 and np.isfinite(mean).all() and np.isfinite(se).all()
    y = np.tile([1.0, 5.0, 2.0, 9.0], 10)
    assert FC.choose_season(y) == 4 and np.allclose(FC._holt_winters(y, 4)[0], [1, 5, 2, 9], atol=0.2)


def test_forecast_names_its_season(spark):
    rows = [(f"{2015 + m // 12}-{m % 12 + 1:02d}-10", 100.0 + 30 * (m % 6 == 0) - 30 * (m % 6 == 3)) for m in range(72)]
    df = spark.createDataFrame(rows, "d string, revenue double").selectExpr("to_date(d) sale_date", "revenue")
    out = FC.series_forecast(df, [], "ets").orderBy("step").collect()
    assert {r.season for r in out} == {6} and out[0].forecast > 120
