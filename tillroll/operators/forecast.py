"""Per-series statistical forecasts: ARIMA(1,1,1) and additive Holt-Winters.

The monthly series (one row per series and month, gaps filled) is built
with DataFrame operators; each series is then one ``applyInPandas`` group,
so series are fitted in parallel and a group holds one calendar of months.
Inside a group the fit is a few lines of numpy (no optional libraries):

* ARIMA(1,1,1) without a constant (an integrated model has no trend term by
  default): the conditional sum of squares of the differences is minimised,
  from Hannan-Rissanen estimates on; recursive forecasts, 95 % interval from
  the psi weights of the integrated model.
* Holt-Winters with additive trend and season.  The season is found: peaks of the
  detrended series' autocorrelation are its candidates, and the information
  criterion compares their models with Holt's linear trend.  Smoothing constants are chosen
  by grid search on one-step squared error, all grid points at once; the
  interval has the additive model's own variance.
"""

from __future__ import annotations

import sys
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .timeseries import MA_WINDOW, resample_month

# The group function runs in Python workers.  Pickling this module by value
# ships the fit code with the task, so executors need no installed copy of
# the package (numpy / pandas are imported there as usual).
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Horizon, interval z, longest season looked for, smoothing grid.
PERIODS = 6
Z95 = 1.959963984540054
LONGEST_SEASON = 24
GRID = (0.1, 0.3, 0.5, 0.7, 0.9)
OUT_SCHEMA = "step int, month_end date, forecast double, lower double, upper double, model string, season int"


def _month_ends(last, periods: int):
    return [(pd.Timestamp(last) + pd.offsets.MonthEnd(k)).date() for k in range(1, periods + 1)]


def _css(d: np.ndarray, phi: float, theta: float) -> np.ndarray:
    """One-step errors of d_t = phi d_{t-1} + theta a_{t-1} + a_t, the first one
    and what came before taken as zero."""
    a = np.zeros(len(d))
    for t in range(1, len(d)):
        a[t] = d[t] - phi * d[t - 1] - theta * a[t - 1]
    return a


def fit_arima111(y: np.ndarray) -> tuple[float, float, float] | None:
    """(phi, theta, innovation variance) of ARIMA(1,1,1) without a constant, by
    conditional least squares; None for fewer than 7 values."""
    d = np.diff(y)
    n = len(d)
    if n < 6:
        return None
    p_long = max(1, min(6, n // 3))
    # start: a long autoregression gives innovations, these a regression
    lags = np.column_stack([d[p_long - j - 1:n - j - 1] for j in range(p_long)])
    coef, *_ = np.linalg.lstsq(lags, d[p_long:], rcond=None)
    e = np.zeros(n)
    e[p_long:] = d[p_long:] - lags @ coef
    t0 = p_long + 1
    start, *_ = np.linalg.lstsq(np.column_stack([d[t0 - 1:n - 1], e[t0 - 1:n - 1]]), d[t0:], rcond=None)
    best = np.clip(start, -0.95, 0.95)
    least = float((_css(d, *best) ** 2).sum())
    step = 0.2
    while step > 1e-5:  # pattern search inside the stationary, invertible square
        moved = False
        for way in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, -1), (-1, 1)):
            trial = np.clip(best + step * np.array(way), -0.99, 0.99)
            value = float((_css(d, *trial) ** 2).sum())
            if value < least - 1e-12 * abs(least):
                best, least, moved = trial, value, True
        if not moved:
            step /= 2
    return float(best[0]), float(best[1]), least / (n - 1)


def _arima111(y: np.ndarray, periods: int, given: tuple[float, float] | None = None):
    """Forecast mean and standard error of ARIMA(1,1,1), fitted or with ``given``
    coefficients (phi, theta)."""
    d = np.diff(y)
    if given is None:
        fitted = fit_arima111(y)
    else:
        fitted = (*given, float((_css(d, *given) ** 2).sum()) / (len(d) - 1)) if len(d) >= 2 else None
    if fitted is None:
        return None
    phi, theta, sigma2 = fitted
    last = _css(d, phi, theta)[-1]
    steps = [phi * d[-1] + theta * last]
    for _ in range(1, periods):
        steps.append(phi * steps[-1])
    # psi weights of the ARMA(1,1) on differences, cumulated for the levels
    psi = [1.0] + [phi ** (j - 1) * (phi + theta) for j in range(1, periods)]
    return y[-1] + np.cumsum(steps), np.sqrt(sigma2 * np.cumsum(np.cumsum(psi) ** 2))


def holt_winters_se(sigma: float, alpha: float, beta: float, gamma: float, periods: int, season: int) -> np.ndarray:
    """Standard errors of the additive model: sigma^2 (1 + sum of c_j^2 for j < h),
    c_j = alpha (1 + j beta) + gamma (1 - alpha) where j is a multiple of the season."""
    j = np.arange(1, periods)
    c = alpha * (1 + j * beta)
    if season:
        c = c + np.where(j % season == 0, gamma * (1 - alpha), 0.0)
    return sigma * np.sqrt(1 + np.concatenate([[0.0], np.cumsum(c ** 2)]))


def candidate_seasons(y: np.ndarray, most: int = 3) -> list[int]:
    """Periods worth a seasonal model: the highest significant peaks of the autocorrelation
    of the detrended series, at lags of which two fit in, no more than LONGEST_SEASON."""
    n = len(y)
    t = np.arange(n)
    d = y - np.polyval(np.polyfit(t, y, 1), t) if n > 2 else y - y.mean()
    power = float((d * d).sum())
    longest = min(LONGEST_SEASON, n // 2)
    if longest < 2 or power <= 1e-12 * max(float((y * y).sum()), 1e-300):
        return []
    r = np.array([float((d[k:] * d[:n - k]).sum()) / power for k in range(longest + 2)])
    peaks = [k for k in range(2, longest + 1) if r[k] > Z95 / np.sqrt(n) and r[k] >= r[k - 1] and r[k] >= r[k + 1]]
    return sorted(sorted(peaks, key=lambda k: -r[k])[:most])


def _smoothed(y: np.ndarray, season: int, judged: int):
    """Additive Holt-Winters with a season (0: none), every grid point a row of the state:
    the best point's index, its squared error from ``judged`` on and in all, and the state."""
    n = len(y)
    grid = np.array([(a, b, g) for a in GRID for b in GRID for g in (GRID if season else (0.0,))])
    alpha, beta, gamma = grid.T
    if season:
        first, slope = y[:season].mean(), (y[season:2 * season].mean() - y[:season].mean()) / season
        at = np.arange(season) - (season - 1) / 2  # steps from the middle of the first season
        part = np.repeat((y[:season] - first - slope * at)[None], len(grid), axis=0)
        level = np.full(len(grid), first + slope * (season - 1) / 2)  # at the season's end
    else:
        part = np.zeros((len(grid), 1))
        m = min(n, 12)  # a line through the first year, so that one odd month is no trend
        slope, first = np.polyfit(np.arange(m), y[:m], 1) if m > 1 else (0.0, y[0])
        level = np.full(len(grid), first)
    trend, sse, late = np.full(len(grid), slope), np.zeros(len(grid)), np.zeros(len(grid))
    for t in range(season or 1, n):
        s = part[:, t % season] if season else 0.0
        error = (y[t] - (level + trend + s)) ** 2
        sse += error
        late += error if t >= judged else 0.0
        new = alpha * (y[t] - s) + (1 - alpha) * (level + trend)
        trend = beta * (new - level) + (1 - beta) * trend
        if season:
            part[:, t % season] = gamma * (y[t] - new) + (1 - gamma) * s
        level = new
    b = int(sse.argmin())
    return grid[b], float(sse[b]), float(late[b]), level[b], trend[b], part[b]


def choose_season(y: np.ndarray) -> int:
    """The period of the additive model with the least corrected Akaike criterion, or 0 if the
    model without a season has it.  All models are judged by the same months, those
    after the longest candidate's first season."""
    found = candidate_seasons(y)
    if not found:
        return 0
    judged = max(found)
    n = len(y) - judged

    def criterion(season: int) -> float:
        late = _smoothed(y, season, judged)[2]
        k = 5 + (season if season else 0)              # smoothing, level, trend, variance; the season's states
        scale = max(late / n, 1e-300)
        return n * np.log(scale) + 2 * k + (2 * k * (k + 1) / (n - k - 1) if n > k + 1 else np.inf)

    best = min([0, *found], key=criterion)
    return best if np.isfinite(criterion(best)) else 0


def _holt_winters(y: np.ndarray, periods: int, season: int | None = None):
    """Forecast mean and standard error; the season is found unless given (0: none)."""
    n = len(y)
    season = choose_season(y) if season is None else season
    point, sse, _, level, trend, part = _smoothed(y, season, 0)
    sigma = np.sqrt(sse / max(n - (season or 1), 1))
    ahead = np.arange(1, periods + 1)
    mean = level + ahead * trend + (part[(n + ahead - 1) % season] if season else 0.0)
    return mean, holt_winters_se(sigma, *point, periods, season)


def _series_forecaster(method: str, keys: Sequence[str], periods: int, given: tuple[float, float] | None):
    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("month_end")
        y = pdf["revenue"].to_numpy(dtype=float)
        res = None
        model, season = method, 0
        if method == "arima":
            res = _arima111(y, periods, given)
        if method == "ets" and len(y) >= 2:
            season = choose_season(y)
            res, model = _holt_winters(y, periods, season), "holt_winters"
        if res is None:  # too short for its model: the moving average, as wide as its months differ
            last = y[-MA_WINDOW:]
            res, model = (np.repeat(last.mean(), periods), np.repeat(last.std(), periods)), "moving_average"
        mean, se = res
        out = pd.DataFrame({
            "step": np.arange(1, periods + 1, dtype="int32"),
            "month_end": _month_ends(pdf["month_end"].iloc[-1], periods),
            "forecast": mean, "lower": mean - Z95 * se, "upper": mean + Z95 * se, "model": model,
            "season": np.full(periods, season, dtype="int32")})
        for k in keys:
            out.insert(0, k, pdf[k].iloc[0])
        return out
    return fit


def series_forecast(sales: DataFrame, by: Sequence[str], method: str = "arima",
                    periods: int = PERIODS, given: tuple[float, float] | None = None) -> DataFrame:
    """Forecast the next ``periods`` month ends of every series in ``by``; ``given`` ARIMA
    coefficients are used instead of fitted ones."""
    series = resample_month(sales, by)
    key_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in series.schema if f.name in by)
    schema = (key_schema + ", " if key_schema else "") + OUT_SCHEMA
    return series.groupBy(*by).applyInPandas(_series_forecaster(method, list(by), periods, given), schema)
