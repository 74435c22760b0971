"""Additive seasonal forecast of every series at once (M2, M3, M5).

Per series: an intercept, a piecewise linear trend, yearly and weekly Fourier terms,
and optionally weather regressors. The trend bends at knots on an even grid over the
first part of the series' training days (hinge terms); a sparse prior keeps most
bends at zero, solved by reweighted ridge steps. All coefficients come from the
series' sufficient statistics (``operators.least_squares``): training days are read
once, also for the ablation, whose two models are submatrices of the same sums.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import partial

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.least_squares import dot, gram, solved

# The seasonal model's terms; prior scales, in units of the series'
# largest absolute value.
WEATHER_REGRESSORS = ["vent_velocitat", "temperatura", "precipitacio", "pressio"]
YEARLY_ORDER, WEEKLY_ORDER = 10, 3
CHANGEPOINTS, CHANGEPOINT_RANGE, CHANGEPOINT_SCALE = 25, 0.8, 0.05
TREND_SCALE, SEASONAL_SCALE, REGRESSOR_SCALE = 5.0, 0.3, 10.0
#: Days of training from which yearly terms have their full scale. Over a part of a
#: year they can't be told from the trend, so they are held back by the square of
#: the covered share.
YEARLY_DAYS = 730.5
Z80 = 1.2815515655446004     # two-sided 80 % normal quantile

N_TREND = 2 + CHANGEPOINTS
N_SEASONAL = 2 * (YEARLY_ORDER + WEEKLY_ORDER)
#: Reweighted ridge steps, and the bend (in units of the scaled series) below
#: which a knot counts as unused.
STEPS, UNUSED = 30, 1e-4

WITHOUT, WITH = "seasonal_sense_meteo", "seasonal_amb_meteo"


def design(day: Column, first: Column, last: Column, regressors: Sequence[str] = ()) -> Column:
    """The row vector: 1, time in [0, 1] over the training days, hinges, Fourier
    terms, regressors."""
    span = F.greatest(F.datediff(last, first), F.lit(1)).cast("double")
    t = F.datediff(day, first).cast("double") / span
    knots = [CHANGEPOINT_RANGE * k / CHANGEPOINTS for k in range(1, CHANGEPOINTS + 1)]
    number = F.datediff(day, F.lit("1970-01-01").cast("date")).cast("double")
    cols = [F.lit(1.0), t, *(F.greatest(t - F.lit(s), F.lit(0.0)) for s in knots)]
    share = F.least(span / F.lit(YEARLY_DAYS), F.lit(1.0))
    for period, order, weight in ((365.25, YEARLY_ORDER, share * share), (7.0, WEEKLY_ORDER, F.lit(1.0))):
        for k in range(1, order + 1):
            angle = F.lit(2.0 * math.pi * k / period) * number
            cols += [weight * F.sin(angle), weight * F.cos(angle)]
    return F.array(*cols, *(F.col(r).cast("double") for r in regressors))


def solve(g: np.ndarray, regressors: int) -> tuple[np.ndarray, float]:
    """Coefficients of intercept, trend, seasons and the first ``regressors``
    regressors, from the sums over ``(x, y)``; and the residuals' deviation."""
    p = N_TREND + N_SEASONAL + regressors
    n, yy = g[0, 0], g[-1, -1]
    # Regressors are standardised by a change of basis; the sums give their moments.
    basis = np.eye(p)
    for j in range(N_TREND + N_SEASONAL, p):
        mean = g[0, j] / n
        sd = math.sqrt(max(g[j, j] / n - mean * mean, 0.0)) or 1.0
        basis[0, j], basis[j, j] = -mean / sd, 1.0 / sd
    a, b = basis.T @ g[:p, :p] @ basis, basis.T @ g[:p, -1]
    scales = np.full(p, SEASONAL_SCALE)
    scales[:2] = TREND_SCALE
    scales[N_TREND + N_SEASONAL:] = REGRESSOR_SCALE
    bends = slice(2, N_TREND)
    variance = max((yy / n - (g[0, -1] / n) ** 2) / 4, 1e-8)
    size = np.full(CHANGEPOINTS, CHANGEPOINT_SCALE)
    beta = np.zeros(p)
    for _ in range(STEPS):
        penalty = variance / scales ** 2
        penalty[bends] = variance / (CHANGEPOINT_SCALE * size)
        beta = np.linalg.solve(a + np.diag(penalty), b)
        variance = max((yy - 2 * b @ beta + beta @ a @ beta) / n, 1e-8)
        size = np.maximum(np.abs(beta[bends]), UNUSED)
    return basis @ beta, math.sqrt(variance)


def _models(use_weather: bool | None) -> dict:
    """The ablation's two models, or one of them."""
    both = {WITHOUT: partial(solve, regressors=0),
            WITH: partial(solve, regressors=len(WEATHER_REGRESSORS))}
    return both if use_weather is None else {k: v for k, v in both.items()
                                             if (k == WITH) == use_weather}


def forecast(flagged: DataFrame, series: Sequence[str], use_weather: bool | None = True,
             label: str = "no2_mitja", flag: str = "es_test", order: str = "data",
             ) -> tuple[DataFrame, DataFrame]:
    """Fit each series on its rows with ``flag`` false and forecast the others.
    Returns the coefficients (``beta`` in units of the series' largest absolute
    value ``_scale``, ``model``, ``sigma``) and the forecasts: series, date,
    ``model``, ``y``, ``yhat``, ``yhat_lower``, ``yhat_upper``. With ``use_weather``
    None both models are fitted, from the same sums.

    Training days miss no label and no regressor of the models; a day to forecast
    with a missing regressor has a NULL forecast, and so have the days of a series
    without training days."""
    regs = [] if use_weather is False else WEATHER_REGRESSORS
    y = F.col(label).cast("double")
    whole = ~F.col(flag) & y.isNotNull()
    for r in regs:
        whole = whole & F.col(r).isNotNull()
    span = Window.partitionBy(*series)
    over = lambda f, c: f(F.when(whole, c)).over(span)
    rows = flagged.select(
        *series, F.col(order), F.col(flag), y.alias("y"), whole.alias("_fit"),
        over(F.min, F.col(order)).alias("_first"), over(F.max, F.col(order)).alias("_last"),
        F.greatest(over(F.max, F.abs(y)), F.lit(1e-9)).alias("_scale"), *regs)
    rows = rows.select(*series, order, flag, "y", "_fit", "_scale", design(
        F.col(order), F.col("_first"), F.col("_last"), regs).alias("_x"))
    train = rows.where("_fit").withColumn(
        "_x", F.concat("_x", F.array(F.col("y") / F.col("_scale"))))
    keys = [*series, "_scale"]
    coefs = solved(gram(train, keys, "_x"), keys, _models(use_weather))
    # A row per series and model stands against a row per series and day.
    test = rows.where(F.col(flag)).select(*series, order, "y", "_x")
    names = F.explode(F.array(*(F.lit(m) for m in _models(use_weather)))).alias("model")
    found = test.select("*", names).join(coefs, [*series, "model"], "left")
    yhat = F.col("_scale") * dot("_x", "beta")
    band = F.col("_scale") * F.lit(Z80) * F.col("sigma")
    pred = found.select(*series, order, "model", "y", yhat.alias("yhat"),
                        (yhat - band).alias("yhat_lower"), (yhat + band).alias("yhat_upper"))
    return coefs, pred


def trend_bends(coefs: DataFrame, series: Sequence[str], least: float = 0.01) -> DataFrame:
    """The knots in use: ``position`` on the training days (0 to 1) and the change
    of slope (in units of the series' scale per whole span)."""
    knots = F.slice("beta", 3, CHANGEPOINTS)
    return (coefs.select(*series, "model", F.posexplode(knots).alias("_k", "canvi"))
            .where(F.abs("canvi") >= least)
            .select(*series, "model", "canvi",
                    ((F.col("_k") + 1) * F.lit(CHANGEPOINT_RANGE / CHANGEPOINTS)).alias("position")))
