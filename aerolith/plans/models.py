"""Forecast models on the daily feature table.

* ``gbt_forecast``: gradient-boosted trees on the 17 lag/weather/calendar features,
  one model per series, all in one job (``operators.boosting``): NULL features take
  a learned side, columns are sampled per tree.
* ``seasonal_forecast``: piecewise linear trend, yearly and weekly Fourier terms,
  optionally weather, per series from sufficient statistics (``plans.seasonal``),
  with an 80 % band from the training residuals.
* The hold-out is the last ``n_test`` days of each series (a window partitioned by
  series, not a sort of the whole table).
* Runs are rows of the ledger (``plans.ledger``): run, series, attempt, parameters,
  metrics; gains are taken per series.
"""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import scaled_round
from ..operators import boosting
from ..operators.metrics import regression_metrics
from ..operators.windows import holdout
from ..session import ensure_checkpoint_dir, scratch_path
from . import ledger, seasonal
from . import sqltext as S
from .catalog import _features, query
from .seasonal import WEATHER_REGRESSORS, WITH, WITHOUT

# The 17 model features, in the original order, and the
# hyper-parameters of the boosted trees.
FEATURES = [
    "no2_lag1", "no2_lag2", "no2_lag7",
    "no2_mm3", "no2_mm7",
    "vent_velocitat", "vent_max", "vent_lag1",
    "temperatura", "humitat", "precipitacio", "precip_lag1", "pressio",
    "dia_setmana_num", "mes",
    "dia_any_sin", "dia_any_cos",
]
GBT_PARAMS = dict(rounds=300, depth=5, rate=0.05, rows=0.8, columns=0.8, seed=42)
GBT_RUN, GBT_NAME = "gbt_amb_lags", "GBT"
EU_ANNUAL_LIMIT = 40.0       # reference line drawn with the forecasts (µg/m³)
TEST_DAYS = 60


def model_frame(features_ml: DataFrame) -> DataFrame:
    """Rows with complete lags (the boosted-tree input) and the weekend flag
    as an int."""
    return (features_ml.where(F.col("no2_lag7").isNotNull() & F.col("no2_mm7").isNotNull())
            .withColumn("es_cap_setmana", F.col("es_cap_setmana").cast("int")))


def split(df: DataFrame, series: Sequence[str], n_test: int = TEST_DAYS,
          order: str = "data") -> tuple[DataFrame, DataFrame]:
    flagged = holdout(df, series, order, n_test)
    return (flagged.where(~F.col("es_test")).drop("es_test"),
            flagged.where(F.col("es_test")).drop("es_test"))


def gbt_forecast(train: DataFrame, test: DataFrame, params: Mapping | None = None,
                 label: str = "no2_mitja", series: Sequence[str] = ()):
    """Fit every series on ``train``; return (trees, predictions on ``test``). The
    trees are written before they are used, so a model is fitted once. Rows with a
    missing feature get a forecast; rows of a series without training rows a NULL."""
    p = dict(GBT_PARAMS, **(params or {}))
    keys = list(series) or ["_tot"]
    one = (lambda df: df) if series else (lambda df: df.withColumn("_tot", F.lit(1)))
    ensure_checkpoint_dir(train.sparkSession)
    trees = boosting.fit_series(one(train), keys, FEATURES, label, p).checkpoint(eager=True)
    pred = boosting.predict_series(one(test), trees, keys, FEATURES, p["depth"])
    return trees, (pred if series else pred.drop("_tot")).withColumnRenamed(label, "y")


def feature_importance(spark: SparkSession, trees: DataFrame, top: int | None = 8) -> DataFrame:
    """(feature, importancia) over all series' trees, most important first."""
    df = boosting.importance(trees).orderBy(F.col("importancia").desc(), F.col("feature"))
    return df.limit(top) if top else df


def _flagged(train: DataFrame, test: DataFrame) -> DataFrame:
    return train.withColumn("es_test", F.lit(False)).unionByName(
        test.withColumn("es_test", F.lit(True)))


def seasonal_forecast(train: DataFrame, test: DataFrame, use_weather: bool = True,
                      label: str = "no2_mitja", series: Sequence[str] = ()):
    """(coefficients, predictions with an 80 % band) of the seasonal model, per
    series, or of the whole table as one series."""
    keys = list(series) or ["_tot"]
    both = _flagged(train, test)
    both = both if series else both.withColumn("_tot", F.lit(1))
    coefs, pred = seasonal.forecast(both, keys, use_weather, label)
    return coefs, pred if series else pred.drop("_tot")


def seasonal_forecast_by_series(df: DataFrame, series: Sequence[str], n_test: int,
                                use_weather: bool = True, label: str = "no2_mitja") -> DataFrame:
    """Forecasts of the last ``n_test`` days of every series: series keys, data, y,
    yhat, yhat_lower, yhat_upper."""
    return seasonal.forecast(holdout(df, series, "data", n_test), series, use_weather,
                             label)[1].drop("model")


def forecast_output(pred: DataFrame, series: Sequence[str] = (),
                    date_col: str = "data") -> DataFrame:
    """The plotted forecast as data: actual, prediction, band and the EU
    annual limit line."""
    cols = [*series, date_col, "y", "yhat"]
    cols += [c for c in ("yhat_lower", "yhat_upper") if c in pred.columns]
    return pred.select(*cols, F.lit(EU_ANNUAL_LIMIT).alias("limit_ue"))


def run_gbt(spark: SparkSession, features_ml: DataFrame, out: str, series: Sequence[str] = (),
            n_test: int = TEST_DAYS, params: Mapping | None = None, run_name: str = GBT_RUN,
            attempt: str | None = None) -> dict[str, DataFrame]:
    """The boosted-tree run: complete-lag rows, hold-out, fit, forecast, metrics,
    importances; the runs' rows go to ``out/runs``, the trees to
    ``out/models/<run_name>``, the forecast rows to ``out/forecasts/<run_name>``."""
    train, test = split(model_frame(features_ml), series, n_test)
    trees, pred = gbt_forecast(train, test, params, series=series)
    at = os.path.join(out, "forecasts", run_name)
    forecast_output(pred, series).write.mode("overwrite").parquet(at)
    forecast = spark.read.parquet(at)
    metrics = regression_metrics(forecast, "y", "yhat", series)
    ledger.append(ledger.record(metrics, run_name, dict(GBT_PARAMS, **(params or {})), series,
                                attempt, GBT_NAME, FEATURES), out)
    trees.write.mode("overwrite").parquet(os.path.join(out, "models", run_name))
    return {"metrics": metrics, "forecast": forecast,
            "importance": feature_importance(spark, trees)}


def ablation(df: DataFrame, series: Sequence[str], n_test: int,
             label: str = "no2_mitja") -> DataFrame:
    """Forecasts of the seasonal model without and with weather (``model``), both
    solved from one pass over the training rows."""
    return seasonal.forecast(holdout(df, series, "data", n_test), series, None, label)[1]


def run_seasonal_ablation(spark: SparkSession, features_ml: DataFrame, out: str,
                          series: Sequence[str] = (), n_test: int = TEST_DAYS,
                          attempt: str | None = None) -> DataFrame:
    """Seasonal model without and with weather: forecasts written, two runs in the
    ledger, and the relative MAE gain per series returned."""
    keys = list(series) or ["_tot"]
    df = features_ml if series else features_ml.withColumn("_tot", F.lit(1))
    both = os.path.join(out, "forecasts", "ablation")
    ablation(df, keys, n_test).write.mode("overwrite").parquet(both)
    for name, regs in ((WITHOUT, []), (WITH, WEATHER_REGRESSORS)):
        pred = spark.read.parquet(both).where(F.col("model") == name)
        forecast_output(pred, series).write.mode("overwrite").parquet(
            os.path.join(out, "forecasts", name))
        ledger.append(ledger.record(
            regression_metrics(pred, "y", "yhat", series), name,
            {"granularitat": "diaria", "regressors": ", ".join(regs) or "cap"}, series, attempt,
            "Estacional", regs), out)
    return ledger.gains(ledger.read(spark, out), WITHOUT, WITH)


# ---------------------------------------------------------------- driver queries
# The driver tables give 30 days per series, so the hold-out is the last 7
# days of each series; the learners are the same.

DRIVER_TEST_DAYS = 7
SERIES = ["magnitud"]


def _model_input(spark, base):
    """The daily feature table (a row per series and day), written to the
    shared checkpoint folder: every pass of a fit reads it."""
    ensure_checkpoint_dir(spark)
    return _features(spark, base).checkpoint(eager=True)


def _driver_gbt(spark, base):
    train, test = split(model_frame(_model_input(spark, base)), SERIES, DRIVER_TEST_DAYS)
    return gbt_forecast(train, test, series=SERIES)


@query("gbt_forecast")
def gbt_forecast_q(spark, base):
    _, pred = _driver_gbt(spark, base)
    return forecast_output(pred, SERIES)


@query("gbt_importance")
def gbt_importance_q(spark, base):
    trees, _ = _driver_gbt(spark, base)
    return feature_importance(spark, trees, top=8)


@query("seasonal_forecast")
def seasonal_forecast_q(spark, base):
    train, test = split(_model_input(spark, base), SERIES, DRIVER_TEST_DAYS)
    _, pred = seasonal_forecast(train, test, use_weather=True, series=SERIES)
    return forecast_output(pred, SERIES)


@query("weather_ablation")
def weather_ablation_q(spark, base):
    """Seasonal model without and with weather regressors: hold-out metrics per
    run and series, and the series' relative MAE gain."""
    pred = ablation(_model_input(spark, base), SERIES, DRIVER_TEST_DAYS)
    per = regression_metrics(pred, "y", "yhat", [*SERIES, "model"])
    mae = lambda name: F.max(F.when(F.col("model") == name, F.col("mae")))
    gain = F.try_divide((mae(WITHOUT) - mae(WITH)) * 100.0, mae(WITHOUT))
    return per.groupBy(*SERIES).agg(
        scaled_round(gain, 1).alias("millora_pct"),
        F.collect_list(F.struct("model", "mae", "rmse", "r2")).alias("_r")).select(
        *SERIES, F.inline("_r"), "millora_pct").withColumnRenamed("model", "run_name")


@query("seasonal_forecast_series")
def seasonal_forecast_series_q(spark, base):
    """One seasonal model per event type (the original fits one series),
    all series fitted in parallel."""
    pred = seasonal_forecast_by_series(_model_input(spark, base), SERIES, DRIVER_TEST_DAYS)
    return forecast_output(pred, SERIES)


@query("run_gain", S.with_(S.MEASURES, S.CAL, S.CONTEXT, S.FEATURES) + """
, h AS (
  SELECT magnitud, no2_mitja AS y, no2_lag1, no2_mm7,
         ROW_NUMBER() OVER (PARTITION BY magnitud ORDER BY data DESC) AS rn FROM feat),
e AS (
  SELECT magnitud,
         """ + S.rnd("AVG(ABS(y - no2_lag1)) FILTER (WHERE y IS NOT NULL AND no2_lag1 IS NOT NULL)", 4) + """ AS base,
         """ + S.rnd("AVG(ABS(y - no2_mm7)) FILTER (WHERE y IS NOT NULL AND no2_mm7 IS NOT NULL)", 4) + """ AS "new"
  FROM h WHERE rn <= 7 GROUP BY magnitud)
SELECT '{"magnitud":"' || magnitud || '"}' AS serie, 'mae' AS metrica, base, "new",
       """ + S.rnd("(base - \"new\") * 100.0 / base", 1) + """ AS millora_pct
FROM e WHERE base IS NOT NULL AND "new" IS NOT NULL""")
def run_gain_q(spark, base):
    """Two stored forecasts of the hold-out days (yesterday's value, the trailing
    week's mean) as two runs of a ledger, written twice, and the gain per series
    read from it."""
    out = scratch_path(spark, "run_gain")
    held = holdout(_model_input(spark, base), SERIES, "data", DRIVER_TEST_DAYS).where("es_test")
    runs = {"persistencia": "no2_lag1", "mitjana_7d": "no2_mm7"}
    held.select(*SERIES, "data", F.col("no2_mitja").alias("y"), F.explode(F.map_from_arrays(
        F.array(*map(F.lit, runs)), F.array(*map(F.col, runs.values())))).alias("run", "yhat")
    ).write.parquet(os.path.join(out, "forecasts"))
    stored = spark.read.parquet(os.path.join(out, "forecasts"))
    for name in [*runs, *runs]:
        metrics = regression_metrics(stored.where(F.col("run") == name), "y", "yhat", SERIES)
        ledger.append(ledger.record(metrics, name, {"dies_test": DRIVER_TEST_DAYS}, SERIES, "1",
                                    "Referencia"), out)
    return ledger.gains(ledger.read(spark, out), *runs)
