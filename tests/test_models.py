"""Forecast models on a synthetic daily series (weekly cycle + wind effect)."""

import datetime as dt
import math
import os

import pytest
from pyspark.sql import functions as F

from aerolith.operators import boosting, least_squares
from aerolith.operators.metrics import regression_metrics
from aerolith.plans import features as FE
from aerolith.plans import ledger, seasonal
from aerolith.plans import models as M


@pytest.fixture(scope="module")
def daily(spark):
    rows = []
    start = dt.date(2024, 1, 1)
    for i in range(200):
        d = start + dt.timedelta(days=i)
        wind = 3.0 + (i * 7 % 11)
        y = 40 + 8 * math.sin(2 * math.pi * i / 7) - 1.5 * wind + (i % 5) * 0.3
        rows.append(("s", d, round(y, 2), round(y + 5, 2), 15.0 + (i % 9), 60.0, float(i % 3 == 0),
                     wind, wind + 4, 1010.0 + (i % 4), (d.isoweekday() % 7), d.isoweekday() % 7 in (0, 6),
                     d.month, d.year, 24))
    df = spark.createDataFrame(rows, "k string, data date, no2_mitja double, no2_max double, "
                               "temperatura double, humitat double, precipitacio double, "
                               "vent_velocitat double, vent_max double, pressio double, "
                               "dia_setmana_num int, es_cap_setmana boolean, mes int, any_ int, "
                               "hores_amb_dada long")
    return FE.ml_features(df, ["k"])


def test_split_keeps_last_days(daily):
    train, test = M.split(M.model_frame(daily), ["k"], 30)
    assert test.count() == 30
    assert train.agg(F.max("data")).first()[0] < test.agg(F.min("data")).first()[0]


def test_gbt_forecast_and_importance(spark, daily):
    train, test = M.split(M.model_frame(daily), ["k"], 30)
    trees, pred = M.gbt_forecast(train, test, params={"rounds": 60})
    out = M.forecast_output(pred, [])
    assert out.count() == 30 and {"y", "yhat", "limit_ue"} <= set(out.columns)
    assert regression_metrics(out, "y", "yhat").first().r2 > 0.8
    imp = M.feature_importance(spark, trees, top=None).collect()
    assert [r.importancia for r in imp] == sorted((r.importancia for r in imp), reverse=True)
    assert sum(r.importancia for r in imp) == pytest.approx(1.0)
    assert M.feature_importance(spark, trees).count() == 8
    assert trees.select("tree").distinct().count() == 61


def test_gbt_fits_each_series_and_forecasts_missing_features(spark, daily):
    """NULLs follow the side their node learned: a feature that is missing on half of
    the days tells those days apart, and rows without any feature get a forecast."""
    step = daily.withColumn("vent_max", F.when(F.dayofyear("data") % 2 == 0, F.col("vent_max"))) \
        .withColumn("no2_mitja", F.when(F.dayofyear("data") % 2 == 0, 10.0).otherwise(50.0))
    two = step.unionByName(step.withColumn("k", F.lit("t")).withColumn("no2_mitja", F.col("no2_mitja") + 100))
    train, test = M.split(M.model_frame(two), ["k"], 30)
    blank = test.limit(1).select(*[F.lit(None).cast(test.schema[c].dataType).alias(c)
                                   if c in M.FEATURES else F.col(c) for c in test.columns])
    trees, pred = M.gbt_forecast(train, test.unionByName(blank), series=["k"])
    rows = pred.collect()
    assert len(rows) == 61 and all(r.yhat is not None for r in rows)
    by = regression_metrics(pred.where("no2_lag1 IS NOT NULL"), "y", "yhat", ["k"]).collect()
    assert len(by) == 2 and all(r.r2 > 0.95 for r in by)
    # A second scoring from the stored trees gives the same.
    again = boosting.predict_series(test, trees, ["k"], M.FEATURES, M.GBT_PARAMS["depth"])
    assert {(r.k, r.data, r.yhat) for r in again.collect()} <= {(r.k, r.data, r.yhat) for r in rows}


def test_tree_takes_the_best_split():
    """Every split's gain is the largest over all features, cuts and sides."""
    import numpy as np
    rng = np.random.default_rng(4)
    x = rng.integers(0, 6, (60, 3)).astype(float)
    x[rng.random((60, 3)) < 0.2] = np.nan
    y = np.where(np.isnan(x[:, 1]), 5.0, np.nan_to_num(x[:, 0], nan=2.0)) + rng.normal(0, 0.1, 60)
    codes, cuts = boosting._binned(x)
    tree = boosting.grow(codes, cuts, -y, np.arange(3), 2, 1.0)

    def gain(rows):
        best, score = 0.0, lambda g: g.sum() ** 2 / (len(g) + boosting.LAMBDA)
        for j in range(3):
            for c in [*np.unique(x[~np.isnan(x[:, j]), j]), np.inf]:
                for side in (False, True):
                    left = np.where(np.isnan(x[rows, j]), side, x[rows, j] < c)
                    if left.any() and not left.all():
                        best = max(best, score(y[rows][left]) + score(y[rows][~left]) - score(y[rows]))
        return best
    node = np.ones(60, int)
    for k in (1, 2, 3):
        rows = np.flatnonzero(node == k)
        assert tree.gain[k] == pytest.approx(gain(rows), abs=1e-6)
        if tree.feature[k] < 0:
            continue
        v = x[rows, tree.feature[k]]
        node[rows] = 2 * k + ~np.where(np.isnan(v), tree.missing_left[k], v < tree.threshold[k])
    assert (tree.route(x) == node).all()
    for k in np.unique(node):
        own = y[node == k]
        assert tree.value[k] == pytest.approx(own.sum() / (len(own) + boosting.LAMBDA))


def test_seasonal_forecast_band_and_ablation(spark, daily):
    train, test = M.split(daily, ["k"], 30)
    _, p0 = M.seasonal_forecast(train, test, use_weather=False)
    _, p1 = M.seasonal_forecast(train, test, use_weather=True)
    rows = p1.collect()
    assert len(rows) == 30 and all(r.yhat_lower < r.yhat < r.yhat_upper for r in rows)
    m0 = regression_metrics(p0, "y", "yhat").first()
    m1 = regression_metrics(p1, "y", "yhat").first()
    # the series depends on wind, so the weather regressors must help
    assert m1.mae < m0.mae and m1.r2 > 0.9


def test_empty_training_set_gives_empty_forecast(spark, daily):
    empty = daily.where(F.lit(False))
    trees, pred = M.gbt_forecast(empty, daily)
    assert trees.count() == 0 and pred.count() == daily.count()
    assert pred.where("yhat IS NOT NULL").count() == 0
    assert M.feature_importance(spark, trees).count() == 0
    _, pred = M.seasonal_forecast(empty, daily)
    assert pred.count() == daily.count() and pred.where("yhat IS NOT NULL").count() == 0


def test_logged_runs(spark, scratch, daily):
    out = os.path.join(scratch, "models")
    two = daily.unionByName(daily.withColumn("k", F.lit("t")).withColumn(
        "no2_mitja", F.col("no2_mitja") + 3 * (F.dayofyear("data") % 4)))
    res = M.run_gbt(spark, two, out, ["k"], n_test=30, params={"rounds": 5}, attempt="a")
    assert res["forecast"].count() == 60
    gains = {r.serie: r for r in M.run_seasonal_ablation(
        spark, two, out, ["k"], n_test=30, attempt="a").collect()}
    assert set(gains) == {'{"k":"s"}', '{"k":"t"}'}
    assert gains['{"k":"s"}'].millora_pct > 0
    assert gains['{"k":"s"}'].millora_pct != gains['{"k":"t"}'].millora_pct
    runs = ledger.read(spark, out)
    before = sorted(map(str, runs.collect()))
    assert len(before) == 6
    assert {r.run_name for r in runs.collect()} == {
        "gbt_amb_lags", "seasonal_sense_meteo", "seasonal_amb_meteo"}
    r = runs.where("run_name = 'gbt_amb_lags'").first()
    assert (r.algoritme, r.num_features) == ("GBT", 17)
    assert r.features == "no2_lag1, no2_lag2, no2_lag7, no2_mm3, no2_mm7..."
    assert r.params["rounds"] == "5" and set(r.metrics) == {"mae", "rmse", "mape", "r2"}
    # The same attempt again changes nothing; a new attempt adds its rows.
    M.run_seasonal_ablation(spark, two, out, ["k"], n_test=30, attempt="a")
    assert sorted(map(str, ledger.read(spark, out).collect())) == before
    M.run_seasonal_ablation(spark, two, out, ["k"], n_test=30, attempt="b")
    assert ledger.read(spark, out).count() == 10
    assert os.path.isdir(os.path.join(out, "models", "gbt_amb_lags"))


def test_gain_of_the_last_attempt_per_series(spark):
    rows = lambda mae: spark.createDataFrame(
        [("s", mae), ("t", 2 * mae)], "k string, mae double")
    runs = ledger.record(rows(20.0), "base", {}, ["k"], "1").unionByName(
        ledger.record(rows(10.07), "base", {}, ["k"], "2")).unionByName(
        ledger.record(rows(8.54).where("k = 's'"), "new", {}, ["k"], "1"))
    (gain,) = ledger.gains(runs, "base", "new").collect()
    assert (gain.serie, gain.base, gain.new, gain.millora_pct) == ('{"k":"s"}', 10.07, 8.54, 15.2)


def test_per_series_seasonal_models(spark, daily):
    two = daily.unionByName(daily.withColumn("k", F.lit("t"))
                            .withColumn("no2_mitja", F.col("no2_mitja") + 100))
    pred = M.seasonal_forecast_by_series(two, ["k"], 30).collect()
    assert len(pred) == 60
    by = {}
    for r in pred:
        by.setdefault(r.k, []).append(r)
    # each series gets its own level: the shifted series is forecast ~100 higher
    mean = lambda rs: sum(r.yhat for r in rs) / len(rs)
    assert 90 < mean(by["t"]) - mean(by["s"]) < 110
    assert all(r.yhat_lower < r.yhat < r.yhat_upper for r in pred)
    m = regression_metrics(spark.createDataFrame(pred), "y", "yhat", ["k"]).collect()
    assert all(r.r2 > 0.5 for r in m)


@pytest.fixture(scope="module")
def broken(spark):
    """Two series over two years whose trends break at different days."""
    start, rows = dt.date(2022, 1, 1), []
    for k, at, up, down in (("a", 250, 0.10, -0.12), ("b", 400, -0.05, 0.15)):
        for i in range(730):
            y = 60 + up * min(i, at) + down * max(i - at, 0) + 3 * math.sin(2 * math.pi * i / 7)
            rows.append((k, start + dt.timedelta(days=i), y + ((i * 37) % 11 - 5) * 0.2,
                         5.0 + i % 7, 10.0, 0.0, 1010.0))
    return spark.createDataFrame(rows, "k string, data date, no2_mitja double, vent_velocitat double, "
                                       "temperatura double, precipitacio double, pressio double")


def test_changepoint_trend_follows_breaks(spark, broken):
    pred = M.seasonal_forecast_by_series(broken, ["k"], 60, use_weather=False)
    m = regression_metrics(pred, "y", "yhat", ["k"]).collect()
    # Hold-out days whose level lies far from where a straight trend ends.
    assert len(m) == 2 and all(r.r2 > 0.9 for r in m), m
    coefs, _ = seasonal.forecast(M.holdout(broken, ["k"], "data", 60), ["k"], False)
    bends = seasonal.trend_bends(coefs, ["k"], least=0.2).collect()
    for k, at in (("a", 250 / 669), ("b", 400 / 669)):
        mine = [(abs(r.canvi), r.position) for r in bends if r.k == k]
        assert mine and abs(max(mine)[1] - at) < 0.08


def test_gram_is_the_sum_of_products(spark):
    import numpy as np
    rows = [("a" if i % 3 else None, [float(i), float(i * i % 7), 1.0]) for i in range(50)]
    df = spark.createDataFrame([*rows, ("a", None), ("a", [1.0, float("nan"), 2.0])],
                               "k string, z array<double>").repartition(4)
    for r in least_squares.gram(df, ["k"], "z").collect():
        z = np.array([v for k, v in rows if k == r.k])
        assert r.gram == pytest.approx((z.T @ z)[np.triu_indices(3)].tolist())


def test_ablation_reads_the_rows_once(spark, broken, scratch):
    """Both models come from the same sums: one scan and one exchange of the rows
    per series; the forecast rows reuse it. The models equal separate fits."""
    at = os.path.join(scratch, "broken")
    broken.write.mode("overwrite").parquet(at)
    pred = M.ablation(spark.read.parquet(at), ["k"], 60)
    rows = pred.collect()
    assert len(rows) == 240
    plan = pred._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 1 and "ReusedExchange" in final
    for name, weather in ((seasonal.WITHOUT, False), (seasonal.WITH, True)):
        alone = {(r.k, r.data): r.yhat for r in M.seasonal_forecast_by_series(
            broken, ["k"], 60, use_weather=weather).collect()}
        mine = {(r.k, r.data): r.yhat for r in rows if r.model == name}
        assert set(alone) == set(mine)
        assert all(mine[k] == pytest.approx(alone[k], abs=1e-6) for k in mine)
