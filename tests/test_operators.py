"""Operator-level tests on tiny in-memory frames with hand-computed results."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerolith.functions import dates as D
from aerolith.functions.numeric import (clean_double, exact_mean, pct, safe_corr,
                                        scaled_round, text_to_int)
from aerolith.operators import quality as Q
from aerolith.operators.aggregates import distribution, gap_audit
from aerolith.operators.calendar import calendar_dim
from aerolith.operators.dense_id import dense_ids
from aerolith.operators.joins import coverage, last_days, with_total
from aerolith.operators.metrics import regression_metrics
from aerolith.operators.reshape import unpivot_hours, valid_measurements
from aerolith.operators.windows import add_lags, add_trailing_means, holdout
from aerolith.plans.features import calendar_gap_features


def test_scaled_round_is_binary(spark):
    df = spark.createDataFrame([(1.005,), (0.285,), (2.5,), (-2.5,)], "x double")
    got = [r[0] for r in df.select(scaled_round("x", 2)).collect()]
    assert got == [1.0, 0.28, 2.5, -2.5]
    assert df.select(scaled_round("x", 0)).collect()[2][0] == 3.0


def test_exact_mean_order_independent(spark):
    vals = [(0.1,), (0.2,), (0.3,), (None,)]
    base = spark.createDataFrame(vals, "x double")
    got = {base.repartition(n).agg(exact_mean("x", 2)).first()[0] for n in (1, 2, 3)}
    assert got == {(60 / 100.0) / 3.0}               # same bits for any split


def test_clean_double(spark):
    df = spark.createDataFrame([("12.5",), ("",), ("n/a",), ("12d",), ("1_000",), (" 7 ",),
                                ("1e3",), ("NaN",), (None,)], "s string")
    got = [r[0] for r in df.select(clean_double("s")).collect()]
    assert got == [12.5, None, None, None, 1000.0, 7.0, 1000.0, None, None]
    assert spark.range(1).select(text_to_int(F.lit("25.6"))).first()[0] == 26


def test_safe_corr_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "y double, x double")
    assert df.agg(safe_corr("y", "x")).first()[0] is None
    df2 = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.5)], "y double, x double")
    expected = float(np.corrcoef([1.0, 2.0, 3.0], [2.0, 4.0, 6.5])[0, 1])
    assert df2.agg(safe_corr("y", "x")).first()[0] == pytest.approx(expected, rel=1e-12)


def test_pct(spark):
    assert spark.range(1).select(pct(F.lit(1), F.lit(3))).first()[0] == 33.3
    assert spark.range(1).select(pct(F.lit(1), F.lit(0))).first()[0] is None


def test_unpivot_hours_and_filter(spark):
    df = spark.createDataFrame(
        [("A", "12.5", None, "", "n/a", "-1", "1000", "999.9", "0", "NaN")],
        "k string, h03 string, h04 string, h05 string, h06 string, h07 string, "
        "h08 string, h09 string, h10 string, h11 string")
    hours = [f"h{i:02d}" for i in range(3, 12)]
    long = unpivot_hours(df, ["k"], hours)
    assert long.count() == 8                         # NULL cell dropped by unpivot
    kept = valid_measurements(long, "valor", ["k"])
    assert sorted((r.hora, r.valor) for r in kept.collect()) == [(3, 12.5), (9, 999.9), (10, 0.0)]


def test_calendar_and_parts(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 3),)], "d date")
    cal = calendar_dim(df, "d").orderBy("data").collect()
    assert [r.id_temps for r in cal] == [20240101, 20240102, 20240103]
    sun = calendar_dim(spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date"), "d").first()
    assert (sun.dia_setmana_num, sun.dia_setmana, sun.es_cap_setmana, sun.estacio_any) == (
        0, "Sunday", True, "Hivern")
    months = spark.createDataFrame([(m,) for m in (1, 3, 6, 9, 12)], "m int")
    assert [r[0] for r in months.select(D.season("m")).collect()] == [
        "Hivern", "Primavera", "Estiu", "Tardor", "Hivern"]


def test_wind_and_rain(spark):
    df = spark.createDataFrame([(4.9, 0.0), (5.0, 0.1), (15.0, None), (None, 1.0)],
                               "w double, p double")
    got = [(r[0], r[1]) for r in df.select(D.wind_category("w"), D.rain_flag("p")).collect()]
    assert got == [("Calma", False), ("Moderat", True), ("Fort", False), ("Fort", True)]


def test_dense_ids(spark):
    df = spark.range(0, 1000, numPartitions=7)
    ids = dense_ids(df, "id_mesura")
    agg = ids.agg(F.min("id_mesura"), F.max("id_mesura"), F.count_distinct("id_mesura")).first()
    assert tuple(agg) == (1, 1000, 1000)


def test_lags_and_trailing_means(spark):
    rows = [("s", dt.date(2024, 1, d), float(v)) for d, v in [(1, 1), (2, 2), (3, 3), (4, 4), (5, 5)]]
    rows += [("t", dt.date(2024, 1, 1), 10.0)]
    df = spark.createDataFrame(rows, "k string, data date, y double")
    out = add_lags(df, ["k"], "data", {"lag1": ("y", 1)})
    out = add_trailing_means(out, ["k"], "data", {"mm3": ("y", 3)})
    s = out.where("k = 's'").orderBy("data").collect()
    assert [r.lag1 for r in s] == [None, 1, 2, 3, 4]
    assert [r.mm3 for r in s] == [None, 1, 1.5, 2, 3]
    assert out.where("k = 't'").first().lag1 is None   # series do not leak


def test_calendar_gap_variant(spark):
    rows = [("s", dt.date(2024, 1, d), float(d)) for d in (1, 2, 4)]
    df = spark.createDataFrame(rows, "k string, data date, no2_mitja double")
    df = df.withColumns({c: F.lit(None).cast("double") for c in ("vent_velocitat", "precipitacio")})
    out = calendar_gap_features(df, ["k"]).orderBy("data").collect()
    assert [r.data.day for r in out] == [1, 2, 4]
    assert [r.no2_lag1 for r in out] == [None, 1.0, None]   # day 3 is missing
    assert [r.no2_lag2 for r in out] == [None, None, 2.0]   # two calendar days back
    assert [r.no2_mm3 for r in out] == [None, 1.0, 1.5]     # days 1-3 hold 1 and 2


def test_holdout(spark):
    df = spark.createDataFrame([("s", d) for d in range(10)], "k string, d int")
    h = holdout(df, ["k"], "d", 3)
    assert sorted(r.d for r in h.where("es_test").collect()) == [7, 8, 9]


def test_regression_metrics(spark):
    df = spark.createDataFrame([(10.0, 12.0), (20.0, 16.0)], "y double, yhat double")
    m = regression_metrics(df, "y", "yhat").first()
    assert (m.mae, m.rmse, m.mape, m.r2) == (3.0, 3.1623, 20.0, 0.6)


def test_quality_report(spark):
    df = spark.createDataFrame([(41.0, 1), (39.0, 25), (None, None)], "lat double, hora int")
    rep = Q.check_report(df, [("lat", Q.outside("lat", 40, 43)), ("hora", Q.outside("hora", 1, 24)),
                              ("nuls", Q.any_null("lat", "hora"))])
    got = {r["check"]: (r.violacions, r.ok) for r in rep.collect()}
    assert got == {"lat": (1, False), "hora": (1, False), "nuls": (1, False)}
    with pytest.raises(AssertionError):
        Q.raise_on_failure(rep)
    dup = Q.key_uniqueness(spark.createDataFrame([(1,), (1,), (2,)], "k int"), ["k"], "k").first()
    assert dup.violacions == 1


def test_coverage_counts_duplicate_matches(spark):
    fact = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "id_temps int, hora int")
    dim = spark.createDataFrame([(1, 1), (1, 1), (1, 2)], "id_temps int, hora int")
    c = coverage(fact, dim, ["id_temps", "hora"]).first()
    assert (c.amb_context, c.total_fets, c.percentatge) == (3, 3, 100.0)


def test_totals_last_days_gaps(spark):
    df = spark.createDataFrame([("a", dt.date(2024, 1, d)) for d in (1, 2, 5, 20)], "k string, d date")
    assert {r.total for r in with_total(df).collect()} == {4}
    assert last_days(df, "d", 15).count() == 2
    g = gap_audit(df, "d", ["k"]).first()
    assert (g.dies_esperats, g.dies_amb_dades) == (20, 4)


def test_distribution(spark):
    df = spark.createDataFrame([(0.0,), (4.0,), (6.0,), (10.0,)], "v double")
    r = distribution(df, "v").first()
    assert (r.minim, r.mitjana, r.mediana, r.maxim, r.num_zeros, r.num_sota_5) == (
        0.0, 5.0, 5.0, 10.0, 1, 2)
    assert r.desviacio == 4.2


@pytest.mark.parametrize("n", [1, 7, 50, 199, 200, 500])
def test_top_n_matches_a_sort(spark, n):
    from aerolith.operators.topn import top_n
    rows = [(d % 13 if d % 17 else None, (d * 7) % 31, d) for d in range(200)]
    df = spark.createDataFrame(rows, "a int, b int, k int").repartition(5)
    got = sorted(r.k for r in top_n(df, n, [("a", True), ("b", False), ("k", False)]).collect())
    key = lambda r: (r[0] is None, -(r[0] or 0), r[1], r[2])  # noqa: E731  a desc nulls last
    want = sorted(r[2] for r in sorted(rows, key=key)[:n])
    assert got == want


@pytest.mark.parametrize("buckets", [2, 1024])
def test_exact_quantiles(spark, buckets):
    import math
    import random

    import numpy as np
    from aerolith.operators.quantile import exact_quantile

    rng = random.Random(buckets)
    groups = {
        "even": [1.0, 2.0, 10.0, 4.0], "one": [7.5], "ties": [3.0] * 50 + [4.0] * 50,
        "zeros": [0.0, -0.0, 0.0], "wide": [-1.7e308, 1.7e308, 5e-324, 0.0, 1e300],
        "hot": [round(rng.lognormvariate(0, 3), 2) for _ in range(4001)],
        None: [rng.gauss(0, 1) for _ in range(100)], "empty": []}
    rows = [(k, v) for k, vs in groups.items() for v in vs]
    rows += [("empty", None), ("even", None), ("one", float("nan"))]
    df = spark.createDataFrame(rows, "k string, v double").repartition(6)
    for p in (0.5, 0.25, 1.0):
        found = {r.k: r.mediana for r in exact_quantile(df, "v", ["k"], p, buckets=buckets).collect()}
        assert set(found) == set(groups)
        for k, vs in groups.items():
            if not vs:
                assert found[k] is None
            elif k == "wide":
                assert p != 0.5 or found[k] == 5e-324
            else:
                assert math.isclose(found[k], float(np.quantile(vs, p)), rel_tol=1e-12, abs_tol=1e-300)
    assert exact_quantile(df, "v").first().mediana is not None
    assert exact_quantile(df.where("k = 'even'"), "v").first().mediana == 3.0
    assert exact_quantile(df.limit(0), "v", ["k"]).count() == 0


def test_sums_per_key_then_combined_are_exact(spark):
    from aerolith.functions.numeric import exact_mean, parts_mean, parts_sum, weighted_mean
    from aerolith.operators.star import corr_of_sums, per_key, pruned

    rows = [(i % 7, i % 3, (i * 37 % 1000) / 100, None if i % 11 == 0 else float(i % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k int, g int, v double, w double")
    dim = spark.createDataFrame([(k, float(k * k), k % 2 == 0) for k in range(6)], "k int, x double, even boolean")
    plain = df.join(dim, "k").agg(exact_mean("v").alias("m"), exact_mean("x").alias("x"),
                                  F.corr("v", "x").alias("c")).first()
    sums = per_key(df, ["k"], {"v": 2, "w": None}, squares=True).join(dim, "k")
    got = sums.agg(parts_mean("v").alias("m"), weighted_mean("x", "_rows").alias("x"),
                   corr_of_sums("v", "x").alias("c"), parts_sum("w", None).alias("w")).first()
    assert (got.m, got.x) == (plain.m, plain.x) and got.c == pytest.approx(plain.c)
    assert got.w == sum(r[3] or 0 for r in rows if r[0] < 6)
    for most in (1000, 1):
        kept = pruned(df, dim, "k", F.col("even"), most)
        assert kept.count() == sum(r[0] in (0, 2, 4) for r in rows)
    assert pruned(df, dim, "k", F.lit(False)).count() == 0
