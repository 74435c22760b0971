"""Daily model features for every series at once.

The original builds one series (one station, one pollutant) with windows
over the whole table. Here the series key is a parameter: the daily base is
grouped by ``series + [data]`` and every window is partitioned by the
series, so each window partition holds one row per day of one series.
Filtering the result to one station and pollutant gives the single-series
table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import day_of_year_cos, day_of_year_sin
from ..functions.numeric import (exact_mean, exact_sum, parts_mean, safe_corr, scaled_round,
                                 weighted_mean, weighted_sum)
from ..operators.star import per_key, pruned
from ..operators.windows import add_lags, add_trailing_means, frame_mean


def star(fact: DataFrame, pollutants: DataFrame | None, stations: DataFrame | None,
         calendar: DataFrame, weather: DataFrame, pollutant: str | None = None,
         station: str | None = None) -> DataFrame:
    """fact ⋈ pollutant ⋈ station ⋈ calendar ⋈ hourly weather (inner, as the
    original). The filters sit on the small dimensions; Catalyst moves them
    ahead of the joins and AQE broadcasts the dimensions once their
    measured size is known. A dimension passed as None is not joined (use
    it only when every fact key is known to be present in it)."""
    out = fact
    if pollutants is not None:
        p = pollutants.select("magnitud", "contaminant")
        if pollutant is not None:
            p = p.where(F.col("contaminant") == pollutant)
        out = out.join(p, "magnitud")
    if stations is not None:
        s = stations.select("codi_eoi", "nom_estacio")
        if station is not None:
            s = s.where(F.col("nom_estacio") == station)
        out = out.join(s, "codi_eoi")
    cal = calendar.select("id_temps", "data", "dia_setmana_num", "es_cap_setmana", "mes",
                          F.col("any").alias("any_"))
    out = out.join(cal, "id_temps")
    return out.join(weather, ["id_temps", "hora"])


def daily_base(joined: DataFrame, series: Sequence[str] = (), min_hours: int = 18,
               scale: int | None = None) -> DataFrame:
    """One row per series and day with at least ``min_hours`` matched hours."""
    r2 = lambda c: scaled_round(c, 2)
    base = joined.groupBy(*series, "data").agg(
        r2(exact_mean("valor", scale)).alias("no2_mitja"),
        r2(F.max("valor")).alias("no2_max"),
        r2(exact_mean("temperatura", scale)).alias("temperatura"),
        r2(exact_mean("humitat", scale)).alias("humitat"),
        r2(exact_sum("precipitacio", scale)).alias("precipitacio"),
        r2(exact_mean("vent_velocitat", scale)).alias("vent_velocitat"),
        r2(F.max("vent_velocitat")).alias("vent_max"),
        r2(exact_mean("pressio", scale)).alias("pressio"),
        F.any_value("dia_setmana_num", True).alias("dia_setmana_num"),
        F.any_value("es_cap_setmana", True).alias("es_cap_setmana"),
        F.any_value("mes", True).alias("mes"),
        F.any_value("any_", True).alias("any_"),
        F.count(F.lit(1)).alias("hores_amb_dada"),
    )
    return base.where(F.col("hores_amb_dada") >= min_hours)


def star_daily(fact: DataFrame, pollutants: DataFrame | None, stations: DataFrame | None,
               calendar: DataFrame, weather: DataFrame, series: Sequence[str] = (),
               min_hours: int = 18, scale: int | None = None, pollutant: str | None = None,
               station: str | None = None) -> DataFrame:
    """``daily_base(star(...))`` for series that are no single stations, without
    moving the fact: the pollutants' and stations' keys are filters of its scan, and
    its readings are summed per (series, day, hour) before they meet the calendar
    and the weather."""
    f = fact
    if pollutants is not None:
        f = pruned(f, pollutants, "magnitud", F.lit(True) if pollutant is None
                   else F.col("contaminant") == pollutant)
    if stations is not None:
        f = pruned(f, stations, "codi_eoi", F.lit(True) if station is None
                   else F.col("nom_estacio") == station)
    sums = per_key(f, [*series, "id_temps", "hora"], {"valor": scale})
    cal = calendar.select("id_temps", "data", "dia_setmana_num", "es_cap_setmana", "mes",
                          F.col("any").alias("any_"))
    return daily_of_sums(sums.join(weather, ["id_temps", "hora"]).join(cal, "id_temps"),
                         series, min_hours, scale)


def daily_of_sums(joined: DataFrame, series: Sequence[str] = (), min_hours: int = 18,
                  scale: int | None = None) -> DataFrame:
    """``daily_base`` from rows that stand for ``_rows`` readings each."""
    r2 = lambda c: scaled_round(c, 2)
    mean = lambda c: r2(weighted_mean(c, "_rows", scale)).alias(c)
    base = joined.groupBy(*series, "data").agg(
        r2(parts_mean("valor", scale)).alias("no2_mitja"),
        r2(F.max("valor_max")).alias("no2_max"),
        mean("temperatura"), mean("humitat"),
        r2(weighted_sum("precipitacio", "_rows", scale)).alias("precipitacio"),
        mean("vent_velocitat"), r2(F.max("vent_velocitat")).alias("vent_max"), mean("pressio"),
        F.any_value("dia_setmana_num", True).alias("dia_setmana_num"),
        F.any_value("es_cap_setmana", True).alias("es_cap_setmana"),
        F.any_value("mes", True).alias("mes"),
        F.any_value("any_", True).alias("any_"),
        F.sum("_rows").cast("long").alias("hores_amb_dada"),
    )
    return base.where(F.col("hores_amb_dada") >= min_hours)


def ml_features(base: DataFrame, series: Sequence[str] = (), scale: int | None = 2) -> DataFrame:
    """Row-based lags (a missing day is skipped, not NULL), trailing means
    over the previous 3 and 7 rows, previous-day weather and the day-of-year
    angle. All windows share one spec, so Spark sorts once."""
    out = add_lags(base, series, "data", {
        "no2_lag1": ("no2_mitja", 1),
        "no2_lag2": ("no2_mitja", 2),
        "no2_lag7": ("no2_mitja", 7),
    })
    out = add_trailing_means(out, series, "data", {
        "no2_mm3": ("no2_mitja", 3),
        "no2_mm7": ("no2_mitja", 7),
    }, digits=2, scale=scale)
    out = add_lags(out, series, "data", {
        "vent_lag1": ("vent_velocitat", 1),
        "precip_lag1": ("precipitacio", 1),
    })
    return out.withColumns({
        "dia_any_sin": day_of_year_sin("data"),
        "dia_any_cos": day_of_year_cos("data"),
    })


def calendar_gap_features(base: DataFrame, series: Sequence[str] = (),
                          scale: int | None = 2) -> DataFrame:
    """Variant where a lag of n means n calendar days and the trailing means
    cover the previous 3 / 7 calendar days (missing days are skipped, not
    filled). Expressed with RANGE frames over a day number on the same
    per-series window, so there is no calendar grid and no join: the lag is
    the row exactly n days back, the mean covers days d-k .. d-1."""
    dn = F.datediff(F.col("data"), F.lit("1970-01-01").cast("date"))
    w = (Window.partitionBy(*series) if series else Window.partitionBy()).orderBy("_dn")

    def back(c: str, n: int):
        return F.max(c).over(w.rangeBetween(-n, -n))

    def trailing(c: str, k: int):
        return scaled_round(frame_mean(c, w.rangeBetween(-k, -1), scale), 2)

    out = base.withColumn("_dn", dn).withColumns({
        "no2_lag1": back("no2_mitja", 1),
        "no2_lag2": back("no2_mitja", 2),
        "no2_lag7": back("no2_mitja", 7),
        "no2_mm3": trailing("no2_mitja", 3),
        "no2_mm7": trailing("no2_mitja", 7),
        "vent_lag1": back("vent_velocitat", 1),
        "precip_lag1": back("precipitacio", 1),
        "dia_any_sin": day_of_year_sin("data"),
        "dia_any_cos": day_of_year_cos("data"),
    })
    return out.drop("_dn")


def lag_correlations(features: DataFrame, series: Sequence[str] = (), digits: int = 3) -> DataFrame:
    """Correlation of the target with its lag, trailing means and weather,
    over rows whose 7-day lag exists."""
    r = lambda c: scaled_round(c, digits)
    return (features.where(F.col("no2_lag7").isNotNull()).groupBy(*series).agg(
        r(safe_corr("no2_mitja", "no2_lag1")).alias("lag1"),
        r(safe_corr("no2_mitja", "no2_mm3")).alias("mitjana_3d"),
        r(safe_corr("no2_mitja", "no2_mm7")).alias("mitjana_7d"),
        r(safe_corr("no2_mitja", "vent_velocitat")).alias("vent"),
        r(safe_corr("no2_mitja", "temperatura")).alias("temperatura"),
    ))
