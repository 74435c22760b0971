"""The reference's tables re-derived from the driver tables, so every
operator runs on data that grows with the inputs.

Roles on ``events``:
  station -> ``user_id`` (as text), pollutant -> ``event_type``,
  day -> ``CAST(ts AS DATE)``, hour -> ``hour(ts) + 1``, reading -> ``value``.
Hourly weather stand-in: ``view`` events aggregated per (day, hour):
  temperatura = mean value, humitat = number of events, precipitacio = min
  value, vent_velocitat = max value, vent_direccio = mean ``props.k``,
  pressio = sum of values.
Event values carry two decimals, so means and sums are fixed-point (exact).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions.dates import date_key
from ..functions.json_fields import json_text
from ..functions.numeric import clean_double, exact_mean, exact_sum, scaled_round
from ..operators.reshape import in_range
from ..sources.tables import read_table
from . import gold

# Fixed values of the mapping.
CONTEXT_EVENT_TYPE = "view"
RAIN_THRESHOLD = 10.0          # stand-in precipitation above this counts as rain
CALM_BELOW, MODERATE_BELOW = 50.0, 150.0
SCALE = 2                      # decimals carried by event values
TARGET_POLLUTANT = "CLICK"     # the pollutant the analytic queries keep
MIN_HOURS = 18


def measures(spark: SparkSession, base: str) -> DataFrame:
    """Silver measurements from events: valid readings only (0 <= v < 1000,
    keys present)."""
    ev = read_table(spark, base, "events", ["ts", "user_id", "event_type", "value"])
    d = F.to_date("ts")
    return (ev.where(in_range("value") & F.col("user_id").isNotNull() & F.col("event_type").isNotNull())
              .select(
                  F.col("user_id").cast("string").alias("codi_eoi"),
                  F.col("event_type").alias("magnitud"),
                  F.upper("event_type").alias("contaminant"),
                  F.lit("events").alias("unitats"),
                  d.alias("data"),
                  date_key(d).alias("id_temps"),
                  (F.hour("ts") + 1).cast("int").alias("hora"),
                  F.col("value").alias("valor"),
              ))


def fact(spark: SparkSession, base: str) -> DataFrame:
    return gold.fact_measures(measures(spark, base), with_id=False)


def pollutants(spark: SparkSession, base: str) -> DataFrame:
    return gold.dim_pollutant(measures(spark, base))


def calendar(spark: SparkSession, base: str) -> DataFrame:
    return gold.dim_calendar(measures(spark, base))


def calendar_attributes(fact: DataFrame) -> DataFrame:
    """What ``fact ⋈ calendar`` adds, computed from the fact's own ``data``
    column. The calendar spans the fact's first to last day, so the inner
    join keeps every fact row; deriving the attributes saves the calendar's
    extra scan of the fact and a join."""
    d = F.col("data")
    return fact.withColumns({
        "dia_setmana_num": D.weekday0(d),
        "es_cap_setmana": D.is_weekend(d),
        "mes": F.month(d),
        "any_": F.year(d),
    })


def context_hours(spark: SparkSession, base: str) -> DataFrame:
    """The silver-weather stand-in: one row per (data, hora) with views."""
    ev = (read_table(spark, base, "events", ["ts", "event_type", "value", "props"])
          .where(F.col("event_type") == CONTEXT_EVENT_TYPE)
          .where(in_range("value")))
    d = F.to_date("ts")
    k = clean_double(json_text("props", "k"))
    return (ev.groupBy(d.alias("data"), (F.hour("ts") + 1).cast("int").alias("hora"))
              .agg(scaled_round(exact_mean("value", SCALE), 2).alias("temperatura"),
                   F.count(F.lit(1)).cast("double").alias("humitat"),
                   F.min("value").alias("precipitacio"),
                   F.max("value").alias("vent_velocitat"),
                   scaled_round(exact_mean(k, SCALE), 2).alias("vent_direccio"),
                   scaled_round(exact_sum("value", SCALE), 2).alias("pressio")))


def context(spark: SparkSession, base: str) -> DataFrame:
    """``dim_meteo`` stand-in keyed by (id_temps, hora)."""
    return gold.dim_weather(context_hours(spark, base), RAIN_THRESHOLD, CALM_BELOW,
                            MODERATE_BELOW)
