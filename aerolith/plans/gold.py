"""Gold layer: star schema over the silver measurements.

Dimensions are aggregates whose size follows the number of stations,
pollutants, days or hours, never the number of readings. The fact keeps one
row per reading and gets a dense id without a single-partition window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..functions.dates import date_key, rain_flag, wind_category
from ..operators.aggregates import dim_by_key
from ..operators.calendar import calendar_dim
from ..operators.dense_id import dense_ids

STATION_ATTRIBUTES = ("nom_estacio", "tipus_estacio", "area_urbana", "municipi",
                      "nom_comarca", "altitud")


def dim_station(silver: DataFrame, scale: int | None = None) -> DataFrame:
    return dim_by_key(silver, "codi_eoi", STATION_ATTRIBUTES, ("latitud", "longitud"),
                      digits=6, scale=scale)


def dim_pollutant(silver: DataFrame) -> DataFrame:
    return dim_by_key(silver, "magnitud", ("contaminant", "unitats"))


def dim_calendar(silver: DataFrame, date_col: str = "data") -> DataFrame:
    return calendar_dim(silver, date_col)


def fact_measures(silver: DataFrame, with_id: bool = True, checkpoint: bool = True) -> DataFrame:
    """``fets_mesures``. Pass ``checkpoint=False`` only when ``silver`` is a
    plain scan of written files: its splits, and so the ids, are then the
    same on every evaluation and task retry."""
    fact = silver.select(
        "codi_eoi", "magnitud", date_key("data").alias("id_temps"), "hora", "valor")
    if not with_id:
        return fact
    return dense_ids(fact, "id_mesura", checkpoint=checkpoint).select(
        "id_mesura", "codi_eoi", "magnitud", "id_temps", "hora", "valor")


def dense_ids_fact(silver_files: DataFrame) -> DataFrame:
    return fact_measures(silver_files, with_id=True, checkpoint=False)


def dim_weather(silver_weather: DataFrame, rain_threshold: float = 0.0,
                calm_below: float = 5.0, moderate_below: float = 15.0,
                measures: Sequence[str] = ("temperatura", "humitat", "precipitacio",
                                           "vent_velocitat", "vent_direccio", "pressio"),
                date_col: str = "data") -> DataFrame:
    """Hourly weather keyed by ``(id_temps, hora)`` with the rain flag and the
    wind category (NULL wind falls into the last bucket, NULL rain is dry)."""
    return silver_weather.select(
        date_key(date_col).alias("id_temps"), "hora", *measures,
        rain_flag("precipitacio", rain_threshold).alias("plou"),
        wind_category("vent_velocitat", calm_below, moderate_below).alias("categoria_vent"),
    )
