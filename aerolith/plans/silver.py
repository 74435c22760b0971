"""Silver layer: long, typed, cleaned measurements and hourly weather.

``silver_measures``: wide text records -> one row per station, pollutant,
day and hour, units normalised, mis-scaled coordinates repaired, invalid
readings dropped. Narrow transformations only (no shuffle).
``silver_weather``: hourly weather rows -> typed rows, hour labels 1-24.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import text_to_int
from ..operators import quality as Q
from ..operators.reshape import hour_columns, unpivot_hours, valid_measurements
from ..sources.schemas import AIR_ATTRIBUTES

# Unit spelling repaired to the micro sign U+00B5, and the
# coordinate repair (values above 100 are divided by these factors).
UNIT_FROM, UNIT_TO = "ug/m3", "µg/m3"
LATITUDE_FACTOR = 100000.0
LONGITUDE_FACTOR = 10000000.0
COORD_LIMIT = 100.0


def repair_coordinate(text_col: str, factor: float) -> F.Column:
    v = F.col(text_col).cast("double")
    return F.when(v > COORD_LIMIT, v / F.lit(factor)).otherwise(v)


def silver_measures(bronze: DataFrame, low: float = 0.0, high: float = 1000.0) -> DataFrame:
    long = unpivot_hours(bronze, AIR_ATTRIBUTES, hour_columns(), "hora", "valor")
    long = valid_measurements(long, "valor", ["codi_eoi", "contaminant"], low, high)
    return long.select(
        "codi_eoi",
        "nom_estacio",
        F.col("data").cast("date").alias("data"),
        "magnitud",
        "contaminant",
        F.replace(F.col("unitats"), F.lit(UNIT_FROM), F.lit(UNIT_TO)).alias("unitats"),
        "tipus_estacio",
        "area_urbana",
        "municipi",
        "nom_comarca",
        text_to_int("altitud").alias("altitud"),
        repair_coordinate("latitud", LATITUDE_FACTOR).alias("latitud"),
        repair_coordinate("longitud", LONGITUDE_FACTOR).alias("longitud"),
        "hora",
        "valor",
    )


def measure_checks(silver: DataFrame) -> DataFrame:
    """D1-D4 in one pass."""
    return Q.check_report(silver, [
        ("latitud_fora_rang", Q.outside("latitud", 40, 43)),
        ("longitud_fora_rang", Q.outside("longitud", 0, 4)),
        ("hora_fora_rang", Q.outside("hora", 1, 24)),
        ("nuls_critics", Q.any_null("valor", "codi_eoi")),
    ], table="silver_mesures")


def silver_weather(bronze_rows: DataFrame) -> DataFrame:
    """``time`` is local wall-clock text: parsed to TIMESTAMP_NTZ so no zone
    shift moves the hour; hour labels become 1-24."""
    ts = F.to_timestamp_ntz(F.col("time"))
    return (bronze_rows.where(F.col("temperature_2m").isNotNull())
            .select(
                F.col("time").cast("date").alias("data"),
                (F.hour(ts) + 1).cast("long").alias("hora"),
                F.col("temperature_2m").cast("double").alias("temperatura"),
                F.col("relative_humidity_2m").cast("double").alias("humitat"),
                F.col("precipitation").cast("double").alias("precipitacio"),
                F.col("wind_speed_10m").cast("double").alias("vent_velocitat"),
                F.col("wind_direction_10m").cast("double").alias("vent_direccio"),
                F.col("surface_pressure").cast("double").alias("pressio"),
            ))


def weather_checks(silver: DataFrame) -> DataFrame:
    """D5-D7 in one pass."""
    return Q.check_report(silver, [
        ("temperatura_impossible", Q.outside("temperatura", -20, 50)),
        ("humitat_fora_rang", Q.outside("humitat", 0, 100)),
        ("hora_fora_rang", Q.outside("hora", 1, 24)),
    ], table="silver_meteo")

