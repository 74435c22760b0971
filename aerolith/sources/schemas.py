"""Explicit schemas for the landed (bronze) payloads.

Air records are read all-string, as landed: a missing ``hNN`` becomes NULL
instead of an absent column, and ``codi_eoi`` keeps its leading zero.
"""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.reshape import hour_columns

# Attribute columns of one landed air-quality record.
AIR_ATTRIBUTES = (
    "codi_eoi", "nom_estacio", "data", "magnitud", "contaminant", "unitats",
    "tipus_estacio", "area_urbana", "municipi", "nom_comarca",
    "altitud", "latitud", "longitud",
)

# Hourly weather variables in the landed payload, in order.
WEATHER_VARIABLES = (
    "temperature_2m", "relative_humidity_2m", "precipitation",
    "wind_speed_10m", "wind_direction_10m", "surface_pressure",
)

AIR_BRONZE = T.StructType(
    [T.StructField(c, T.StringType(), True) for c in AIR_ATTRIBUTES]
    + [T.StructField(h, T.StringType(), True) for h in hour_columns()]
)

WEATHER_BRONZE = T.StructType([
    T.StructField("latitude", T.DoubleType(), True),
    T.StructField("longitude", T.DoubleType(), True),
    T.StructField("timezone", T.StringType(), True),
    T.StructField("hourly", T.StructType(
        [T.StructField("time", T.ArrayType(T.StringType()), True)]
        + [T.StructField(v, T.ArrayType(T.DoubleType()), True) for v in WEATHER_VARIABLES]
    ), True),
])
