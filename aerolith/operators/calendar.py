"""Gap-free calendar dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dates as D


def date_range(df: DataFrame, date_col: str) -> DataFrame:
    """One row: ``ini``, ``fi`` (min and max date)."""
    return df.agg(F.min(date_col).alias("ini"), F.max(date_col).alias("fi"))


def calendar_days(df: DataFrame, date_col: str, out_col: str = "data") -> DataFrame:
    """Every day from the first to the last date of ``df``, gaps included.
    The work is one global min/max (partial aggregates per task) and an
    explode of a sequence bounded by the date span, not by the row count."""
    rng = date_range(df, date_col)
    return rng.select(F.explode(F.sequence(F.col("ini"), F.col("fi"),
                                           F.expr("INTERVAL 1 DAY"))).alias(out_col))


def calendar_parts(days: DataFrame, d: str = "data") -> DataFrame:
    """The calendar contract: id_temps, data, any, mes, trimestre,
    dia_setmana_num (Sunday 0), dia_setmana, nom_mes, es_cap_setmana,
    estacio_any."""
    c = F.col(d)
    return days.select(
        D.date_key(c).alias("id_temps"),
        c.alias("data"),
        F.year(c).alias("any"),
        F.month(c).alias("mes"),
        F.quarter(c).alias("trimestre"),
        D.weekday0(c).alias("dia_setmana_num"),
        D.day_name(c).alias("dia_setmana"),
        D.month_name(c).alias("nom_mes"),
        D.is_weekend(c).alias("es_cap_setmana"),
        D.season(F.month(c)).alias("estacio_any"),
    )


def calendar_dim(df: DataFrame, date_col: str) -> DataFrame:
    return calendar_parts(calendar_days(df, date_col))
