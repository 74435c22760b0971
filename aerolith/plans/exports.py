"""BI extracts built from the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.aggregates import grouped_stats


def daily_fact(fets: DataFrame, scale: int | None = None) -> DataFrame:
    """``fets_diari``: mean, max, min and hour count per station, pollutant
    and day."""
    return grouped_stats(fets, ["codi_eoi", "magnitud", "id_temps"], "valor",
                         stats=("mean", "max", "min", "count"), digits=2, scale=scale,
                         names={"count": "hores_amb_dada"})


def hourly_profile(fets: DataFrame, calendar: DataFrame, scale: int | None = None) -> DataFrame:
    """``perfil_horari``: mean per station, pollutant, year and hour."""
    j = fets.join(calendar.select("id_temps", "any"), "id_temps")
    return grouped_stats(j, ["codi_eoi", "magnitud", "any", "hora"], "valor",
                         stats=("mean",), digits=2, scale=scale)
