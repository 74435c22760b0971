"""Calendar column expressions (all codegen'd built-ins, no UDF)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import ColumnOrName, _col, scaled_round

# Season names by month (Catalan labels used by the reference
# tables), wind categories and their order.
SEASON_BY_MONTHS = (
    ("Hivern", (12, 1, 2)),
    ("Primavera", (3, 4, 5)),
    ("Estiu", (6, 7, 8)),
)
SEASON_OTHERWISE = "Tardor"
WIND_CALM, WIND_MODERATE, WIND_STRONG = "Calma", "Moderat", "Fort"


def date_key(d: ColumnOrName) -> Column:
    """``yyyyMMdd`` as an int (20240107), computed arithmetically."""
    d = _col(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def weekday0(d: ColumnOrName) -> Column:
    """Day of week with Sunday = 0 ... Saturday = 6."""
    return (F.dayofweek(_col(d)) - 1).cast("int")


def is_weekend(d: ColumnOrName) -> Column:
    return weekday0(d).isin(0, 6)


def day_name(d: ColumnOrName) -> Column:
    """Full English day name ('Sunday')."""
    return F.date_format(_col(d), "EEEE")


def month_name(d: ColumnOrName) -> Column:
    """Full English month name ('January')."""
    return F.date_format(_col(d), "MMMM")


def season(month: ColumnOrName) -> Column:
    m = _col(month)
    expr = None
    for name, months in SEASON_BY_MONTHS:
        expr = (F.when(m.isin(*months), F.lit(name)) if expr is None
                else expr.when(m.isin(*months), F.lit(name)))
    return expr.otherwise(F.lit(SEASON_OTHERWISE))


def wind_category(speed: ColumnOrName, calm_below: float = 5.0,
                  moderate_below: float = 15.0) -> Column:
    """Calma / Moderat / Fort; NULL speed falls through to Fort."""
    s = _col(speed)
    return (F.when(s < calm_below, F.lit(WIND_CALM))
            .when(s < moderate_below, F.lit(WIND_MODERATE))
            .otherwise(F.lit(WIND_STRONG)))


def rain_flag(precip: ColumnOrName, threshold: float = 0.0) -> Column:
    """TRUE when precipitation exceeds the threshold; NULL counts as dry."""
    p = _col(precip)
    return F.when(p > threshold, F.lit(True)).otherwise(F.lit(False))


def day_of_year_sin(d: ColumnOrName, digits: int = 4) -> Column:
    """sin(2*pi*doy/365) rounded; divides by 365 in leap years too."""
    return scaled_round(F.sin(F.lit(2.0 * math.pi) * F.dayofyear(_col(d)) / F.lit(365.0)), digits)


def day_of_year_cos(d: ColumnOrName, digits: int = 4) -> Column:
    return scaled_round(F.cos(F.lit(2.0 * math.pi) * F.dayofyear(_col(d)) / F.lit(365.0)), digits)
