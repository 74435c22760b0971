"""Grouped statistics (A2-A4, A7-A13). Every function here is one hash
aggregate with map-side partial aggregation, so a hot key is combined inside
each task before the shuffle and never lands whole in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import exact_mean, exact_sum, scaled_round


def _r(c: Column, digits: int | None) -> Column:
    return c if digits is None else scaled_round(c, digits)


# Output-name suffixes of the original tables (valor_mitja, valor_max, ...).
DEFAULT_SUFFIX = {"mean": "mitja", "median": "mediana", "stddev": "desviacio", "count": "n"}


def value_stats(value: str, stats: Sequence[str] = ("mean", "max", "min", "count"),
                digits: int | None = 2, scale: int | None = None,
                prefix: str = "valor_", names: dict[str, str] | None = None) -> list[Column]:
    """Aggregate expressions over one value column.

    ``stats`` may hold mean, max, min, sum, count, median, stddev; ``names``
    overrides the default ``prefix + stat`` output names."""
    names = names or {}
    out = []
    for s in stats:
        if s == "mean":
            e = _r(exact_mean(value, scale), digits)
        elif s == "sum":
            e = _r(exact_sum(value, scale), digits)
        elif s == "max":
            e = _r(F.max(value), digits)
        elif s == "min":
            e = _r(F.min(value), digits)
        elif s == "median":
            e = _r(F.median(value), digits)
        elif s == "stddev":
            e = _r(F.stddev_samp(value), digits)
        elif s == "count":
            e = F.count(F.lit(1))
        else:
            raise ValueError(f"unknown statistic {s!r}")
        out.append(e.alias(names.get(s, prefix + DEFAULT_SUFFIX.get(s, s))))
    return out


def grouped_stats(df: DataFrame, keys: Sequence[str], value: str, **kw) -> DataFrame:
    return df.groupBy(*keys).agg(*value_stats(value, **kw))


def dim_by_key(df: DataFrame, key: str | Sequence[str], any_cols: Sequence[str] = (),
               mean_cols: Sequence[str] = (), digits: int = 6,
               scale: int | None = None) -> DataFrame:
    """One row per key: an arbitrary non-null value of each attribute and the
    mean of each coordinate-like column rounded to ``digits``."""
    keys = [key] if isinstance(key, str) else list(key)
    aggs = [F.any_value(c, True).alias(c) for c in any_cols]
    aggs += [scaled_round(exact_mean(c, scale), digits).alias(c) for c in mean_cols]
    return df.groupBy(*keys).agg(*aggs)


def range_stats(df: DataFrame, col: str, lo: str = "des_de", hi: str = "fins_a",
                n: str = "dies") -> DataFrame:
    """MIN, MAX and COUNT(*) of a column, one row."""
    return df.agg(F.min(col).alias(lo), F.max(col).alias(hi), F.count(F.lit(1)).alias(n))


def distribution(df: DataFrame, value: str, by: Sequence[str] = (), digits: int = 1,
                 zero_below: float = 5.0, scale: int | None = None) -> DataFrame:
    """min, mean, median, max, sample stddev, count of zeros, count below a
    level. Meant for the daily series, where a group holds at most one row per
    calendar day, so the exact median's per-group buffer is bounded by the
    date span."""
    v = F.col(value)
    return df.groupBy(*by).agg(
        scaled_round(F.min(v), digits).alias("minim"),
        scaled_round(exact_mean(value, scale), digits).alias("mitjana"),
        scaled_round(F.median(v), digits).alias("mediana"),
        scaled_round(F.max(v), digits).alias("maxim"),
        scaled_round(F.stddev_samp(v), digits).alias("desviacio"),
        F.count_if(v == 0).alias("num_zeros"),
        F.count_if(v < zero_below).alias("num_sota_5"),
    )


def gap_audit(df: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Days expected (last - first + 1) against days with data. The distinct
    (series, day) pairs are formed first (partial aggregation per task), so a
    series with many rows per day shuffles one row per day."""
    days = df.select(*by, F.col(date_col).alias("_d")).distinct()
    return days.groupBy(*by).agg(
        (F.datediff(F.max("_d"), F.min("_d")) + 1).cast("long").alias("dies_esperats"),
        F.count(F.lit(1)).alias("dies_amb_dades"))
