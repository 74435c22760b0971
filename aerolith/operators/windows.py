"""Series windows: lags, trailing means, hold-out split.

Windows are partitioned by the series key. They run on daily aggregates, so
one partition holds at most one row per day of one series, however many raw
rows that series had; all windows share one spec, hence one sort.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed_point, scaled_round


def series_window(series: Sequence[str], order: str):
    w = Window.orderBy(order) if not series else Window.partitionBy(*series).orderBy(order)
    return w


def add_lags(df: DataFrame, series: Sequence[str], order: str,
             lags: Mapping[str, tuple[str, int]]) -> DataFrame:
    """``{out: (col, n)}`` -> ``LAG(col, n)`` by row within the series."""
    w = series_window(series, order)
    return df.withColumns({out: F.lag(c, n).over(w) for out, (c, n) in lags.items()})


def frame_mean(c: str, frame, scale: int | None = 2) -> Column:
    """The mean of a column over a window frame of a few rows; with ``scale`` its
    sum is fixed-point, so exact."""
    if scale is None:
        return F.avg(c).over(frame)
    return F.try_divide(F.sum(fixed_point(c, scale)).over(frame).cast("double")
                        / F.lit(float(10 ** scale)), F.count(c).over(frame).cast("double"))


def add_trailing_means(df: DataFrame, series: Sequence[str], order: str,
                       means: Mapping[str, tuple[str, int]], digits: int = 2,
                       scale: int | None = 2) -> DataFrame:
    """``{out: (col, k)}`` -> mean of the ``k`` previous rows (frame
    ``k PRECEDING .. 1 PRECEDING``, shorter at the series start, NULL on the
    first row). With ``scale`` the sum is fixed-point, so exact."""
    base = series_window(series, order)
    cols = {}
    for out, (c, k) in means.items():
        cols[out] = scaled_round(frame_mean(c, base.rowsBetween(-k, -1), scale), digits)
    return df.withColumns(cols)


def holdout(df: DataFrame, series: Sequence[str], order: str, n_test: int,
            flag: str = "es_test") -> DataFrame:
    """Mark the last ``n_test`` rows of each series as the test side."""
    desc = F.col(order).desc()
    w = Window.partitionBy(*series).orderBy(desc) if series else Window.orderBy(desc)
    return df.withColumn(flag, F.row_number().over(w) <= n_test)
