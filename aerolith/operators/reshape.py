"""Wide-to-long reshaping and the valid-measurement filter."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import clean_double


def hour_columns(prefix: str = "h", hours: int = 24) -> list[str]:
    """``h01 ... h24``."""
    return [f"{prefix}{h:02d}" for h in range(1, hours + 1)]


def unpivot(df: DataFrame, ids: Sequence[str], value_cols: Sequence[str],
            name_col: str, value_col: str, drop_nulls: bool = True) -> DataFrame:
    """Columns to rows (one ``Expand``, no shuffle). Unlike SQL ``UNPIVOT``,
    ``DataFrame.unpivot`` keeps NULL cells, so they are dropped here."""
    out = df.unpivot(list(ids), list(value_cols), name_col, value_col)
    return out.where(F.col(value_col).isNotNull()) if drop_nulls else out


def unpivot_hours(df: DataFrame, ids: Sequence[str], hour_cols: Sequence[str] | None = None,
                  hour_name: str = "hora", value_name: str = "valor") -> DataFrame:
    """Wide ``hNN`` columns to ``(ids..., hora int, valor)``; the hour number
    is characters 2-3 of the column name, NULL cells dropped."""
    cols = list(hour_cols or hour_columns())
    long = unpivot(df, ids, cols, "_hour_col", value_name)
    return (long.withColumn(hour_name, F.substring("_hour_col", 2, 2).cast("int"))
                .drop("_hour_col"))


def in_range(value: Column | str, low: float = 0.0, high: float = 1000.0) -> Column:
    """``low <= v < high`` as a plain predicate, so it reaches the Parquet
    scan as pushed filters. False for NULL, NaN and infinities."""
    v = F.col(value) if isinstance(value, str) else value
    return (v >= low) & (v < high)


def valid_measurements(df: DataFrame, value_col: str, required: Sequence[str],
                       low: float = 0.0, high: float = 1000.0,
                       out_col: str | None = None) -> DataFrame:
    """Keep rows whose value parses as a number in ``[low, high)`` and whose
    ``required`` columns are not NULL. The parsed double replaces the text
    (or lands in ``out_col``).

    The text is parsed in a projection and the filter is a plain range test
    on the parsed column, which keeps the stage in whole-stage codegen (a
    range wrapped in a CASE around the parse would be inlined into the
    filter several times and fall out of codegen)."""
    out_col = out_col or value_col
    parsed = df.withColumn(out_col, clean_double(F.col(value_col)))
    cond = in_range(out_col, low, high)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return parsed.where(cond)


def pivot_hours(df: DataFrame, ids: Sequence[str], hour_col: str, value: Column,
                prefix: str = "h", hours: int = 24) -> DataFrame:
    """Long to wide ``hNN`` columns (the landed-record layout). The hour list
    is given, so Spark does not run a job to discover pivot values; the
    pivot is a single hash aggregate with map-side combine."""
    labels = [f"{prefix}{h:02d}" for h in range(1, hours + 1)]
    return (df.withColumn("_hcol", F.concat(F.lit(prefix), F.lpad(F.col(hour_col).cast("string"), 2, "0")))
              .groupBy(*ids).pivot("_hcol", labels).agg(value))
