"""Landed JSON -> bronze DataFrames.

The download clients of the original are out of scope: files land in a
directory (one JSON array of records per file for air quality, one object of
parallel arrays per file for weather) and are read from there in parallel,
one file per task at least.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.topn import top_n
from .schemas import AIR_BRONZE, WEATHER_BRONZE, WEATHER_VARIABLES


def read_air_json(spark: SparkSession, path: str | Sequence[str],
                  multi_line: bool = True) -> DataFrame:
    """Air-quality records, all columns as text.

    A landed pull is one JSON array (bounded by the source's row limit); a
    multi-line JSON file is read whole by one task, so parallelism comes from
    the number of files. For large landings, land JSON Lines (one record per
    line) and pass ``multi_line=False``: those files are split across tasks.
    A file that is cut or is no JSON stops the job."""
    return (spark.read.schema(AIR_BRONZE)
            .option("multiLine", multi_line)
            .option("primitivesAsString", True)
            .option("mode", "FAILFAST")
            .json(path))


def select_newest(df: DataFrame, municipi: str | None = "Barcelona", limit: int | None = 50000,
                  order_col: str = "data",
                  tie_break: Sequence[str] = ("codi_eoi", "magnitud"),
                  where_col: str = "municipi") -> DataFrame:
    """The source selection: one municipality, newest ``limit`` records
    (``data DESC``), exactly that many, ties broken by key and then by all other
    columns, NULLs last. One plan for every limit (``operators.topn``)."""
    out = df if municipi is None else df.where(F.col(where_col) == municipi)
    if limit is None:
        return out
    return top_n(out, limit, [(order_col, True)] + [(c, False) for c in tie_break])


def read_weather_json(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Hourly weather payloads -> one row per hour: ``time`` plus the six
    variables. Arrays of one payload are zipped positionally (no shuffle)."""
    raw = (spark.read.schema(WEATHER_BRONZE).option("multiLine", True)
           .option("mode", "FAILFAST").json(path))
    return weather_payload_rows(raw)


def weather_payload_rows(payloads: DataFrame) -> DataFrame:
    """A DataFrame with an ``hourly`` struct of parallel arrays -> one row
    per position (``inline(arrays_zip(...))``, a narrow generator)."""
    arrays = [F.col("hourly.time").alias("time")] + [
        F.col(f"hourly.{v}").alias(v) for v in WEATHER_VARIABLES]
    return payloads.select(F.inline(F.arrays_zip(*arrays)))


def select_weather_range(df: DataFrame, start: str = "2023-08-23", end: str | None = None,
                         lag_days: int = 6) -> DataFrame:
    """Hours between ``start`` and ``end`` (default: today minus ``lag_days``,
    the archive's publication delay)."""
    d = F.to_date(F.col("time"))
    hi = F.lit(end).cast("date") if end else F.date_sub(F.current_date(), lag_days)
    return df.where(d.between(F.lit(start).cast("date"), hi))
