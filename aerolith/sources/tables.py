"""Parquet table readers. Column lists are passed down so the scan's
``ReadSchema`` holds only what a query uses; filters written after the read
reach the scan as ``PushedFilters``."""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def table_path(base: str, name: str) -> str:
    single = os.path.join(base, f"{name}.parquet")
    return single if os.path.exists(single) or "://" in base else os.path.join(base, name)


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """A table as its files are now."""
    df = spark.read.parquet(table_path(base, name))
    return df.select(*columns) if columns else df
