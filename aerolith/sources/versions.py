"""Versions of a lake: a refresh that fails leaves the tables that readers see whole.

A refresh writes all its tables into a folder of its own, ``<lake>/versions/<name>``.
Only when the last one is written does one row, appended to the pointer table
``<lake>/_current``, make that folder the current one. A reader resolves the pointer
once and takes all its tables from that folder, so it sees the tables of one refresh,
also while another runs, or after one was killed half-way.
"""

from __future__ import annotations

import datetime as dt
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER, FOLDER = "_current", "versions"
_SCHEMA = "seq long, version string, published timestamp_ntz"


def _path(spark: SparkSession, at: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(at)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, at: str) -> bool:
    store, path = _path(spark, at)
    return store.exists(path)


def begin(lake: str) -> str:
    """The folder of a new version; nothing is visible in it before ``publish``."""
    name = dt.datetime.now().strftime("%Y%m%dT%H%M%S-") + uuid.uuid4().hex[:8]
    return os.path.join(lake, FOLDER, name)


def _published(spark: SparkSession, lake: str) -> DataFrame | None:
    at = os.path.join(lake, POINTER)
    return spark.read.schema(_SCHEMA).parquet(at) if exists(spark, at) else None


def publish(spark: SparkSession, lake: str, folder: str) -> None:
    """Make a version's folder the current one: the last write of a refresh, one
    file that is there or not."""
    seen = _published(spark, lake)
    seq = 0 if seen is None else (seen.agg(F.max("seq")).first()[0] or 0)
    row = [(seq + 1, os.path.basename(folder), dt.datetime.now())]
    spark.createDataFrame(row, _SCHEMA).coalesce(1).write.mode("append").parquet(
        os.path.join(lake, POINTER))


def current(spark: SparkSession, lake: str) -> str:
    """The folder of the last published version."""
    seen = _published(spark, lake)
    last = seen.orderBy(F.desc("seq"), F.desc("published")).first() if seen is not None else None
    if last is None:
        raise FileNotFoundError(f"{lake} has no published version")
    return os.path.join(lake, FOLDER, last["version"])


def expire(spark: SparkSession, lake: str, keep: int = 2) -> list[str]:
    """Delete the folders of all published versions but the last ``keep`` ones, once
    no reader uses them. Folders that were never published are left alone: they may
    belong to a refresh that still runs."""
    seen = _published(spark, lake)
    old = [] if seen is None else [
        r["version"] for r in seen.orderBy(F.desc("seq")).collect()[max(keep, 1):]]
    gone = []
    for name in old:
        store, path = _path(spark, os.path.join(lake, FOLDER, name))
        if store.exists(path) and store.delete(path, True):
            gone.append(name)
    return gone
