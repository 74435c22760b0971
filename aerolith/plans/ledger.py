"""The run ledger (S12, A15): one row per run, series and attempt.

A row holds the run's name, the series' keys, the attempt, the logged values of the
original (``algoritme``, ``num_features``, ``features``) and maps of parameters and
metrics. Appending is idempotent: rows whose (run, series, attempt) are in the
ledger already are left out, so a repeated or retried write changes nothing.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import scaled_round
from ..sources.versions import exists

KEYS = ["run_name", "serie", "attempt"]
METRICS = ("mae", "rmse", "mape", "r2")


def serie(series: Sequence[str]) -> F.Column:
    """The series' keys as one JSON text; ``{}`` where there is one series only."""
    if not series:
        return F.lit("{}")
    return F.to_json(F.struct(*(F.col(c).cast("string").alias(c) for c in series)))


def record(metrics: DataFrame, run_name: str, params: Mapping, series: Sequence[str] = (),
           attempt: str | None = None, algoritme: str | None = None,
           features: Sequence[str] = ()) -> DataFrame:
    """Ledger rows of a run, from its metrics (a row per series): nothing is
    collected. ``attempt`` names this execution; it defaults to the time."""
    now = dt.datetime.now().replace(microsecond=0)
    kv = [x for c in METRICS if c in metrics.columns for x in (F.lit(c), F.col(c).cast("double"))]
    pairs = [x for k, v in params.items() for x in (F.lit(str(k)), F.lit(str(v)))]
    shown = ", ".join(features[:5]) + ("..." if len(features) > 5 else "")
    return metrics.select(
        F.lit(run_name).alias("run_name"), serie(series).alias("serie"),
        F.lit(attempt or now.isoformat()).alias("attempt"),
        F.lit(now).cast("timestamp_ntz").alias("run_ts"),
        F.lit(algoritme).cast("string").alias("algoritme"),
        F.lit(len(features)).alias("num_features"), F.lit(shown).alias("features"),
        (F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")).alias("params"),
        F.create_map(*kv).alias("metrics"))


def path(out: str) -> str:
    return os.path.join(out, "runs")


def read(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(path(out))


def append(rows: DataFrame, out: str) -> None:
    """Add the rows that the ledger does not hold yet."""
    spark = rows.sparkSession
    if exists(spark, path(out)):
        rows = rows.join(read(spark, out).select(*KEYS).distinct(), KEYS, "left_anti")
    rows.write.mode("append").parquet(path(out))


def latest(runs: DataFrame) -> DataFrame:
    """Each run's last attempt per series."""
    newest = F.max_by(F.struct(*(c for c in runs.columns if c not in ("run_name", "serie"))),
                      F.struct("run_ts", "attempt")).alias("r")
    return runs.groupBy("run_name", "serie").agg(newest).select("run_name", "serie", "r.*")


def gains(runs: DataFrame, base: str, new: str, metric: str = "mae", digits: int = 1) -> DataFrame:
    """Percent drop of ``metric`` from run ``base`` to run ``new`` per series, of
    the series that both runs have."""
    last = latest(runs)
    of = lambda run, name: last.where(F.col("run_name") == run).select(
        "serie", F.col("metrics")[metric].alias(name))
    drop = F.try_divide((F.col("base") - F.col("new")) * 100.0, F.col("base"))
    return of(base, "base").join(of(new, "new"), "serie").select(
        "serie", F.lit(metric).alias("metrica"), "base", "new",
        scaled_round(drop, digits).alias("millora_pct"))
