"""Join helpers.

Strategy: dimension sides built here are aggregates whose size is bounded by
something other than the fact volume (stations, pollutants, days, hours).
They are joined without a hint: with AQE on, Spark measures the finished
dimension stage and switches the sort-merge join to a broadcast join when it
is under ``spark.sql.adaptive.autoBroadcastJoinThreshold``; above it the
shuffle join stays and the skew-join rule splits hot fact partitions.
One-row aggregates (totals, maxima) are attached as scalar subqueries, not
joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import pct


def with_scalar(df: DataFrame, scalar: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row as uncorrelated
    scalar subqueries (``DataFrame.scalar()``): Spark computes the aggregate
    once and inlines the value, so there is no join and no shuffle of
    ``df``."""
    return df.withColumns({c: scalar.select(c).scalar() for c in scalar.columns})


def with_total(df: DataFrame, name: str = "total") -> DataFrame:
    """``COUNT(*) OVER ()`` without moving every row into one partition."""
    return with_scalar(df, df.agg(F.count(F.lit(1)).alias(name)))


def last_days(df: DataFrame, date_col: str, days: int,
              by: Sequence[str] = ()) -> DataFrame:
    """Rows with ``date >= max(date) - days``. Without ``by`` the maximum is a
    scalar subquery; with ``by`` it is a window maximum per series (meant
    for daily series, whose partitions are bounded by the date span)."""
    if not by:
        mx = df.agg(F.max(date_col)).scalar()
        return df.where(F.col(date_col) >= F.date_sub(mx, days))
    mx = F.max(date_col).over(Window.partitionBy(*by))
    return (df.withColumn("_max_d", mx)
              .where(F.col(date_col) >= F.date_sub(F.col("_max_d"), days))
              .drop("_max_d"))


def coverage(fact: DataFrame, dim: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``fact ⋈ dim`` on ``keys`` against rows of ``fact``, with the
    percentage to one decimal. Duplicate dimension keys multiply matches, as
    an inner join would; both sides are first counted per key, so the fact is
    read once, not expanded, and meets the dimension as one row per key."""
    per_key = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("_m"))
    facts = fact.groupBy(*keys).agg(F.count(F.lit(1)).alias("_f"))
    joined = facts.join(per_key, list(keys), "left")
    return joined.agg(
        F.coalesce(F.sum(F.col("_m") * F.col("_f")), F.lit(0)).cast("long").alias("amb_context"),
        F.coalesce(F.sum("_f"), F.lit(0)).cast("long").alias("total_fets"),
    ).withColumn("percentatge", pct("amb_context", "total_fets", 1))


def scalars_row(*scalars: DataFrame) -> DataFrame:
    """Several one-row aggregates side by side (``SELECT (..), (..)``): the
    first supplies the row, the others are scalar subqueries."""
    out = scalars[0]
    for s in scalars[1:]:
        out = with_scalar(out, s)
    return out
