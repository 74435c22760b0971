"""Data checks as one aggregate.

Each check is a predicate that marks a violating row. All checks of one table
are counted in a single pass (``count_if`` per check) and turned into a
report with one row per check; nothing is printed and the run does not stop
unless the caller asks for it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def outside(col: str, low: float, high: float) -> Column:
    """``col < low OR col > high`` (NULL never violates)."""
    c = F.col(col)
    return (c < low) | (c > high)


def any_null(*cols: str) -> Column:
    cond = F.col(cols[0]).isNull()
    for c in cols[1:]:
        cond = cond | F.col(c).isNull()
    return cond


def check_report(df: DataFrame, checks: Sequence[tuple[str, Column]],
                 table: str | None = None) -> DataFrame:
    """``(taula?, check, violacions, ok)``, one row per check."""
    counts = df.agg(*[F.count_if(F.coalesce(cond, F.lit(False))).alias(f"_c{i}")
                      for i, (_, cond) in enumerate(checks)])
    pairs = ", ".join(f"'{name}', _c{i}" for i, (name, _) in enumerate(checks))
    rows = counts.selectExpr(f"stack({len(checks)}, {pairs}) AS (check, violacions)")
    rows = rows.withColumn("violacions", F.col("violacions").cast("long"))
    rows = rows.withColumn("ok", F.col("violacions") == 0)
    if table is not None:
        rows = rows.select(F.lit(table).alias("taula"), "*")
    return rows


def key_uniqueness(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """Rows against distinct keys; ``duplicats`` > 0 means duplicate keys
    (which would multiply rows in any join on them)."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(
        F.lit(name).alias("check"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("violacions"),
    ).withColumn("ok", F.col("violacions") == 0)


def raise_on_failure(report: DataFrame) -> None:
    """Optional hard stop: raise if any check failed (one small collect of
    the failing check names, bounded by the number of checks)."""
    bad = [r["check"] for r in report.where(~F.col("ok")).select("check").collect()]
    if bad:
        raise AssertionError(f"data checks failed: {', '.join(bad)}")
