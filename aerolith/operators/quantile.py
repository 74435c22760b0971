"""Exact quantiles without buffering a group.

``median`` and ``percentile`` hold all values of a group in one task. Here the
values are first counted (per group and value, combined in each task), and the wanted
rank is then found by refining histograms: the range that holds it is cut into
``BUCKETS`` ranges, one grouped aggregate counts them and gives their smallest and
largest value, and the search goes on inside the range that holds the rank until that
has one value. Every round parts the smallest value from the largest, so it ends;
about ``log(values) / log(BUCKETS)`` rounds do for values spread evenly. What a task
holds per group is a histogram of ``BUCKETS`` rows, whatever the group's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

BUCKETS = 1024


def _ranks(p: float):
    """The two ranks (from 0) between which the quantile lies, and the weight of
    the upper one."""
    at = F.lit(p) * (F.col("_n") - 1)
    low = F.floor(at).cast("long")
    return low, F.ceil(at).cast("long"), at - low


def exact_quantile(df: DataFrame, value: str, by: Sequence[str] = (), p: float = 0.5,
                   out: str = "mediana", buckets: int = BUCKETS) -> DataFrame:
    """One row per group with the linearly interpolated quantile ``p`` of the
    non-null, non-NaN values (the median for 0.5), as a double; NULL for a group
    without any. Groups are those of ``by``; NULL keys are a group."""
    ensure_checkpoint_dir(df.sparkSession)
    keys = list(by) or ["_tot"]
    rows = df if by else df.withColumn("_tot", F.lit(1))
    v = F.col(value).cast("double")
    v = F.when(~F.isnan(v), v + F.lit(0.0))     # NaN out, one zero
    counts = (rows.select(*keys, v.alias("_v")).groupBy(*keys, "_v")
              .agg(F.count(F.lit(1)).alias("_c")).checkpoint(eager=True))
    groups = counts.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("_v").isNotNull(), F.col("_c"))), F.lit(0)).alias("_n"),
        F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    low, high, weight = _ranks(p)
    state = (groups.where(F.col("_n") > 0)
             .withColumn("_w", weight)
             .withColumn("_rank", F.explode(F.array_distinct(F.array(low, high))))
             .withColumn("_upper", F.col("_rank") == high).drop("_n")
             .checkpoint(eager=True))
    searched = ["_upper", "_rank", "_w"]
    found = state.where("_lo = _hi")
    state = state.where("_lo < _hi")
    while not state.isEmpty():
        v, lo, hi = F.col("_v"), F.col("_lo"), F.col("_hi")
        # Halves where the span of the largest doubles is not finite.
        share = F.when(hi - lo < F.lit(float("inf")), F.try_divide(v - lo, hi - lo)).otherwise(
            F.try_divide(v / 2 - lo / 2, hi / 2 - lo / 2))
        bucket = F.least(F.floor(share * buckets), F.lit(buckets - 1))
        same = None
        for k in keys:
            c = F.col(f"c.{k}").eqNullSafe(F.col(f"s.{k}"))
            same = c if same is None else same & c
        joined = counts.alias("c").join(state.alias("s"), same).where("_v BETWEEN _lo AND _hi")
        table = joined.groupBy(*(F.col(f"s.{k}").alias(k) for k in keys), *searched,
                               bucket.alias("_b")).agg(
            F.sum("_c").alias("_c"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        upto = Window.partitionBy(*keys, *searched).orderBy("_b").rowsBetween(
            Window.unboundedPreceding, 0)
        inside = table.withColumn("_cum", F.sum("_c").over(upto)).where(
            (F.col("_cum") > F.col("_rank")) & (F.col("_cum") - F.col("_c") <= F.col("_rank")))
        state = inside.select(
            *keys, "_lo", "_hi", "_w",
            (F.col("_rank") - F.col("_cum") + F.col("_c")).alias("_rank"), "_upper",
        ).checkpoint(eager=True)
        found = found.unionByName(state.where("_lo = _hi"))
        state = state.where("_lo < _hi")
    # One rank is both, or the lower and the upper one are mixed by their weight.
    low_v, high_v = (F.max(F.when(F.col("_upper") == u, F.col("_lo"))) for u in (False, True))
    mixed = found.groupBy(*keys).agg(low_v.alias("_a"), high_v.alias("_b"), F.max("_w").alias("_w"))
    values = mixed.select(*keys, F.coalesce(
        F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_w"), "_b", "_a").alias(out))
    same = None
    for k in keys:
        c = F.col(f"g.{k}").eqNullSafe(F.col(f"q.{k}"))
        same = c if same is None else same & c
    return groups.alias("g").join(values.alias("q"), same, "left").select(
        *(F.col(f"g.{k}").alias(k) for k in by), out)
