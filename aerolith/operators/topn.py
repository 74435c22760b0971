"""Exact top-N by a lexicographic key without gathering rows in one task.

``orderBy(...).limit(n)`` plans as a per-task top-n and a merge in one task, which
receives ``n`` rows from every task. Here two scans do for any number of keys and any
``n``. The first counts rows per value of the first key; these counts are
range-partitioned by sampled splitters, and each range's total and bounds (``RANGES``
rows) tell in which range the quota is reached, so the cut is a plain literal that
reaches the scan as a pushed filter. The second scan takes the rows up to the far
end of that range, range-partitions them by all keys, sorts them in their partitions
and numbers them by partition sizes (``dense_ids``); the first ``n`` numbers stay.
Nothing is windowed over the data's values; a value held by a third of all rows is
counted in each task first and is parted by the other keys afterwards.

NULLs come last in either direction. All other orderable columns break ties, so the
result depends on the rows alone, and exactly ``n`` rows stay (or all, when there
are fewer), exact duplicates included.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .dense_id import dense_ids

#: Ranges of the first key whose totals are looked at.
RANGES = 64


def _ordered(col: str, descending: bool) -> Column:
    c = F.col(col)
    return c.desc_nulls_last() if descending else c.asc_nulls_last()


def cut_off(df: DataFrame, n: int, col: str, descending: bool, ranges: int = RANGES):
    """The far end of the range of ``col`` in which the first ``n`` rows end; None
    if fewer rows have a value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("_n"))
    totals = (counts.repartitionByRange(ranges, _ordered(col, descending))
              .groupBy(F.spark_partition_id().alias("_range"))
              .agg(F.sum("_n").alias("_n"), (F.min if descending else F.max)(col).alias("_end"))
              .collect())
    reached = 0
    for r in sorted(totals, key=lambda r: r["_range"]):
        reached += r["_n"]
        if reached >= n:
            return r["_end"]
    return None


def top_n(df: DataFrame, n: int, keys: Sequence[tuple[str, bool]]) -> DataFrame:
    """The first ``n`` rows of ``df`` by ``keys`` (``(column, descending)``)."""
    if not keys:
        raise ValueError("top_n needs at least one key column")
    col, descending = keys[0]
    cut = cut_off(df, n, col, descending)
    near = df
    if cut is not None:
        end = F.lit(cut).cast(df.schema[col].dataType)
        near = df.where(F.col(col) >= end if descending else F.col(col) <= end)
    named = {k for k, _ in keys}
    rest = [f.name for f in df.schema
            if f.name not in named and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    order = [_ordered(k, d) for k, d in keys] + [_ordered(k, False) for k in rest]
    numbered = dense_ids(near.repartitionByRange(*order).sortWithinPartitions(*order), "_place")
    return numbered.where(F.col("_place") <= F.lit(n)).drop("_place")
