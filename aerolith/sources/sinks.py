"""Table writes and exports.

A layer is written with ``mode("overwrite")`` (full refresh, into the folder of a new
version, see ``sources.versions``). Row counts are taken with ``DataFrame.observe``
during the write, so a table is not scanned a second time just to be counted.
"""

from __future__ import annotations

import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType


def write_table(df: DataFrame, base: str, name: str,
                partition_by: Sequence[str] = (), fmt: str = "parquet",
                sort_by: Sequence[str] = ()) -> int:
    """Overwrite ``base/name`` and return the number of rows written.

    With ``partition_by`` the rows are rebalanced by these columns first: files
    follow the bytes of a partition (the advisory partition size; a hot value is
    split, small ones are put together), not the number of tasks times values. With
    ``sort_by`` rows are in order inside each file, so a range filter on these
    columns skips row groups by their statistics."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    obs = Observation(f"rows_{name}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(os.path.join(base, name))
    return int(obs.get["rows"])


def export_csv(df: DataFrame, base: str, name: str, single_file: bool = False) -> int:
    """CSV with a header, UTF-8; booleans as ``True`` and ``False``, as the
    original's exports have them. ``single_file`` coalesces to one task: only
    for dimensions, whose size does not grow with the facts."""
    flags = {f.name: F.initcap(F.col(f.name).cast("string")) for f in df.schema
             if isinstance(f.dataType, BooleanType)}
    df = df.withColumns(flags) if flags else df
    out = df.coalesce(1) if single_file else df
    obs = Observation(f"csv_{name}")
    observed = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    (observed.write.mode("overwrite").option("header", True).option("encoding", "UTF-8")
     .csv(os.path.join(base, name)))
    return int(obs.get["rows"])
