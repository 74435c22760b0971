"""Dense surrogate ids 1..n without a single-partition window.

``ROW_NUMBER() OVER ()`` needs every row in one task. Here each row gets its
partition number and its position inside the partition; one small aggregate
(one row per partition) turns partition sizes into offsets, which are
broadcast back. The input is checkpointed first (to the shared
``spark.checkpoint.dir``) so both passes, and any task retry after an
executor loss, see the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def dense_ids(df: DataFrame, id_col: str = "id", checkpoint: bool = True) -> DataFrame:
    spark = df.sparkSession
    tagged = (df.withColumn("_part", F.spark_partition_id())
                .withColumn("_pos", F.monotonically_increasing_id()
                            - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        tagged = tagged.checkpoint(eager=True)
    sizes = tagged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition: the running sum is bounded by the partition
    # count, so the single-partition window and the broadcast are small.
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)).alias("_offset"))
    return (tagged.join(F.broadcast(offsets), "_part")
                  .withColumn(id_col, F.col("_offset") + F.col("_pos") + F.lit(1))
                  .drop("_part", "_pos", "_offset"))
