"""Session helpers.

Library code never creates its own session: every function takes the caller's
``SparkSession``. ``local_session`` exists for tests, the bench and the driver
entry point only.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "aerolith") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark, allow_local=True)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, allow_local: bool = False) -> str:
    """Return the checkpoint directory the cluster names in
    ``spark.checkpoint.dir``.

    On a cluster that setting must point at shared storage; it is only set
    here (to a fresh local scratch folder) when it is unset and the caller
    says it runs locally, as tests and the driver entry point do.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not allow_local:
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at a shared folder "
                "(e.g. an HDFS or object-store path) before running this job")
        configured = tempfile.mkdtemp(prefix="aerolith-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the checkpoint folder, for tables that a job writes
    and reads again."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/aerolith/{name}-{uuid.uuid4().hex}"
