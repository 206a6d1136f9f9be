"""Session helpers: a local session for tests/bench and the shared stage folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the jobs rely on. AQE re-plans joins from runtime sizes, splits
# skewed join partitions and coalesces small shuffle partitions.
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Delete checkpointed candidates once nothing references them.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # Call-site capture for error messages costs several driver round trips
    # per column expression; a scheduled job does not need it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "gatewatch") -> SparkSession:
    """A local session for tests and the benchmark (UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
    )
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where it is unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local session without it (tests) gets a fresh temp folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gatewatch-ckpt-"))
    return sc.getCheckpointDir()


def stage_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the checkpoint dir for a written intermediate table."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "gatewatch-stage", f"{name}-{uuid.uuid4().hex}")
