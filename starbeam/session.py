"""Spark session helpers.

The library never creates a session for a caller that already has one; these helpers
are for tests, the bench and the command-line run. Cluster settings (executor sizes,
checkpoint folder, shuffle partitions) come from the cluster's own configuration.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of this package relies on. ANSI mode stays on (Spark 4
# default): cleaning uses try_* functions wherever bad input is expected.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A task that joins and groups needs 20 to 50 times its shuffled bytes as sort and hash pages.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
}

#: Partitions that a shuffle starts with at least; adaptive execution merges them up to the advisory size. With the
#: cluster's own, possibly small, number the rows of one task would grow with the input.
INITIAL_PARTITIONS = 200


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "starbeam") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("STARBEAM_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def apply_required_conf(spark: SparkSession) -> None:
    """Set the runtime SQL settings the queries assume on an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    initial = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    own = [int(spark.conf.get("spark.sql.shuffle.partitions")), int(spark.conf.get(initial, None) or 0)]
    spark.conf.set(initial, str(max(INITIAL_PARTITIONS, *own)))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, creating a scratch one only when unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as is;
    a cluster without one is an error (a machine-local folder would not be seen by
    the executors). Only a local master with nothing configured (tests) gets a fresh
    scratch folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: the server's spark.checkpoint.dir applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (surrogate keys checkpoint there)")
        configured = tempfile.mkdtemp(prefix="starbeam-ckpt-", dir="/tmp")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured
