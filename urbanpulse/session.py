"""Spark session settings the engine relies on.

Everything here is a plain Spark configuration.  ``configure`` only touches
runtime SQL confs, so it is safe to call on a session somebody else built
(the driver, a notebook, a cluster job).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Runtime SQL settings every operator assumes.
RUNTIME_CONF = {
    # hour(), to_date() and interval arithmetic follow the session zone.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch sort-merge joins to broadcast when a side turns
    # out small at runtime.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Rewrites of a partitioned table replace only the partitions present in
    # the new data (incremental rollups, compaction per date).
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings; leaves ANSI mode at its (on) default."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment (a shared file system).  A scratch
    folder of this machine is made only under a ``local`` master; any other master
    without the setting is an error, because executors could not read each other's files.
    """
    current = spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        try:
            current = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001  (no SparkContext, e.g. Spark Connect)
            current = None
    if current:
        return current
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    local = tempfile.mkdtemp(prefix="run-")
    spark.conf.set("spark.checkpoint.dir", local)
    try:
        spark.sparkContext.setCheckpointDir(local)
        return spark.sparkContext.getCheckpointDir() or local
    except Exception:  # noqa: BLE001
        return local


def local_session(cores: int | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "urbanpulse") -> SparkSession:
    """A local[N] session for tests and the bench (UI off, UTC, AQE on)."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    shuffle_partitions = shuffle_partitions or cores
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("URBANPULSE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.streaming.numRecentProgressUpdates", "1000")
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    checkpoint_dir(spark)
    return spark
