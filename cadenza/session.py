"""Session construction and shared-storage helpers.

Cluster deployments pass their own settings (``spark.checkpoint.dir`` on a
shared filesystem, shuffle partitions sized to the data).  The builder here
only fills in what is unset, so tests and local runs get sane defaults while
a cluster session keeps its own.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark import SparkConf, SparkContext
from pyspark.sql import SparkSession

# Settings for a session that does not name them itself.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete reliable-checkpoint files once their DataFrame is unreferenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cadenza", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine's defaults."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    given = SparkConf()   # spark-submit's and spark-defaults.conf's settings
    running = SparkContext._active_spark_context
    for k, v in _DEFAULTS.items():
        if not given.contains(k) and not (running and running.getConf().contains(k)):
            builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    extra = dict(extra or {})
    if master and master.startswith("local") and "spark.driver.memory" not in extra:
        # local mode runs every task in the driver JVM; the JVM default (1g
        # for all cores) makes spilling aggregates thrash.  Clusters size
        # their executors themselves.
        extra["spark.driver.memory"] = "8g"
    for k, v in extra.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint directory.

    A cluster names a shared folder in ``spark.checkpoint.dir``; it is used
    as is.  Where nothing is configured, a local master (tests, local runs)
    gets a fresh local folder; on any other master that is an error, as its
    executors would not see the driver's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all "
                               f"executors share (master {sc.master})")
        conf_dir = "file://" + tempfile.mkdtemp(prefix="cadenza-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables.

    Files written by a job (intermediate tables, round-trip checks) live next
    to the checkpoints, so every executor can read them back.  The path keeps
    the folder's scheme; what was written under it is removed when the
    driver's file system is closed, at the end of the application.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return path


def free_dropped(spark: SparkSession) -> None:
    """Have Spark's cleaner delete the shuffle files, cached blocks and checkpoints
    that nothing refers to any more.  It learns of them when the driver collects
    garbage, by default every 30 minutes, while a query leaves files of many times
    its input."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def _is_local(master: str) -> bool:
    """One JVM for driver and executors (``local-cluster`` has several)."""
    return master == "local" or master.startswith("local[")


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
