"""Session construction and cluster-safe settings."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. Catalyst/AQE decide join strategies at run
# time; skew-join splitting covers hot keys (one member or product holding a
# large share of all sales) in shuffle joins that cannot be broadcast.
JOB_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # let AQE coalesce/re-plan inside persisted plans too (dimension inputs,
    # staged and keyed sales are persisted)
    "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning": "true",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, use the session the platform gives
    and call :func:`configure` on it instead."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(JOB_CONF)
    conf.update({
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.driver.memory": os.environ.get("STARLOOM_DRIVER_MEMORY", "8g"),
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    })
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the job settings that are safe to change at run time."""
    for k, v in JOB_CONF.items():
        spark.conf.set(k, v)
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM runs everything; ``local-cluster[...]`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def checkpoint_dir(spark: SparkSession) -> str:
    """Reliable checkpoint directory for lineage cuts.

    Uses ``spark.checkpoint.dir`` as configured for the cluster (a shared
    file system). Only a local master without that setting (tests, bench)
    gets a fresh scratch directory; a cluster without it is an error, because
    a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="starloom-ckpt-"))
    return sc.getCheckpointDir()
