"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Session defaults that matter for correctness or plan shape, not tuning:
# ANSI stays on (Spark 4 default), AQE re-plans joins and coalesces shuffle
# partitions at run time, and the UI server stays off.
BASE_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.inferTimestampNTZ.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "flowatlas", extra: dict | None = None) -> SparkSession:
    """Build (or return) the session. ``master`` and the shuffle width only
    apply when no session is running yet (local tests, bench)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if master and master.startswith("local"):
        # local mode: the driver JVM is the only executor
        conf["spark.driver.memory"] = os.environ.get("FLOWATLAS_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``
    (the per-application subfolder Spark created there), or ``None``."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if conf:
        spark.sparkContext.setCheckpointDir(conf)
        return spark.sparkContext.getCheckpointDir()
    return None


def shared_dir(spark: SparkSession) -> str:
    """Where tables are written between jobs: ``spark.checkpoint.dir``. A
    local-mode session that names none (a test, a laptop) gets a fresh
    temporary one; a cluster session must name a folder all nodes share."""
    d = checkpoint_dir(spark)
    if d:
        return d
    if not (spark.sparkContext.master == "local" or spark.sparkContext.master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return ensure_checkpoint_dir(spark, tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def stable_dir(spark: SparkSession) -> str | None:
    """The folder that ``spark.checkpoint.dir`` names itself, which outlives
    the application; a folder set on the context only is per application."""
    return spark.conf.get("spark.checkpoint.dir", None) or checkpoint_dir(spark)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> str:
    """Tests and the local bench only: use ``fallback`` when the session
    names no checkpoint folder. A cluster always names one."""
    d = checkpoint_dir(spark)
    if d:
        return d
    os.makedirs(fallback, exist_ok=True)
    spark.sparkContext.setCheckpointDir(fallback)
    return spark.sparkContext.getCheckpointDir()
