"""SparkSession construction and a few session-level helpers."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: naive timestamps are read as UTC wall-clock,
# AQE re-plans shuffles at runtime (coalescing small partitions, splitting
# skewed join partitions), and no web UI is started.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app_name: str = "zonepace",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Return (or create) the session with the pipeline's base settings.

    On a cluster, ``master`` stays ``None`` so spark-submit decides; the
    shuffle partition count is then left to the cluster's configuration.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if master and master.startswith("local"):  # a cluster keeps its own addresses and names its shared folder
        builder = builder.config("spark.driver.host", "127.0.0.1")
        builder = builder.config("spark.driver.bindAddress", "127.0.0.1")
        builder = builder.config("spark.driver.memory", os.environ.get("ZONEPACE_DRIVER_MEMORY", "16g"))
        if "spark.checkpoint.dir" not in (extra or {}):
            builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="zonepace-ckpt-"))
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there; it is used as-is.  Only when
    the setting is absent (local tests) a private scratch folder is made.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a shared folder (HDFS/S3/…) on a cluster")
        # Local runs and tests only: a private scratch folder.
        configured = tempfile.mkdtemp(prefix="zonepace-ckpt-")
        try:
            spark.conf.set("spark.checkpoint.dir", configured)
        except Exception:  # core conf may be read-only at runtime
            pass
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"
