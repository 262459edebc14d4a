"""SparkSession helpers."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Runtime bloom filters: prune whole-history scans by the window's sessions
    # from any table size on; the defaults only look at scans of 10 GB or more
    # and at filters built from 10 MB or less.
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1g",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1g",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # PySpark otherwise records the Python call site of every column function
    # (several JVM round trips each) only to enrich error messages; building an
    # analysis' plan in Python was a third of its wall time at small scale.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def get_spark(master: str | None = None, app: str = "shoplens", conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting comes from the deployment and is used as is.
    Only when it is unset (local tests) is ``fallback`` installed as the
    checkpoint directory.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    spark.sparkContext.setCheckpointDir(fallback)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A fresh, unique folder below the checkpoint directory."""
    base = checkpoint_dir(spark, fallback)
    return os.path.join(base, f"shoplens-{name}-{uuid.uuid4().hex[:12]}")
