"""Spark session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "aerocast", extra: dict | None = None) -> SparkSession:
    """Session for local runs and tests. On a cluster, pass ``master=None`` and
    let the submitter's configuration decide."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
        b = b.config("spark.driver.memory", os.environ.get("AEROCAST_DRIVER_MEMORY", "8g"))
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder for checkpoints and stage tables.

    Read from ``spark.checkpoint.dir`` (or the context's checkpoint dir). Only
    when neither is set and the master is local (tests), a private folder is created
    and registered as the checkpoint dir; a cluster without the setting is refused.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="aerocast-ckpt-")
        sc.setCheckpointDir(d)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder (never reused)."""
    return f"{shared_dir(spark)}/aerocast/{name}-{uuid.uuid4().hex[:12]}"
