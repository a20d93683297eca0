"""Spark session helpers.

Settings the warehouse relies on: UTC session time zone (dates are compared as
calendar days), ANSI mode on (every parse goes through ``try_cast``), adaptive
query execution on (coalescing, skew-join splitting, runtime broadcast choice).
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "tradewh", extra: dict | None = None) -> SparkSession:
    """Local/test session. On a cluster, pass the cluster's own session instead."""
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    The setting is read from the session (``spark.checkpoint.dir`` or the
    SparkContext's checkpoint dir). Only when neither is set and the master is
    local — local runs and tests — a fresh folder is created and registered.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: no SparkContext, read the setting only
        sc = None
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir()
    configured = sc.getConf().get("spark.checkpoint.dir", None) if sc is not None else None
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            configured = None
    if not configured:
        configured = local_folder(sc.master if sc is not None else "")
    if sc is None:
        return configured
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def local_folder(master: str) -> str:
    """A fresh folder of this machine, for local masters only: the executors of
    any other would each write to a disk of their own."""
    if not re.fullmatch(r"local(\[.*\])?", master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="tradewh-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
