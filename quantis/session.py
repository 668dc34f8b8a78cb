"""Session helpers for tests, the bench and local runs."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, app: str = "quantis", warehouse: str | None = None
) -> SparkSession:
    """Local session with AQE on, UI off and a UTC clock."""
    b = SparkSession.builder
    if warehouse:
        b = b.config("spark.sql.warehouse.dir", warehouse)
    spark = (
        b.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("QUANTIS_DRIVER_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint directory in use: the one already set on the context,
    else the cluster's shared ``spark.checkpoint.dir``.  Only under a local
    master (tests) a scratch directory takes their place; on a cluster its
    executors could not share one, so that raises."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = tempfile.mkdtemp(prefix="quantis-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d
