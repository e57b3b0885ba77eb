"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot never compiles a method beyond 8,000 bytes: better split code than one interpreted method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Writes that part accepted rows from rejected values keep both files open instead of sorting the rows.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(name: str = "starhouse", master: str | None = None, **settings: str) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings stay as they are."""
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in (_SETTINGS | settings).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path that all executors share: under ``spark.checkpoint.dir``, or the warehouse folder where that is unset.

    On a cluster, a warehouse folder on a machine's own disk is refused: the executors would each write to another one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.conf.get('spark.sql.warehouse.dir')}/scratch"
        if base.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
