"""Session settings and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # small-table joins switch to broadcast below 20 MB, by measured size
    "spark.sql.autoBroadcastJoinThreshold": "20971520",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "20971520",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "67108864",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "packwatch", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below the shared checkpoint folder.

    The cluster names that folder in ``spark.checkpoint.dir``; only a local session
    without one gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="packwatch-")
    return os.path.join(base, f"{purpose}-{uuid.uuid4().hex}")


def settle(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table once and go on from its files.

    For results that are small against their input and used several times. The files
    survive lost executors, and their size tells the planner whether to broadcast.
    """
    path = work_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
