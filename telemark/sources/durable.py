"""Cutting lineage through storage every executor can reach."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def _folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a session on one machine may be without one and gets its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="telemark-checkpoint-")
        spark.sparkContext.setCheckpointDir(configured)
    return configured.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in shared storage, for files a later step reads again."""
    return f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in shared storage and go on from there.

    The table outlives lost executors, and later steps read only the columns they
    need, which a checkpoint of whole rows would not allow.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
