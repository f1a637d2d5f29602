"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession, what: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (else under the context's checkpoint folder).

    Only where neither is set and driver and executors are one process, a
    temporary folder is made; on a cluster that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="spanloom-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/{what}-{uuid.uuid4().hex}"


def stored(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once and read back: its plan ends there, and nothing of it is computed again."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
