"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def root(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a folder of our own only where that is unset, as in tests."""
    return (spark.conf.get("spark.checkpoint.dir", None) or f"{tempfile.gettempdir()}/checkpoints").rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` into that folder and read it back, which ends its lineage there."""
    path = f"{root(df.sparkSession)}/quire-{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
