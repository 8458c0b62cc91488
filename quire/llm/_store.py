"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; a folder of our own only where that is unset (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = f"{tempfile.gettempdir()}/checkpoints"
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/quire-{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back: lineage ends here,
    so a lost executor costs no recomputation of what came before.  ``files`` gathers a table that is
    small by its nature."""
    path = fresh_path(df.sparkSession, name)
    (df.repartition(files) if files else df).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, path: str) -> None:
    """Remove a superseded table."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
