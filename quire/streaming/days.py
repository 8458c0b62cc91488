"""Incremental day-closed aggregates and related streams."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType


def read_stream(spark: SparkSession, path: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    """A Parquet folder as a stream, a bounded number of files per batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def closed_days(events: DataFrame, ts: str, value: str, late: str = "0 days") -> DataFrame:
    """Per-day count and mean; a day is emitted once, when the watermark passes its end, and late rows are ignored."""
    return (
        events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late).groupBy(F.window("_ts", "1 day").alias("w"))
        .agg(F.count("*").alias("n"), F.round(F.avg(value), 4).alias("mean"))
        .select(F.col("w.start").cast("date").alias("day"), "n", "mean")
    )


def active_runs(events: DataFrame, ts: str, key: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions of a key: activity with pauses shorter than ``gap``."""
    return (
        events.withColumn("_ts", F.col(ts).cast("timestamp")).groupBy(key, F.session_window("_ts", gap).alias("w"))
        .agg(F.count("*").alias("n")).select(key, F.unix_timestamp("w.start").alias("started"), F.unix_timestamp("w.end").alias("ended"), "n")
    )


def once_per_key(events: DataFrame, ts: str, key: str, within: str = "1 day") -> DataFrame:
    """Idempotent redelivery: the first row of a key within the watermark's reach."""
    return events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", within).dropDuplicatesWithinWatermark([key])


def failure_counter(events: DataFrame, key: str, failed: str, order: str, limit: int = 2) -> DataFrame:
    """Per key the running number of failures since the last success and the status it implies, kept as state.

    The rows of a key are ordered within a trigger, however many Arrow batches they fill; a later trigger is
    taken to hold later rows.  A NULL in ``failed`` is no failure.
    """
    def step(k: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n = state.get[0] if state.exists else 0
        rows = pd.concat(list(batches)).sort_values(order, kind="stable")
        bad = rows[failed].fillna(False).to_numpy(dtype=bool)
        good = np.flatnonzero(~bad)
        n = int(len(bad) - 1 - good[-1]) if len(good) else n + len(bad)
        state.update((n,))
        yield pd.DataFrame({key: [k[0]], "failures": [n], "status": ["done" if not n else "damaged" if n >= limit else "failed"]})

    kind = dict(events.dtypes)[key]
    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, failures bigint, status string", "n bigint", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process everything there is into a Parquet folder and stop; the checkpoint makes a rerun resume.

    Returns what was written with the number of its trigger in ``trigger``.  A trigger that runs again replaces
    its own rows, so redelivery does no harm.
    """
    spark, schema = stream.sparkSession, StructType([*stream.schema.fields]).add("trigger", "long")
    spark.createDataFrame([], stream.schema).write.mode("overwrite").parquet(f"{path}/trigger=-1")

    def write(rows: DataFrame, trigger: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/trigger={trigger}")

    query = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(path)


def latest(found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Of an update stream's output the last row of each key."""
    rest = [c for c in found.columns if c not in (*keys, "trigger")]
    return found.groupBy(*keys).agg(F.max_by(F.struct(*rest), "trigger").alias("_x")).select(*keys, *(F.col(f"_x.{c}").alias(c) for c in rest))
