"""Streaming plans run over the events table as a bounded stream."""

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import scratch
from ..streaming import days
from .catalog import Tables, query

_EVENTS = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def _stream(t: Tables) -> DataFrame:
    return t.spark.readStream.schema(_EVENTS).option("pathGlobFilter", "events.parquet").parquet(t.sf_dir)


def _all(t: Tables, stream: DataFrame, mode: str = "append") -> DataFrame:
    place = f"{scratch.root(t.spark)}/quire-stream-{uuid.uuid4().hex[:12]}"
    return days.run_once(stream, f"{place}/out", f"{place}/state", mode)


@query("STREAM A20", """
SELECT CAST(ts AS DATE) AS day, count(*) AS n, round(avg(value), 4) AS mean FROM events WHERE CAST(ts AS DATE) < (SELECT CAST(max(ts) AS DATE) FROM events) GROUP BY 1""")
def closed_days(t: Tables) -> DataFrame:
    return _all(t, days.closed_days(_stream(t), "ts", "value")).drop("trigger")


@query("STREAM S15", """
WITH g AS (SELECT user_id, epoch(ts) AS s, CASE WHEN epoch(ts) - lag(epoch(ts)) OVER w >= 1800 THEN 1 ELSE 0 END AS j FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), i AS (SELECT *, sum(j) OVER (PARTITION BY user_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM g)
SELECT user_id, CAST(floor(min(s)) AS BIGINT) AS started, CAST(floor(max(s) + 1800) AS BIGINT) AS ended, count(*) AS n FROM i GROUP BY user_id, k""")
def active_runs(t: Tables) -> DataFrame:
    found = _all(t, days.active_runs(_stream(t), "ts", "user_id"), "complete")
    return days.latest(found, ["user_id", "started", "ended"])


@query("STREAM P50", """
WITH m AS (SELECT user_id, max(event_id) FILTER (event_type IS DISTINCT FROM 'error') AS fine FROM events GROUP BY 1),
n AS (SELECT user_id, count(*) FILTER (event_type = 'error' AND (fine IS NULL OR event_id > fine)) AS failures FROM events JOIN m USING (user_id) GROUP BY 1)
SELECT user_id, failures, CASE WHEN failures = 0 THEN 'done' WHEN failures >= 2 THEN 'damaged' ELSE 'failed' END AS status FROM n""")
def failure_states(t: Tables) -> DataFrame:
    marked = _stream(t).withColumn("bad", F.col("event_type") == "error").select("user_id", "event_id", "bad")
    return days.latest(_all(t, days.failure_counter(marked, "user_id", "bad", "event_id"), "update"), ["user_id"])


@query("STREAM", "SELECT count(DISTINCT user_id) AS n FROM events")
def delivered_once(t: Tables) -> DataFrame:
    return _all(t, days.once_per_key(_stream(t), "ts", "user_id", "40 days").select("user_id")).agg(F.count("*").alias("n"))
