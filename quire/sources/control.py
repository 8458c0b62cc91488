"""Small control documents in the shared folder: atomic JSON files and a checkpoint in two phases."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def write_json(spark: SparkSession, path: str, data: object) -> None:
    """Replace a JSON file as a whole: readers see the old one or the new one, never a part."""
    fs, target = _fs(spark, path)
    temporary = target.suffix(".tmp")
    out = fs.create(temporary, True)
    out.write(bytearray(json.dumps(data, ensure_ascii=False).encode()))
    out.close()
    jvm = spark._jvm
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(fs.makeQualified(temporary), fs.makeQualified(target), options)


def read_json(spark: SparkSession, path: str) -> object | None:
    """The file's content; None without a file."""
    fs, where = _fs(spark, path)
    if not fs.exists(where):
        return None
    rows = spark.read.option("wholetext", True).text(path).collect()  # one file, one row
    return json.loads(rows[0][0])


class Checkpoint:
    """A point in time up to which everything is done.

    ``begin`` notes a pending point; a run that died before ``commit`` leaves it, and the next run gets the same
    point again, so it reads exactly the same window.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path

    def _state(self) -> dict:
        return read_json(self.spark, self.path) or {"committed": None, "pending": None}

    def begin(self, as_of: str) -> tuple[str | None, str]:
        """The window (after, up to] to work on."""
        state = self._state()
        if state["pending"] is None:
            state["pending"] = as_of
            write_json(self.spark, self.path, state)
        return state["committed"], state["pending"]

    def commit(self) -> None:
        state = self._state()
        if state["pending"] is not None:
            write_json(self.spark, self.path, {"committed": state["pending"], "pending": None})
