"""Readers and writers: typed tables, tolerant JSON, file listings, partition replacement, nested exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """A Parquet table; with a schema, columns missing in old files read as NULL."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = True) -> DataFrame:
    """JSON documents against an explicit schema; a malformed one becomes a row of NULLs with its text in ``_corrupt``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    return spark.read.schema(StructType([*schema.fields]).add("_corrupt", "string")).option("multiLine", multiline).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)


def read_jsonl(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return read_json(spark, path, schema, multiline=False)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """One row per file below ``root``: path, size, time and the SHA-256 of its bytes."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"), F.sha2("content", 256).alias("sha256"))


def classify_path(path: Column) -> Column:
    """``struct<kind, page, col>`` of an archive path; a NULL kind for files of no known kind, a NULL number beyond int."""
    name = F.substring_index(path, "/", -1)
    number = lambda rx: F.nullif(F.regexp_extract(name, rx, 1), F.lit("")).try_cast("int")
    kind = F.when(name.rlike(r"_col[0-9]+\.png$"), "column").when(name.rlike(r"_ad[0-9]+\.png$"), "ad").when(name.rlike(r"\.pdf$"), "scan").when(name.rlike(r"\.json$"), "analysis")
    return F.struct(kind.alias("kind"), number(r"_p([0-9]+)").alias("page"), number(r"_col([0-9]+)").alias("col"))


def replace_partitions(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """Idempotent per-partition replace: only partitions present in ``df`` are overwritten, atomically committed."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append(df: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*by).parquet(path)


def snapshot_then_delete(table: DataFrame, doomed: Column, snapshot_path: str) -> DataFrame:
    """Save the doomed rows as JSON, check that all arrived, and return the table without them."""
    rows = table.where(doomed)
    rows.write.mode("errorifexists").json(snapshot_path)
    saved = table.sparkSession.read.schema(table.schema).json(snapshot_path).count()
    if saved != rows.count():
        raise RuntimeError("the snapshot is incomplete; nothing was deleted")
    return table.where(~doomed | doomed.isNull())


def nested_json(parent: DataFrame, child: DataFrame, key: str, order: str, name: str) -> DataFrame:
    """One JSON document per parent with its children, in order, as an array; an empty array without any."""
    fields = [c for c in child.columns if c != key]
    kids = child.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *(c for c in fields if c != order)))).alias(name))
    joined = parent.join(kids, key, "left")
    return joined.select(key, F.to_json(F.struct(*parent.columns, F.coalesce(name, F.array().cast(kids.schema[name].dataType)).alias(name))).alias("document"))


def raster_regions(df: DataFrame, box: tuple[str, str, str, str], page_width: float, page_height: float, least_width: float = 30.0, least_height: float = 30.0, most: float = 0.8) -> DataFrame:
    """Embedded images without those too small to be a picture and those that cover the page, its own scan."""
    x0, y0, x1, y1 = map(F.col, box)
    return df.where((x1 - x0 >= least_width) & (y1 - y0 >= least_height) & ((x1 - x0) * (y1 - y0) <= most * page_width * page_height))


def layout_blocks(df: DataFrame, raw: str, width: Column, height: Column) -> DataFrame:
    """Add ``pixels``, ``polygon`` (percent, two decimals) and ``n_points`` from a JSON list of points; NULL and 0 if there is none."""
    points = F.from_json(raw, "array<array<double>>")
    percent = F.transform(points, lambda p: F.array(F.round(p[0] / width * 100, 2), F.round(p[1] / height * 100, 2)))
    return df.withColumn("pixels", points).withColumn("polygon", percent).withColumn("n_points", F.coalesce(F.size(points), F.lit(0)))
