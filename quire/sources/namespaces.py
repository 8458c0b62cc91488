"""Several catalogues side by side, as prefixed read-only views."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def attach(spark: SparkSession, prefix: str, tables: Mapping[str, DataFrame]) -> list[str]:
    """Register tables as temporary views ``<prefix>_<name>``; plain SQL joins views of any prefixes.

    A view can be read and not written; attaching a prefix again replaces its views.
    """
    names = [f"{prefix}_{name}" for name in tables]
    for name, df in zip(names, tables.values(), strict=True):
        df.createOrReplaceTempView(name)
    return names


def detach(spark: SparkSession, names: list[str]) -> None:
    for name in names:
        spark.catalog.dropTempView(name)
