"""The catalogue of registered queries: each applies operators to whole tables and has an oracle where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.columns import Box  # noqa: F401  re-exported for the plan modules
from ..operators.relations import by_page


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


class Tables:
    """The tables of a scale-factor folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def boxes(self, light: bool = False) -> DataFrame:
        """Boxes dealt out by page once, in parts of a bounded size: what follows on a page needs no other exchange.

        Only plain columns of the table are dealt out, since a task that writes a shuffle of many parts sorts all its rows in memory.
        """
        rows = by_page(self.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), "l_orderkey", light)
        return rows.selectExpr("l_orderkey as page", "cast(l_linenumber as bigint) as col", "l_partkey", "l_suppkey", "l_quantity").groupBy("page", "col").agg({"l_partkey": "min", "l_suppkey": "min", "l_quantity": "min"}).selectExpr(
            "page * 10 + col as id", "page", "col", "cast(`min(l_partkey)` % 60 as double) as l", "cast((`min(l_suppkey)` * 7) % 60 as double) as t",
            "cast(`min(l_partkey)` % 60 + 8 + col * 4 as double) as r", "cast((`min(l_suppkey)` * 7) % 60 as double) + 10 + `min(l_quantity)` % 30 as b", "`min(l_quantity)` as score",
        )


#: The same boxes for the oracle.
BOXES = """boxes AS (
  SELECT id, page, col, CAST(p % 60 AS DOUBLE) AS l, CAST((s * 7) % 60 AS DOUBLE) AS t, CAST(p % 60 + 8 + col * 4 AS DOUBLE) AS r,
         CAST((s * 7) % 60 AS DOUBLE) + 10 + q % 30 AS b, q AS score
  FROM (SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey AS page, CAST(l_linenumber AS BIGINT) AS col,
               min(l_partkey) AS p, min(l_suppkey) AS s, min(l_quantity) AS q FROM lineitem GROUP BY ALL))"""
MEET = "(greatest(0, least(a.r, b.r) - greatest(a.l, b.l)) * greatest(0, least(a.b, b.b) - greatest(a.t, b.t)))"
AREA_A, AREA_B = "((a.r - a.l) * (a.b - a.t))", "((b.r - b.l) * (b.b - b.t))"


def query(covers: str, sql: str | None = None) -> Callable:
    """Register a function of :class:`Tables` under its own name."""
    def add(f: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        CATALOG[f.__name__] = Query(f.__name__, tuple(covers.split()), lambda spark, sf_dir: f(Tables(spark, sf_dir)), sql)
        return f

    return add
