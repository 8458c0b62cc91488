"""Connected components over an edge table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


HUBS = 1000


def _least(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))


def _with_least(edges: DataFrame, least: DataFrame, n_edges: int) -> DataFrame:
    """Each edge with the least neighbour of its ``u``.

    A vertex with more than a thousandth of the edges is a hub; there are fewer than ``HUBS`` of them, so they
    are broadcast, and their edges spread over all tasks instead of meeting in one.
    """
    hubs = least.where(F.col("n") > n_edges / HUBS).select(F.col("u").alias("h"), F.col("m").alias("hub_m"))
    spread = F.when(F.col("hub_m").isNull(), F.col("u")).otherwise(F.xxhash64("v"))
    marked = edges.join(F.broadcast(hubs), F.col("u") == F.col("h"), "left").select("u", "v", "hub_m", spread.alias("k"))
    least = least.select(F.col("u").alias("h"), "m")
    return marked.join(least, F.col("k") == F.col("h"), "left").select("u", "v", F.coalesce("hub_m", "m").alias("m"))


def _large_star(edges: DataFrame, n: int) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _least(both).withColumn("m", F.least("u", "m"))
    return (
        _with_least(both, least, 2 * n).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        .where("u <> v").distinct()
    )


def _small_star(edges: DataFrame, n: int) -> DataFrame:
    least = _least(edges)
    return (
        _with_least(edges, least, n).select(F.col("v").alias("a"), F.col("m").alias("b"))
        .union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        .where("a <> b").distinct().select(F.col("a").alias("u"), F.col("b").alias("v"))
    )


def connected_components(edges: DataFrame, keep: Callable[[DataFrame, str], DataFrame], limit: int = 64) -> DataFrame:
    """Rows ``(id, component)`` for every vertex that has an edge; the component is its smallest vertex.

    ``edges`` has two bigint columns ``u`` and ``v``; direction, repeats, loops and rows with a NULL end
    do not matter.  Alternating large-star and small-star passes shrink every component to a star around
    its smallest member in O(log^2 n) rounds; ``keep`` stores each round as a table, so lineage stays short.
    An empty edge table gives an empty result.  A vertex met only in a loop is its own component.
    """
    named = edges.select(F.col(edges.columns[0]).cast("bigint").alias("a"), F.col(edges.columns[1]).cast("bigint").alias("b")).dropna()
    loops = named.where("a = b").select(F.col("a").alias("id"), F.col("a").alias("component"))
    state = keep(named.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    mark = _fingerprint(state)
    for _ in range(limit):
        if mark[0] == 0:
            break
        few = 1 + mark[0] // 100_000 if mark[0] < 2_000_000 else None  # a small graph in few files
        for name, star in (("large-stars", _large_star), ("stars", _small_star)):
            new = star(state, mark[0])
            state = keep(new.coalesce(few) if few else new, name)
        now = _fingerprint(state)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {limit} rounds")
    members = state.select(F.col("u").alias("id"), F.col("v").alias("component"))
    roots = state.select(F.col("v").alias("id"), F.col("v").alias("component"))
    return members.union(roots).union(loops).groupBy("id").agg(F.min("component").alias("component"))


def _fingerprint(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
