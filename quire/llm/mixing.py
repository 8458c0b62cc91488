"""Mixing sources to target weights by Sainte-Lague apportionment.  JVM expressions only.

Targets are a water level: a source gets ``weight * level`` words but at most ``cap`` times its size, and
the level is the one at which all targets add up to the budget.  The budget is cut into equal blocks of
words.  Sources receive blocks by the highest quotients target / (2 k + 1).  A source has a shard (a hash of
the id) for every ``SHARD_WORDS`` of its words; shards are the leaves of a tree with ``FAN`` branches, and at
every node its branches receive blocks the same way by their sizes, as far as they have room, so every
shard has an integer quota and no group is larger than the fan.  In each shard the documents are laid end to
end in a seeded order as a ring of words; the quota is spent on whole rounds of the ring and then on
consecutive blocks from a seeded start.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._store import stored
from ._text import WORD

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
CAP = 2
BLOCK = 16
SHARD_WORDS = 1 << 16
FAN = 1024
SEED = 20


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, budget: float = BUDGET, cap: int = CAP) -> DataFrame:
    """Rows ``(source, source_size, target)`` from rows ``(source, source_size)``.

    Weights repeat over the sources in code-point order, NULL last.  A source that reaches ``cap`` times
    its size stops there, and the excess goes to the others by weight until none is above.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    k = (F.row_number().over(order) - 1) % len(weights)
    ranked = sizes.select("source", "source_size", F.get(F.lit(list(map(float, weights))), k).alias("w"))
    ranked = ranked.withColumn("most", F.col("source_size") * float(cap)).withColumn("full_at", F.col("most") / F.col("w"))
    by_level = Window.orderBy("full_at", F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    level = (F.sum("source_size").over(everything) * float(budget) - F.coalesce(F.sum("most").over(before), F.lit(0.0))) / (
        F.sum("w").over(everything) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    ranked = ranked.withColumn("level", level)
    final = F.coalesce(F.min(F.when(F.col("level") <= F.col("full_at"), F.struct("full_at", "level"))).over(everything)["level"], F.max("full_at").over(everything))
    return ranked.withColumn("final", final).select("source", "source_size", F.least("most", F.col("w") * F.col("final")).alias("target"))


def apportion(parties: DataFrame, votes: str, seats: Column, within: list[str], tie: list[str], out: str) -> DataFrame:
    """Add the column ``out``: Sainte-Lague seats of each row among the rows of its ``within`` group.

    The k-th seat of a row has quotient votes / (2 k - 1).  At divisor V / (S + n/2) the rounded
    entitlements hold at least S seats and at V / (S - n/2) at most S (n rows, V votes, S seats), so only
    the seats between the two, about two a row, are ranked by quotient.  Ties go by ``tie``.
    """
    group = Window.partitionBy(*within)
    v, n, s = F.sum(votes).over(group), F.count("*").over(group), F.col("_seats")
    x = parties.withColumn("_seats", seats.cast("bigint")).withColumn("_v", v).withColumn("_n", n)
    share = F.when(F.col("_v") > 0, F.col(votes) / F.col("_v")).otherwise(F.lit(0.0))
    least = F.floor(share * F.greatest(s - F.col("_n") / 2.0 - 1e-6, F.lit(0.0)) + 0.5)
    most = F.floor(share * (s + F.col("_n") / 2.0 + 1e-6) + 0.5)
    x = x.withColumn("_least", F.when(s - F.col("_n") / 2.0 > 0, least).otherwise(F.lit(0))).withColumn("_most", most)
    x = x.withColumn("_open", s - F.sum("_least").over(group))
    asked = x.where("_most > _least").select(*within, *tie, votes, "_open", F.explode(F.sequence(F.col("_least") + 1, F.col("_most"))).alias("_k"))
    rank = F.row_number().over(Window.partitionBy(*within).orderBy((F.col(votes) / (2 * F.col("_k") - 1)).desc(), *[F.col(t).asc_nulls_last() for t in tie], "_k"))
    won = asked.withColumn("_rank", rank).where("_rank <= _open").groupBy(*dict.fromkeys([*within, *tie])).agg(F.count("*").alias("_won"))
    keys = list(dict.fromkeys([*within, *tie]))
    a, b = x.alias("a"), won.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    cols = [F.col(f"a.{c}").alias(c) for c in parties.columns]
    return a.join(b, on, "left").select(*cols, (F.col("a._least") + F.coalesce("b._won", F.lit(0))).cast("bigint").alias(out))


def deal(parties: DataFrame, votes: str, room: str, words: Column, within: list[str], tie: list[str], out: str, block: int = BLOCK) -> DataFrame:
    """Add the column ``out``: how many of its ``within`` group's ``words`` each row gets, ``room`` words at most.

    Blocks are apportioned by ``votes``; what a row has no room for, and the rest of the words that fill no
    block, is apportioned word by word among the rows by the room they have left.  Nothing is lost while the
    group has room.
    """
    first = apportion(parties.withColumn("_words", words.cast("bigint")), votes, F.floor(F.col("_words") / block), within, tie, "_blocks")
    first = first.withColumn("_got", F.least(F.col("_blocks") * block, F.floor(room))).withColumn("_free", (F.floor(room) - F.col("_got")).cast("double"))
    group = Window.partitionBy(*within)
    rest = F.least(F.col("_words") - F.sum("_got").over(group), F.sum("_free").over(group))
    more = apportion(first.withColumn("_rest", rest), "_free", F.col("_rest"), within, tie, "_more")
    return more.select(*parties.columns, (F.col("_got") + F.least(F.col("_more"), F.col("_free").cast("bigint"))).cast("bigint").alias(out))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS,
    budget: float = BUDGET, cap: int = CAP, block: int = BLOCK, shard_words: int = SHARD_WORDS, fan: int = FAN, seed: int = SEED,
) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, taken``.

    ``size`` counts words, NULL texts have none.  ``taken`` is how many of its words the mix takes, repeats
    counted: at most ``cap`` times its size, the same in every run and on every cluster.  A source's taken
    words are within a block of its target.  Sources with equal quotients are served by code point, shards by
    number.  The seeded order depends on ids, sizes and text hashes, so neither file order nor repeated rows
    disturb it.  A NULL id, source or text is a value like any other.  A text is counted whole, whatever its
    length.  An empty table, or one without words, takes nothing.  Other columns are ignored.
    """
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint")
    sized = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("turn"))
    sized = stored(sized, "sizes")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every = source_targets(sources, weights, budget, cap).withColumn("all", F.lit(0)).withColumn("most", F.least(F.col("source_size") * cap, F.ceil("target")))
    every = deal(every, "target", "most", F.round(F.sum("target").over(Window.partitionBy("all"))), ["all"], ["source"], "words", block)
    every = stored(every.select(F.col("source").alias("s"), "source_size", "target", "words", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("bigint").alias("shards")), "targets")
    depth, most = 1, every.agg(F.max("shards")).first()[0] or 1
    while fan**depth < most:
        depth += 1

    # A document's shard follows from its id and the size of its source alone; shards are leaves of a tree.
    placed = sized.join(every.select("s", "shards"), F.col("source").eqNullSafe(F.col("s"))).select("doc_id", "source", "size", "turn", F.pmod(F.xxhash64(F.lit(seed), "doc_id", "turn"), "shards").alias("shard"))
    cells = stored(placed.groupBy("source", "shard").agg(F.sum("size").alias("cell")), "cells")
    dealt = every.select(F.col("s").alias("source"), F.lit(0).cast("bigint").alias("node"), "words")
    for level in range(1, depth + 1):
        nodes = cells.groupBy("source", F.floor(F.col("shard") / fan ** (depth - level)).alias("node")).agg(F.sum("cell").alias("cell"))
        n, up = nodes.withColumn("parent", F.floor(F.col("node") / fan)).alias("n"), dealt.alias("up")
        below = n.join(up, F.col("n.source").eqNullSafe(F.col("up.source")) & (F.col("n.parent") == F.col("up.node"))).select("n.source", "n.parent", "n.node", "n.cell", (F.col("n.cell") * cap).alias("room"), "up.words")
        dealt = stored(deal(below, "cell", "room", F.col("words"), ["source", "parent"], ["node"], "quota", block).select("source", "node", "cell", F.col("quota").alias("words")), "quotas")

    ring = Window.partitionBy("source", "shard").orderBy("turn", "doc_id", "size")
    laid = placed.withColumn("end", F.sum("size").over(ring.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    c, d, e = dealt.alias("c"), laid.alias("d"), every.alias("e")
    x = d.join(c, F.col("d.source").eqNullSafe(F.col("c.source")) & (F.col("d.shard") == F.col("c.node"))).join(e, F.col("d.source").eqNullSafe(F.col("e.s")))
    x = x.select("d.doc_id", "d.source", "d.shard", "d.size", "d.end", "c.cell", "c.words", "e.source_size", "e.target")
    rounds = F.when(F.col("cell") > 0, F.floor(F.col("words") / F.col("cell"))).otherwise(F.lit(0))
    rest = F.col("words") - rounds * F.col("cell")
    first = F.pmod(F.xxhash64(F.lit(seed), "source", "shard"), F.greatest(F.ceil(F.col("cell") / block), F.lit(1))) * block
    x = x.withColumn("rounds", rounds).withColumn("a", first).withColumn("b", first + rest).withColumn("begin", F.col("end") - F.col("size"))

    def shared(by: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("end") + by, F.col("b")) - F.greatest(F.col("begin") + by, F.col("a")))

    taken = F.col("rounds") * F.col("size") + shared(F.lit(0)) + shared(F.col("cell"))
    return x.select("doc_id", "source", "size", "source_size", F.col("target").cast("double").alias("target"), taken.cast("bigint").alias("taken"))
