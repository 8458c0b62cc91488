"""Keyed mutations as DataFrame-to-DataFrame functions.

Parquet has no MERGE, so each function returns the table's next state; :func:`quire.sources.tables.replace_partitions`
writes only the partitions a delta touches.  Keys compare null-safely only where a function says so.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _columns(df: DataFrame, names: Sequence[str], prefix: str = "") -> list[Column]:
    return [F.col(prefix + n).alias(n) for n in names]


def insert_or_ignore(table: DataFrame, delta: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First write wins: rows of the table stay, of equal new keys the first by ``order`` enters."""
    new = delta.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(order))).where("_r = 1").drop("_r")
    return table.unionByName(new.join(table.select(*keys), list(keys), "left_anti").select(*table.columns))


def insert_or_replace(table: DataFrame, delta: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """Last write wins: of equal new keys the last by ``order`` replaces the table's row."""
    new = delta.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))).where("_r = 1").drop("_r")
    return table.join(new.select(*keys), list(keys), "left_anti").unionByName(new.select(*table.columns))


def upsert(table: DataFrame, delta: DataFrame, keys: Sequence[str], policy: Mapping[str, str]) -> DataFrame:
    """Full outer join on unique keys with a policy per column.

    ``new``: the new value overwrites; ``fill``: the old value stays unless NULL; ``keep``: the old row's value
    stays even if NULL; ``least`` and ``greatest``: the wider of both, ignoring NULLs.
    """
    o, n = table.alias("o"), delta.alias("n")
    on = F.lit(True)
    for k in keys:
        on = on & (F.col(f"o.{k}") == F.col(f"n.{k}"))
    was, came = F.col(f"o.{keys[0]}").isNotNull(), F.col(f"n.{keys[0]}").isNotNull()
    rules = {
        "new": lambda a, b: F.when(came, b).otherwise(a), "fill": lambda a, b: F.coalesce(a, b), "keep": lambda a, b: F.when(was, a).otherwise(b),
        "least": lambda a, b: F.least(a, b), "greatest": lambda a, b: F.greatest(a, b),
    }
    cols = [F.coalesce(f"o.{c}", f"n.{c}").alias(c) if c in keys else rules[policy[c]](F.col(f"o.{c}"), F.col(f"n.{c}")).alias(c) for c in table.columns]
    return o.join(n, on, "full").select(*cols)


def delete_unprotected(table: DataFrame, doomed: DataFrame, keys: Sequence[str], protected: str) -> DataFrame:
    """Delete the rows of the given keys except protected ones."""
    mark = doomed.select(*keys).distinct().withColumn("_doomed", F.lit(True))
    return table.join(mark, list(keys), "left").where(F.col("_doomed").isNull() | F.coalesce(F.col(protected), F.lit(False))).drop("_doomed").select(*table.columns)


def insert_unless_protected(table: DataFrame, delta: DataFrame, keys: Sequence[str], protected: str) -> DataFrame:
    """Append rows whose key has no protected row."""
    return table.unionByName(delta.join(table.where(F.col(protected)).select(*keys).distinct(), list(keys), "left_anti").select(*table.columns))


def claim(requests: DataFrame, existing: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Idempotent claim: the existing id of a natural key, else one derived from the key alone."""
    fresh = F.sha2(F.concat_ws("|", *keys), 256)
    known = existing.select(*keys, F.col(id_col).alias("_id"))
    joined = requests.select(*keys).distinct().join(known, list(keys), "left")
    return joined.select(*keys, F.coalesce("_id", fresh).alias(id_col), F.col("_id").isNull().alias("is_new"))


def transition(table: DataFrame, events: DataFrame, key: str, status: str) -> DataFrame:
    """Set the status of the rows that an event names; others stay."""
    to = events.select(F.col(key).alias("_k"), F.col(status).alias("_to"))
    return table.join(to, table[key] == to["_k"], "left").select(*(F.coalesce("_to", status).alias(c) if c == status else table[c] for c in table.columns))


def audit(before: DataFrame, after: DataFrame, key: str, command: str) -> DataFrame:
    """One row per changed key with both states as JSON; NULL for an insert's before and a delete's after."""
    b = before.select(F.col(key).alias("_b"), F.to_json(F.struct(*sorted(before.columns))).alias("before"))
    a = after.select(F.col(key).alias("_a"), F.to_json(F.struct(*sorted(after.columns))).alias("after"))
    both = b.join(a, F.col("_b") == F.col("_a"), "full").where(~F.col("before").eqNullSafe(F.col("after")))
    return both.select(F.coalesce("_b", "_a").alias("key"), F.lit(command).alias("command"), "before", "after")


def undo(after: DataFrame, log: DataFrame, key: str) -> DataFrame:
    """Apply the inverse of each audited change: restore, delete or insert again."""
    back = F.from_json("before", after.schema)
    restored = log.where("before is not null").select(back.alias("r")).select(*(F.col(f"r.{c}").alias(c) for c in after.columns))
    return after.join(log.select(F.col("key").alias("_k")), after[key] == F.col("_k"), "left_anti").unionByName(restored)


def latest_undoable(history: DataFrame) -> DataFrame:
    """The newest entry that is neither undone nor itself an undo."""
    return history.where(F.col("undone_at").isNull() & ~F.lower("command").startswith("undo")).orderBy(F.desc("id")).limit(1)


def merge_entities(mentions: DataFrame, merges: DataFrame, entity: str, item: str, span: str) -> DataFrame:
    """Repoint mentions from dropped to kept entities and drop the collisions that makes."""
    to = merges.select(F.col("drop_id").alias("_d"), F.col("keep_id").alias("_k"))
    moved = mentions.join(to, mentions[entity] == to["_d"], "left").select(F.col(item), F.coalesce("_k", entity).alias(entity), F.col(span))
    return moved.dropDuplicates([item, entity, span])


def widen_spans(entities: DataFrame, merges: DataFrame, key: str, first: str, last: str) -> DataFrame:
    """Entities after merges: losers go, the kept one's dates span both."""
    to = merges.select(F.col("drop_id").alias("_d"), F.col("keep_id").alias("_k"))
    joined = entities.join(to, entities[key] == to["_d"], "left").select(F.coalesce("_k", key).alias(key), first, last)
    return joined.groupBy(key).agg(F.min(first).alias(first), F.max(last).alias(last))


def next_index(table: DataFrame, keys: Sequence[str], name: str, pattern: str) -> DataFrame:
    """Per key one more than the largest number that ``pattern`` captures in ``name``; 1 without any."""
    n = F.expr(f"try_cast(nullif(regexp_extract({name}, '{pattern}', 1), '') as bigint)")
    return table.groupBy(*keys).agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("next_index"))
