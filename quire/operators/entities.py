"""Entity resolution: keyed roll-up of mentions, duplicate tiers and review candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import dedup_key, key_of


def roll_up(mentions: DataFrame, name: str, seq: str, day: str) -> DataFrame:
    """One entity per normalised key: the first name seen, its date span, mention count and other spellings.

    Names without a letter or digit have no key and give no entity.
    """
    keyed = mentions.withColumn("_key", key_of(F.col(name))).where("_key <> ''")
    return keyed.groupBy(F.col("_key").alias("key")).agg(
        F.min_by(name, seq).alias("name"), F.min(day).alias("first_seen"), F.max(day).alias("last_seen"),
        F.count("*").alias("n_mentions"), (F.countDistinct(name) - 1).alias("n_aliases"),
    )


def duplicate_pairs(entities: DataFrame, key: str, name: str, least: int = 4, people: DataFrame | None = None, places: DataFrame | None = None) -> DataFrame:
    """Candidate duplicates: equal normalised names (0.9), or one containing the other (0.3).

    Only names that start alike are compared.  The shorter name is filed under its first character and its first
    three, the longer one under its first character and every three it holds, so names meet in an equi-join.  Names of
    an equal normalised form are grouped first, so a group of copies gives a chain of pairs to its first
    member rather than all pairs.  A contained name is no truncation if it is a place (``places`` has a column
    ``name``) or a single word that begins several of the names in ``people`` (likewise): a first name.
    """
    normal = entities.select(F.col(key).alias("id"), dedup_key(F.col(name)).alias("norm")).where("norm <> ''")
    heads = normal.groupBy("norm").agg(F.min("id").alias("head"))
    exact = normal.join(heads, "norm").where("id <> head").select(F.col("head").alias("id_a"), F.col("id").alias("id_b"), F.lit(0.9).alias("confidence"))
    size = max(1, min(3, least))
    gram = lambda at: F.concat(F.substr("norm", F.lit(1), F.lit(1)), F.substr("norm", at, F.lit(size)))
    a = heads.where(F.char_length("norm") >= least).select(gram(F.lit(1)).alias("block"), F.col("norm").alias("na"), F.col("head").alias("ha"))
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.char_length("norm") - size + 1), gram))
    b = heads.where(F.char_length("norm") > least).select(F.explode(grams).alias("block"), F.col("norm").alias("nb"), F.col("head").alias("hb"))
    if places is not None:
        a = a.join(places.select(dedup_key(F.col("name")).alias("na")).distinct(), "na", "left_anti").select("block", "na", "ha")
    if people is not None:
        word = F.lower(F.substring_index(F.trim("name"), " ", 1))
        often = people.select("name", word.alias("na")).groupBy("na").agg(F.countDistinct("name").alias("n")).where("n > 1")
        a = a.join(often, "na", "left_anti").select("block", "na", "ha")
    near = a.join(b, "block").where((F.col("na") != F.col("nb")) & F.contains("nb", "na"))
    partial = near.select(F.least("ha", "hb").alias("id_a"), F.greatest("ha", "hb").alias("id_b"), F.lit(0.3).alias("confidence"))
    return exact.union(partial.distinct())


def alive_around(entities: DataFrame, first: str, last: str, year: int, window: int = 40) -> DataFrame:
    """Entities whose years overlap ``[year - window, year + window]``; an unknown first year is kept."""
    return entities.where(F.col(first).isNull() | ((F.col(first) <= year + window) & (F.coalesce(last, first) >= year - window)))


def by_recency(entities: DataFrame, first: str, last: str, name: str, cap: int | None = None) -> DataFrame:
    """Unknown first dates first, then the most recently seen; ``rank`` counts from 1, at most ``cap``."""
    order = Window.orderBy(F.col(first).isNull().desc(), F.coalesce(last, first).desc(), name)
    ranked = entities.orderBy(F.col(first).isNull().desc(), F.coalesce(last, first).desc(), name).limit(cap) if cap else entities
    return ranked.withColumn("rank", F.row_number().over(order))


def new_between(entities: DataFrame, created: str, since: str, as_of: str) -> DataFrame:
    """Created in the half-open window (since, as_of]."""
    return entities.where((F.col(created) > F.lit(since).cast("timestamp_ntz")) & (F.col(created) <= F.lit(as_of).cast("timestamp_ntz")))


def snippets(mentions: DataFrame, entity: str, text: str, order: str, n: int = 3) -> DataFrame:
    """Up to ``n`` distinct snippets per entity in order of first appearance."""
    firsts = mentions.groupBy(entity, text).agg(F.min(order).alias("_o"))
    ranked = firsts.withColumn("_r", F.row_number().over(Window.partitionBy(entity).orderBy("_o", text))).where(F.col("_r") <= n)
    return ranked.groupBy(entity).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", text))), lambda s: s[text]), " | ").alias("snippets"))
