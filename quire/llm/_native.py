"""Column expressions over texts shared by the operators that run inside the JVM only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._text import BLANK

BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL and blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANK + "+"))


def hashes(items: Column) -> Column:
    """A 64-bit hash of each array element."""
    return F.transform(items, lambda w: F.xxhash64(w))


def total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0), lambda a, b: a + b)
