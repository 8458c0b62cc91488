"""SimHash near-duplicates with pigeonring filtering.

A document's fingerprint has 64 bits, each the majority over XXH64 hashes of its word shingles.  Documents
link when their fingerprints differ in at most three bits.  The ring has four 16-bit segments with a
proportional budget of 3/4 bit each; if two fingerprints differ in at most three bits, then from some
segment on *every* chain of l consecutive segments differs in at most floor(3 l / 4) bits: 0, 1, 2, 3.
So one segment matches exactly and its successor within one bit, which leaves three of the successor's
four nibbles exact: candidates meet on 28 equal bits.  The remaining chain budgets prune them before the
full Hamming check.  Equal fingerprints are one vertex, so groups of copies cost one row.  Keys shared by
more than ``DENSE`` different fingerprints are refined by a quarter of all bits, up to six times; some quarter
must match each time, so that is exact too.  A fingerprint has at most 43,744 others within three bits,
so the links grow with the fingerprints and not with the square of a group.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ._store import stored

RADIUS = 3
DENSE = 512
_SLICE = 1 << 20


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """SimHash of the ASCII-lower-cased words' ``width``-shingles, repeats included."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = list(itertools.accumulate(map(len, words), lambda a, n: a + n + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    ends = ends[min(width, len(words)) - 1 :]
    digest, ones, n = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64), len(ends)
    for at in range(0, n, _SLICE):
        h = np.array([digest(line[a:b], seed) for a, b in zip(starts[at : at + _SLICE], ends[at : at + _SLICE], strict=False)], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """Rows ``(doc_id, fp)``, one for each row of ``docs``; NULL and blank texts have fingerprint zero."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), width, seed) for t in batch.column(1)], dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id bigint, fp bigint")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _first_masks() -> list[tuple[int, int]]:
    """``(start segment, mask)``: a segment and three nibbles of its successor, 28 bits each."""
    turn = lambda bits, i: (bits << 16 * i | bits >> 64 - 16 * i) & (1 << 64) - 1
    return [(i, turn(0xFFFF | (0xFFFF ^ (0xF << 4 * q)) << 16, i)) for i in range(4) for q in range(4)]


#: Ways to cut the 64 bits into four parts: three differing bits leave one part of each way equal.
_PARTS = tuple(
    tuple(_signed(sum(1 << b for b in range(64) if part(b) & 3 == k)) for k in range(4))
    for part in (lambda b: b, lambda b: b >> 2, lambda b: b >> 4, lambda b: b + (b >> 2), lambda b: b + (b >> 4), lambda b: (b >> 2) + (b >> 4))
)


def _keys(fps: DataFrame) -> DataFrame:
    """Sixteen rows per fingerprint: start segment, mask, and the fingerprint's bits under it."""
    rows = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(_signed(m)).alias("mask")) for i, m in _first_masks()))
    keys = fps.select("fp", F.explode(rows).alias("k")).select("fp", "k.i", "k.mask")
    return keys.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))


def links(fps: DataFrame, radius: int = RADIUS, dense: int = DENSE) -> DataFrame:
    """All pairs ``(a, b)``, a < b, of different fingerprints within ``radius`` bits (3 at most).

    A key that more than ``dense`` fingerprints share is refined by one part of the next of ``_PARTS``, so the
    join compares few pairs that are not links; at the end a key leaves about six bits open.
    """
    if not 0 <= radius <= 3:
        raise ValueError("the four-segment ring proves completeness for up to three bits")
    keys, done = _keys(fps), []
    for parts in _PARTS:
        crowded = stored(keys.groupBy("mask", "key").count().where(F.col("count") > dense).select("mask", "key"), "ring-crowded", 16)
        if crowded.isEmpty():
            break
        done.append(keys.join(crowded, ["mask", "key"], "left_anti").select("fp", "i", "mask", "key"))
        keys = keys.join(crowded, ["mask", "key"], "left_semi").select("fp", "i", F.explode(F.transform(F.lit(list(parts)), lambda p: F.col("mask").bitwiseOR(p))).alias("mask"))
        keys = stored(keys.withColumn("key", F.col("fp").bitwiseAND(F.col("mask"))).distinct(), "ring-finer-keys")
    for part in done:
        keys = keys.union(part.select(keys.columns))
    a, b = keys.select(F.col("fp").alias("a"), "i", "mask", "key"), keys.select(F.col("fp").alias("b"), F.col("i").alias("j"), F.col("mask").alias("m"), F.col("key").alias("k"))
    x = F.col("a").bitwiseXOR(F.col("b"))
    chain = [F.bit_count(_ring(x, F.col("i"), n)) <= n - 1 for n in (2, 3)]
    return a.join(b, [F.col("key") == F.col("k"), F.col("mask") == F.col("m"), F.col("i") == F.col("j"), F.col("a") < F.col("b"), *chain, F.bit_count(x) <= radius]).select("a", "b").distinct()


def _ring(x, i, n: int):
    """The bits of ``n`` consecutive segments from segment ``i`` of the ring on."""
    span = [_signed(sum(0xFFFF << 16 * ((k + j) % 4) for j in range(n))) for k in range(4)]
    return x.bitwiseAND(F.get(F.lit(span), i))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits) and ``component_id``.

    The component is the smallest id reachable over links, the document's own included.  NULL and blank
    texts have fingerprint zero and link like any other; repeated rows share a component; a row with a
    NULL id keeps its fingerprint, links to nothing and has a NULL component.  A text is read whole, in slices
    of its shingles.  An empty table gives no rows.  Other columns are ignored.
    """
    marked = stored(with_fingerprint(docs, id_col, text_col, width, seed), "fingerprints")
    groups = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")).dropna(), "fingerprint-groups")
    ids = marked.dropna()
    least = ids.groupBy("doc_id").agg(F.min("fp").alias("a"), F.max("fp").alias("most")).where("a <> most").select("doc_id", "a")
    twins = ids.join(least, "doc_id").select("a", F.col("fp").alias("b")).where("a <> b").distinct()
    found = links(groups.select("fp"), radius).union(twins)
    parts = connected_components(found, stored)
    roots = groups.join(parts, groups.fp == parts.id, "left").select("fp", F.coalesce("component", "fp").alias("root"), "first")
    first = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = roots.join(first, "root").select("fp", "component_id")
    many = marked.join(named, "fp", "left")
    return many.select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component; rows without an id all stay."""
    gone = near_duplicates(docs, id_col, text_col, **how).where("component_id <> doc_id").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
