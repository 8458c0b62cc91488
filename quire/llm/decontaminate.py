"""Benchmark decontamination with spaced seeds.

A mask such as ``11011`` reads the words at its ones and ignores those at its zeros, so a substituted
word under a zero does not hide a hit.  The masks lose nothing: k substitutions leave n - k words in at most
k + 1 runs, so four words of five leave a run of four (``1111``) except in items of 5, 6, 7, 10, 11 and 15
words; there, from 6 words on, every accepted pattern without such a run fits ``11011``, and 5 words take all
masks of four.  Every mask is laid on every position of every document; a position
survives if both of its hash's bits are set in a bitmap of the benchmark's hashes (``BITS_PER_SEED`` bits a seed, at
most ``BITMAP_BITS``), and the survivors join the benchmark's hashes exactly.  Around each hit both texts
are compared word by word on the hit's diagonal, and the overlap counts if some stretch of ``stretch``
words (the whole item, if shorter) agrees in at least ``similarity`` of them.  JVM expressions only.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._native import hashes, total, words
from ._store import stored

MASKS = ("1111", "11011")
FIVE = ("1111", "11101", "11011", "10111")
STRETCH = 20
SIMILARITY = 0.8
MIN_WORDS = 1
BITS_PER_SEED = 16
BITMAP_BITS = 1 << 24
BROADCAST_SEEDS = 200_000


def _seed(hashed: Column, at: Column, mask: str) -> Column:
    return F.xxhash64(*(F.get(hashed, at + k) for k, bit in enumerate(mask) if bit == "1"), F.lit(mask))


def _starts(n: Column, mask: str) -> Column:
    """All positions where the mask fits."""
    return F.when(n >= len(mask), F.sequence(F.lit(0), n - len(mask))).otherwise(F.array().cast("array<int>"))


def _slots(h: Column, bits: int) -> list[Column]:
    return [x.bitwiseAND(F.lit(bits - 1)) for x in (h, F.shiftrightunsigned(h, 32))]


def benchmark_seeds(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", masks: tuple[str, ...] = MASKS, min_words: int = MIN_WORDS) -> DataFrame:
    """Rows ``(h, item_id, j, item)``: each mask at each position of each item.

    An item of up to four words is read by one full mask of its own length, so it matches whole, one of five by
    ``FIVE`` and a longer one that is shorter than the masks by ``MASKS``; items of fewer than ``min_words``
    words, without a word and NULL texts give no seeds.
    """
    span = max(len(FIVE[-1]) + 1, *map(len, masks))
    items = benchmark.select(F.col(id_col).alias("item_id"), hashes(words(F.lower(F.col(text_col)))).alias("item"))
    items = items.withColumn("n", F.size("item")).where(F.col("n") >= max(1, min_words))
    short = {n: ("1" * n,) if n < 5 else FIVE if n == 5 else MASKS for n in range(max(min_words, 1), span)}
    used = sorted({*masks, *(m for some in short.values() for m in some)})
    parts = []
    for m in used:
        read = F.col("n").isin([n for n, some in short.items() if m in some]) | ((F.col("n") >= span) & F.lit(m in masks))
        parts.append(items.where(read).select("item_id", "item", F.explode(_starts(F.col("n"), m)).alias("j"), F.lit(m).alias("mask")))
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    h = F.lit(None).cast("bigint")
    for m in used:
        h = F.when(F.col("mask") == m, _seed(F.col("item"), F.col("j"), m)).otherwise(h)
    return out.select(h.alias("h"), "mask", "item_id", "j", "item")


def find_overlaps(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text", masks: tuple[str, ...] = MASKS, stretch: int = STRETCH, similarity: float = SIMILARITY, min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per contaminated document and item: ``doc_id, item_id, start, n_matched, overlap, contaminated``.

    ``start`` is the word where the best diagonal meets the document (negative if the item begins before
    it), ``n_matched`` the words equal on that diagonal and ``overlap`` their share of the item.  Words are
    compared in lower case.  Of equally good diagonals the first counts.  NULL and blank texts match nothing;
    rows with a NULL id are not judged, items with a NULL id not looked for; repeated rows report once; an
    empty table on either side gives an empty result.  A text is read whole.  Other columns are ignored.
    With ``MASKS``, a ``similarity`` of 0.8 or more and a ``stretch`` of 6 or more no overlap is missed.
    """
    spark = docs.sparkSession
    # Items of equal words are looked for once, under the least id; all their ids are reported.
    said = benchmark.where(F.col(item_col).isNotNull()).select(F.col(item_col).alias("item_id"), F.array_join(words(F.lower(F.col(item_text))), " ").alias("text"))
    twins = stored(said.join(said.groupBy(F.col("text").alias("t")).agg(F.min("item_id").alias("least")), F.col("text") == F.col("t")).select("item_id", "text", "least"), "items")
    seeds = stored(benchmark_seeds(twins.where("item_id = least").dropDuplicates(["item_id", "text"]).select("item_id", "text"), masks=masks, min_words=min_words), "seeds")
    facts = seeds.agg(F.count("*").alias("rows"), F.max(F.size("item")).alias("longest"), F.collect_set("mask").alias("masks")).first()
    used, longest = sorted(facts["masks"]), facts["longest"] or 0
    bits = 1 << 12
    while bits < min(BITMAP_BITS, BITS_PER_SEED * facts["rows"]):
        bits *= 2
    slots = seeds.select(F.explode(F.array(*_slots(F.col("h"), bits))).alias("slot"))
    lanes = slots.groupBy(F.shiftright("slot", 6).alias("lane")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("slot").bitwiseAND(F.lit(63)).cast("int"))))
    lanes = {r[0]: r[1] for r in lanes.collect()}
    bitmap = F.from_json(F.lit(json.dumps([lanes.get(k, 0) for k in range(bits >> 6)])), "array<bigint>")

    hashed, n = F.col("hashed"), F.size("hashed")
    def known(at: Column, mask: str) -> Column:
        h = _seed(hashed, at, mask)

        def both(h: Column) -> Column:
            one, two = (F.getbit(F.get(bitmap, F.shiftright(x, 6).cast("int")), x.bitwiseAND(F.lit(63)).cast("int")) == 1 for x in _slots(h, bits))
            return one & two

        return (at + len(mask) <= n) & F.exists(F.array(h), both)

    rows = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), hashes(words(F.lower(F.col(text_col)))).alias("hashed"))
    shortest = min(map(len, used), default=1)
    found = F.array().cast("array<int>")
    if used:
        def any_known(at: Column) -> Column:
            out = known(at, used[0])
            for m in used[1:]:
                out = out | known(at, m)
            return out
        found = F.filter(F.when(n >= shortest, F.sequence(F.lit(0), n - shortest)).otherwise(found), any_known)
    low = lambda at: F.greatest(at - longest, F.lit(0))
    hits = rows.select("doc_id", F.explode(F.transform(found, lambda at: F.struct(at.alias("at"), low(at).alias("low"), F.slice(hashed, low(at) + 1, F.lit(2 * longest + 1)).alias("near")))).alias("hit"))
    hits = hits.select("doc_id", "hit.*")
    probes = F.array(*(F.struct(F.lit(m).alias("mask"), _seed(F.col("near"), F.col("at") - F.col("low"), m).alias("h")) for m in used)) if used else F.array().cast("array<struct<mask:string,h:bigint>>")
    hits = hits.select("doc_id", "at", "low", "near", F.explode(probes).alias("p")).select("doc_id", "at", "low", "near", "p.mask", "p.h")
    side = F.broadcast(seeds) if facts["rows"] <= BROADCAST_SEEDS and facts["rows"] * max(longest, 1) <= 20 * BROADCAST_SEEDS else seeds
    pairs = hits.join(side, ["mask", "h"])

    shift = F.col("at") - F.col("j") - F.col("low")
    same = F.transform(F.col("item"), lambda h, k: F.when(F.get(F.col("near"), k + shift) == h, F.lit(1)).otherwise(F.lit(0)))
    pairs = pairs.select("doc_id", "item_id", "item", (F.col("at") - F.col("j")).alias("start"), F.size("item").alias("n"), same.alias("same"))
    pairs = pairs.withColumn("n_matched", total(F.col("same")))
    need = math.ceil(similarity * stretch)
    best = F.array_max(F.transform(F.sequence(F.lit(0), F.greatest(F.col("n") - stretch, F.lit(0))), lambda k: total(F.slice(F.col("same"), k + 1, F.lit(stretch)))))
    ok = (F.col("n_matched") >= F.ceil(F.col("n") * similarity)) | ((F.col("n") > stretch) & (F.col("n_matched") >= need) & (best >= need))
    good = pairs.where(ok).select("doc_id", "item_id", "item", "start", "n_matched", (F.col("n_matched") / F.col("n")).alias("overlap"))
    best = F.max(F.struct("n_matched", (-F.col("start")).alias("back"), "overlap")).alias("best")
    top = good.groupBy("doc_id", "item_id", "item").agg(best).select("doc_id", F.col("item_id").alias("least"), "item", "best")
    ids = twins.select("item_id", "least", hashes(words(F.col("text"))).alias("item")).distinct()
    top = top.join(ids, ["least", "item"]).groupBy("doc_id", "item_id").agg(F.max("best").alias("best"))
    return top.select("doc_id", "item_id", (-F.col("best.back")).cast("bigint").alias("start"), F.col("best.n_matched").cast("bigint").alias("n_matched"), F.col("best.overlap").alias("overlap"), F.lit(True).alias("contaminated"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the rows whose id overlaps a benchmark item; rows with a NULL id stay."""
    gone = find_overlaps(docs, benchmark, id_col, **how).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["_gone"], "left_anti")
