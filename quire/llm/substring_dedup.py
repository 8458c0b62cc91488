"""Substring dedup: Rabin-Karp hashes of every fixed-length word window, counted in Spark.

Documents fall into chunks by a hash of id and text.  A chunk hashes all its windows and sends one packed
row to each range of the hash space: the distinct hashes and, beside each, the smallest document of the
chunk that holds it (about nine bytes a window on the wire).  Spark unpacks the rows and finds the smallest
document of every hash; hashes whose chunk only holds larger documents are late, and their places in the
packed rows go back to the chunk.  There late windows merge into maximal removal intervals.  A window found in
a third of all documents costs one entry per chunk.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._text import window_hashes, word_bounds, word_hashes

WINDOW = 50
CHUNK_BYTES = 4 << 20
RANGE_BYTES = 16 << 20
MOST_RANGES = 1 << 15
_PACKED = "chunk int, range int, key array<bigint>, doc array<bigint>"
_RESULT = "doc_id bigint, n_words bigint, n_removed bigint, spans array<struct<start:bigint,end:bigint>>, kept_text string, kept_sha256 string"


def _raw(text: pa.StringScalar) -> bytes:
    return (text.as_py() or "").encode("utf-8", "surrogatepass")


def _windows(raw: bytes, width: int) -> np.ndarray:
    buf = np.frombuffer(raw, dtype=np.uint8)
    return window_hashes(word_hashes(buf, *word_bounds(buf)), width)


@dataclass
class _Chunk:
    """All windows of a chunk, in the order of ids and texts, and where their distinct hashes are sent."""

    sizes: list[int]  # windows of each row
    hashes: np.ndarray
    docs: np.ndarray
    lead: np.ndarray  # for each window, the first window with its hash; that is one of the smallest document
    sent: np.ndarray  # leading windows by range, in the rows' order within a range
    offsets: np.ndarray  # where each range begins in ``sent``


def _arranged(table: pa.Table, width: int, ranges: int) -> _Chunk:
    """Windows of rows sorted by id and text; rows without an id have none."""
    each = [_windows(_raw(t), width) if i.is_valid else np.zeros(0, np.uint64) for i, t in zip(table.column("doc_id"), table.column("text"), strict=True)]
    sizes = [len(h) for h in each]
    hashes, docs = np.concatenate(each), np.repeat(table.column("doc_id").fill_null(0).to_numpy(), sizes)
    order = np.argsort(hashes, kind="stable")
    new = np.ones(len(order), dtype=bool)
    new[1:] = hashes[order[1:]] != hashes[order[:-1]]
    firsts = order[new]
    lead = np.empty(len(order), dtype=np.int64)
    lead[order] = firsts[np.cumsum(new) - 1]
    firsts = np.sort(firsts)
    spot = ((hashes[firsts] >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.uint16)
    return _Chunk(sizes, hashes, docs, lead, firsts[np.argsort(spot, kind="stable")], np.searchsorted(np.sort(spot), np.arange(ranges + 1)))


def _labels(spark: SparkSession, n: int) -> np.ndarray:
    """Integers of which a shuffle by hash into ``n`` partitions sends the k-th to the k-th, so that none gets two."""
    ids = spark.range(64 * n).select(F.col("id").cast("int").alias("id"))
    rows = ids.groupBy(F.pmod(F.hash("id"), F.lit(n)).alias("k")).agg(F.min("id").alias("id")).collect()
    out = np.arange(64 * n, 65 * n, dtype=np.int32)
    for r in rows:
        out[r["k"]] = r["id"]
    return out


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, chunks: int | None = None, ranges: int | None = None) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, spans, kept_text, kept_sha256``.

    Removed is each word that some window covers whose words also start in a document with a smaller id;
    windows are judged on the input.  ``spans`` are the maximal removed intervals in words, end exclusive.
    Texts of fewer words than a window, blank and NULL texts lose nothing.  Windows repeated inside one
    document, or in rows with the same id, stay.  Rows with a NULL id neither give nor lose words.
    By default there is a chunk for every ``CHUNK_BYTES`` of text and a range for every ``RANGE_BYTES``, at most
    ``MOST_RANGES``, so packed rows grow with the input and a task's memory does not (beyond half a TB a range grows, and sorts on disk); one text is always
    held whole.  The result depends on neither.  Equal 64-bit hashes count as equal windows.  Other
    columns are ignored.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    if not (chunks and ranges):
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        chunks, ranges = chunks or max(8, -(-size // CHUNK_BYTES)), ranges or min(MOST_RANGES, max(8, -(-size // RANGE_BYTES)))
    rows = rows.withColumn("turn", F.xxhash64("doc_id", "text")).withColumn("chunk", F.pmod("turn", F.lit(chunks)).cast("int"))
    rows, labels = rows.repartition(max(8, chunks // 4), "chunk"), _labels(docs.sparkSession, ranges)

    def pack(table: pa.Table) -> pa.Table:
        c = _arranged(table.sort_by([("doc_id", "ascending"), ("turn", "ascending")]), window, ranges)
        used = np.flatnonzero(np.diff(c.offsets))
        offsets = pa.array(np.append(c.offsets[used], len(c.sent)), pa.int32())
        lists = [pa.ListArray.from_arrays(offsets, pa.array(x[c.sent])) for x in (c.hashes.view(np.int64), c.docs)]
        return pa.Table.from_arrays([pa.array([table.column("chunk")[0].as_py()] * len(used), pa.int32()), pa.array(labels[used]), *lists], ["chunk", "range", "key", "doc"])

    packed = rows.groupBy("chunk").applyInArrow(pack, _PACKED).repartition(ranges, "range")
    each = packed.select("chunk", "range", F.posexplode(F.arrays_zip("key", "doc")).alias("at", "x")).select("chunk", "range", "at", "x.key", "x.doc")
    first = F.min("doc").over(Window.partitionBy("key", "range"))
    flags = each.withColumn("first", first).where("doc > first").groupBy("chunk", "range").agg(F.collect_list("at").alias("late"))

    def remove(table: pa.Table, flags: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending"), ("turn", "ascending")])
        c = _arranged(table, window, ranges)
        late = np.zeros(len(c.hashes), dtype=bool)
        begins = dict(zip(labels.tolist(), c.offsets.tolist(), strict=False))
        for r, places in zip(flags.column("range").to_pylist(), flags.column("late"), strict=True):
            late[c.sent[begins[r] + places.values.to_numpy()]] = True
        late = late[c.lead] | (c.docs > c.docs[c.lead])
        out: list[list] = [[], [], [], [], []]
        for text, hit in zip(table.column("text"), np.split(late, np.cumsum(c.sizes)[:-1]), strict=True):
            raw = _raw(text)
            left = raw.split()
            step = np.zeros(len(left) + 1, dtype=np.int8)
            step[: len(hit)] += hit
            step[window : window + len(hit)] -= hit
            gone = np.cumsum(step[:-1], dtype=np.int64) > 0
            edge = np.diff(np.concatenate(([0], gone.astype(np.int8), [0])))
            spans = [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1), strict=True)]
            kept = b" ".join(w for w, g in zip(left, gone.tolist(), strict=True) if not g) if spans else b" ".join(left)
            for column, value in zip(out, (len(left), int(gone.sum()), spans, kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()), strict=True):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.string(), pa.string())
        return pa.Table.from_arrays([table.column("doc_id"), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True))], ["doc_id", "n_words", "n_removed", "spans", "kept_text", "kept_sha256"])

    return rows.groupBy("chunk").cogroup(flags.groupBy("chunk")).applyInArrow(remove, _RESULT)
