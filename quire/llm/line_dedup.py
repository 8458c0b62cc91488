"""Line dedup over levelled sorted runs.

The index is a log-structured set of line hashes: a run is a table of 128-bit line hashes with the smallest
document holding each, bucketed and sorted by hash, so that joins and merges of runs move no row of theirs.
Batches arrive in ascending id order.  Each one merge-anti-joins every run (a sort-merge join), and what is
new becomes a run of level 0.  When a level holds ``fanout`` runs they are merged, bucket by bucket, into one
run of the next level, so an index of n batches has O(log n) runs and every hash is rewritten O(log n) times.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ._store import dropped, fresh_path, stored
from ._text import BLANK_BYTES

MIN_CHARS = 10
BATCHES = 4
FANOUT = 2
BUCKET_ROWS = 500_000
MOST_BUCKETS = 20_000
HEAVY = 4000
SAMPLE = 1_000_000
_RESULT = StructType().add("doc_id", "long").add("n_lines", "long").add("n_dropped", "long").add("kept_text", "string").add("kept_sha256", "string")


def line_keys(text: str | None) -> tuple[list[bytes], list[bytes]]:
    """The lines of a text as bytes and their keys: blanks stripped at both ends, A-Z lower-cased."""
    lines = (text or "").encode("utf-8", "surrogatepass").split(b"\n")
    return lines, [line.strip(BLANK_BYTES).lower() for line in lines]


def _digests(keys: list[bytes], min_chars: int) -> list[tuple[int, int] | None]:
    out = []
    for k in keys:
        if len(k) < min_chars or len(k) < 4 * min_chars and len(k.decode("utf-8", "surrogatepass")) < min_chars:
            out.append(None)
        else:
            d = xxhash.xxh3_128_digest(k)
            out.append((int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)))
    return out


def hashed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS) -> DataFrame:
    """Rows ``(lo, hi, doc_id, salt)``, distinct within a row of ``docs``; none for rows without an id.  The salt is
    a byte of the text's hash, which splits rows that share an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, salts, lo, hi = [], [], [], []
            for doc, salt, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                if doc is not None:
                    for a, b in {d for d in _digests(line_keys(text.as_py())[1], min_chars) if d}:
                        ids.append(doc), salts.append(salt), lo.append(a), hi.append(b)
            columns = [*(pa.array(x, pa.int64()) for x in (lo, hi, ids)), pa.array(salts, pa.int8())]
            yield pa.RecordBatch.from_arrays(columns, ["lo", "hi", "doc_id", "salt"])

    return _rows(docs, id_col, text_col).select("doc_id", "salt", "text").mapInArrow(run, "lo bigint, hi bigint, doc_id bigint, salt tinyint")


def _rows(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    salt = F.xxhash64(text_col).bitwiseAND(F.lit(127)).cast("tinyint")
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), salt.alias("salt"), *more)


class LineIndex:
    """Levelled sorted runs of line hashes, as bucketed tables of the session's catalog with files in the shared folder.

    A batch is shuffled to where the runs already are; ``rows`` is about how many hashes are to come.
    """

    def __init__(self, spark: SparkSession, fanout: int = FANOUT, rows: int = 0) -> None:
        self.spark, self.fanout, self.levels = spark, fanout, []
        self.buckets = min(max(8, rows // BUCKET_ROWS), MOST_BUCKETS)

    def runs(self) -> list[DataFrame]:
        """The runs; every hash is in exactly one of them."""
        return [self.spark.table(name) for level in self.levels for name, _ in level]

    def add(self, batch: DataFrame) -> None:
        """Add the hashes ``(lo, hi, doc_id)`` of a batch whose ids are above those of earlier batches."""
        new = batch.groupBy("lo", "hi").agg(F.min("doc_id").alias("first")).repartition(self.buckets, "lo", "hi")
        for old in self.runs():
            new = new.join(old.select("lo", "hi").hint("merge"), ["lo", "hi"], "left_anti")
        self._push(0, new)

    def _push(self, level: int, run: DataFrame) -> None:
        if len(self.levels) <= level:
            self.levels.append([])
        name, path = f"quire_run_{uuid.uuid4().hex}", fresh_path(self.spark, f"run-{level}")
        run.write.format("parquet").bucketBy(self.buckets, "lo", "hi").sortBy("lo", "hi").option("path", path).saveAsTable(name)
        self.levels[level].append((name, path))
        if len(self.levels[level]) >= self.fanout:
            merged, self.levels[level] = self.levels[level], []
            self._push(level + 1, _merged([self.spark.table(n) for n, _ in merged]))
            for n, p in merged:
                self.spark.sql(f"DROP TABLE {n}")
                dropped(self.spark, p)


def _merged(runs: list[DataFrame]) -> DataFrame:
    """One run of several that share no hash, by merge joins inside the buckets."""
    out = runs[0]
    for run in runs[1:]:
        other = run.select("lo", "hi", F.col("first").alias("other")).hint("merge")
        out = out.join(other, ["lo", "hi"], "full").select("lo", "hi", F.coalesce("first", "other").alias("first"))
    return out


def build_index(spark: SparkSession, lines: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> LineIndex:
    """Feed hashed lines to a new index in ``batches`` id ranges of about equal size.

    A batch is a distributed table, so its size bounds no task's memory; a table that is deduplicated at once
    needs few batches whatever its size, as each of them reads the whole index.
    """
    cuts = lines.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0] if batches > 1 else []
    cuts = sorted(set(cuts or []))
    index = LineIndex(spark, fanout, lines.count())
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        part = lines
        if low is not None:
            part = part.where(F.col("doc_id") > low)
        if high is not None:
            part = part.where(F.col("doc_id") <= high)
        index.add(part)
    return index


def _late(lines: DataFrame, index: LineIndex) -> DataFrame:
    """Rows ``(lo, hi, doc_id, salt)`` of lines that a document with a smaller id holds.

    Lines with more than about ``1 / HEAVY`` of a sample of at most ``SAMPLE`` rows are heavy.  There are at most
    ``HEAVY`` of them, so their first documents are broadcast and no task gets all rows of such a line; the
    sample decides where rows are joined, not the result.
    """
    runs, buckets = index.runs(), index.buckets
    share = min(1.0, SAMPLE / max(1, lines.count()))
    seen = lines.sample(share, 7).groupBy("lo", "hi").count()
    heavy = stored(seen.where(F.col("count") >= max(100, SAMPLE // HEAVY)).orderBy(F.desc("count"), "lo", "hi").limit(HEAVY).select("lo", "hi"), "heavy-lines", 1)
    light = lines.join(F.broadcast(heavy), ["lo", "hi"], "left_anti").repartition(buckets, "lo", "hi")
    parts = []
    for run in runs:
        parts.append(light.join(run.hint("merge"), ["lo", "hi"]))
        parts.append(lines.join(F.broadcast(run.join(F.broadcast(heavy), ["lo", "hi"], "left_semi")), ["lo", "hi"]))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where("doc_id > first").select("lo", "hi", "doc_id", "salt")


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    min_chars: int = MIN_CHARS, batches: int = BATCHES, fanout: int = FANOUT, carry: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``doc_id, n_lines, n_dropped, kept_text, kept_sha256``.

    A line whose key has ``min_chars`` code points or more and occurs in a document with a smaller id is
    dropped.  A NULL or empty text is one empty line; a text is held whole, whatever its length.  Repeats
    inside one document and in rows with the same id stay.  Rows with a NULL id neither give nor lose lines.  An
    empty table gives no rows.  Equal 128-bit hashes count as equal keys.  Columns named in ``carry`` come along in
    the struct ``carried``, where their names can't clash; others are ignored.
    """
    spark = docs.sparkSession
    lines = stored(hashed_lines(docs, id_col, text_col, min_chars), "line-hashes")
    late = _late(lines, build_index(spark, lines, batches, fanout))
    late = late.groupBy(F.col("doc_id").alias("_id"), F.col("salt").alias("_salt")).agg(F.collect_list(F.struct("lo", "hi")).alias("_late"))
    more = ["carried"] if carry else []
    rows = _rows(docs, id_col, text_col, *(F.struct(*carry).alias(c) for c in more))
    rows = rows.join(late, (F.col("doc_id") == F.col("_id")) & (F.col("salt") == F.col("_salt")), "left").select("doc_id", "text", "_late", *more)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text, late in zip(batch.column(1), batch.column(2), strict=True):
                lines, keys = line_keys(text.as_py())
                gone = {(x["lo"], x["hi"]) for x in late.as_py()} if late.is_valid else ()
                left = [x for x, d in zip(lines, _digests(keys, min_chars), strict=True) if d not in gone] if gone else lines
                kept = b"\n".join(left)
                for column, value in zip(out, (len(lines), len(lines) - len(left), kept.decode("utf-8", "replace"), hashlib.sha256(kept).hexdigest()), strict=True):
                    column.append(value)
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True)), *batch.columns[3:]], [*_RESULT.names, *more])

    return rows.mapInArrow(run, StructType([*_RESULT.fields, *(rows.schema[c] for c in more)]))
