"""Model-output envelopes: fenced JSON parsed against a schema, with a reason for every rejection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import strip_fence

COLUMN_RESULT = "transcript_text string, transcriber_notes string, quality_flags struct<damage:boolean,faded:boolean,smudged:boolean,low_legibility:boolean,partial_cut:boolean,adjacent_text_visible:boolean>, repair_needed boolean, repair_reason string"
SLICED_RESULT = "slices array<struct<idx:int,transcript_text:string,transcriber_notes:string>>, repair_needed boolean, repair_reason string"
ITEMS_RESULT = "items array<struct<label:string,type:string,block_ids:array<int>>>"


def parse(raw: Column, schema: str) -> Column:
    """The envelope as a struct; NULL if it is not a JSON object."""
    body = strip_fence(raw)
    return F.when(body.startswith("{"), F.from_json(body, schema))


def with_verdict(df: DataFrame, raw: str, schema: str, required: tuple[str, ...]) -> DataFrame:
    """Add ``envelope`` and ``rejected``, NULL for a good one: ``not json`` or the first missing field."""
    out = df.withColumn("envelope", parse(F.col(raw), schema))
    gap = F.coalesce(*(F.when(F.col(f"envelope.{f}").isNull(), F.lit(f"missing {f}")) for f in required))
    empty = F.col("envelope").isNull() | F.coalesce(*(F.col(f"envelope.{f}").isNotNull() for f in required[:1]), F.lit(False)).isNull()
    return out.withColumn("rejected", F.when(empty, "not json").otherwise(gap))


def joined_slices(envelope: Column) -> Column:
    """The slices' texts in index order, one per line."""
    return F.array_join(F.transform(F.array_sort(F.transform(envelope["slices"], lambda s: F.struct(s["idx"].alias("idx"), s["transcript_text"].alias("text")))), lambda s: s["text"]), "\n")


def merged_slices(df: DataFrame, key: str, idx: str, text: str, flags: tuple[str, ...], joiner: str = "\n") -> DataFrame:
    """One row per key: the slices' texts in index order, and for each flag whether any slice sets it; NULL is not set."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(idx).alias("at"), F.coalesce(text, F.lit("")).alias("x")))), lambda s: s["x"])
    return df.groupBy(key).agg(F.array_join(rows, joiner).alias(text), *(F.bool_or(F.coalesce(f, F.lit(False))).alias(f) for f in flags))
