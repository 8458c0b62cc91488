"""The registered queries: each operator with production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, language_id, line_dedup, mixing, quality_classifier, quality_rules, secret_scan, simhash_dedup, substring_dedup, url_filter

#: Fixed rules of the URL contract: host, path, verdict.
URL_RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(_table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.fit(docs))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.filter_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rules = quality_rules.fit(docs, _table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(quality_rules.statistics(docs), rules)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["place"] < len(secret_scan.BASE))
    counts = [_count(r.kind).alias(f"n_{r.kind}") for r in secret_scan.BASE]
    return found.select("doc_id", *counts, F.sha2(secret_scan.digest(base), 256).alias("base_sha256"), secret_scan.digest(F.col("spans")).alias("spans"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality_classifier.classify(docs, quality_classifier.fit(docs, _table(spark, sf_dir, "labels")))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        f.__name__: f
        for f in (op1_line_dedup, op2_decontaminate, op3_substring_dedup, op4_language_id, op5_mixing, op6_url_filter, op7_quality_rules, op8_secret_scan, op9_quality_classifier, op10_simhash_dedup)
    }
