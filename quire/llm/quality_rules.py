"""Quality rules as a learned decision list.  JVM expressions only over the corpus.

Statistics of a bounded sample of labelled documents come to the driver, where sequential covering grows a
conjunction of thresholds (by information gain on two thirds of the sample), prunes it on the other third,
keeps it if it is precise enough there, removes what it covers and goes on.  The list is emitted as one
ordered conditional expression: the first rule that fits rejects, and the default keeps.
"""

from __future__ import annotations

import bisect
import math
import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._native import total, words
from ._text import BLANK, WORD

SAMPLE = 20_000
PRECISION = 0.9
SUPPORT = 5
CUTS = 24
MAX_CONDITIONS = 3
MAX_RULES = 12

#: name -> expression over the statistics; the learner sees these ratios.
FEATURES = {
    "words": "cast(n_words as double)",
    "symbols_per_word": "n_symbols / greatest(n_words, 1)",
    "marks_per_word": "n_marks / greatest(n_words, 1)",
    "capitals_per_char": "n_capitals / greatest(word_chars, 1)",
    "chars_per_word": "word_chars / greatest(n_words, 1)",
    "repeated_share": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines": "cast(n_dup_lines as double)",
}


def _repeated(ws: Column, width: int = 3) -> Column:
    """How many words lie in windows of ``width`` words that occur twice or more in the array.

    Windows are pairs of a 64-bit hash and a place, sorted whole: equal windows are neighbours.
    """
    n = F.size(ws)
    window = lambda h, i: F.struct(F.xxhash64(*(F.get(h, i + k) for k in range(width))).alias("h"), i.alias("at"))
    pairs = _bound(F.transform(ws, lambda w: F.xxhash64(w)), lambda h: F.transform(F.sequence(F.lit(0), n - width), lambda i: window(h, i)))

    def again(p: Column, j: Column, ranked: Column) -> Column:
        return F.coalesce(F.get(ranked, j - 1)["h"] == p["h"], F.lit(False)) | F.coalesce(F.get(ranked, j + 1)["h"] == p["h"], F.lit(False))

    hits = _bound(F.sort_array(pairs), lambda ranked: F.sort_array(F.transform(F.filter(ranked, lambda p, j: again(p, j, ranked)), lambda p: p["at"])))
    # Sorted places of repeated windows: each covers its words less those its predecessor covered.
    fresh = _bound(hits, lambda at: F.transform(at, lambda p, j: F.least(F.lit(width), p - F.coalesce(F.get(at, j - 1), F.lit(-width)))))
    return F.when(n >= width, total(fresh)).otherwise(F.lit(0))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_marks, n_capitals``.

    A NULL or blank text has zeros throughout; a NULL id stays NULL.  Repeated rows are counted each, an empty
    table gives none.  A text is held whole, whatever its length, and sorted in O(n log n).  Columns named in
    ``carry`` come along in the struct ``carried``, where their names can't clash; others are ignored.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    blanks = F.regexp_count(text, F.lit(BLANK))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    more = [F.struct(*carry).alias("carried")] if carry else []
    base = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), words(text).alias("_w"),
        (F.char_length(text) - blanks).cast("bigint").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.regexp_count(text, F.lit(r"[!?=~^_@]")).cast("bigint").alias("n_marks"),
        F.regexp_count(text, F.lit(r"\p{Lu}")).cast("bigint").alias("n_capitals"),
        _bound(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"), *more,
    )
    kept = ["carried"] if carry else []
    return base.select("doc_id", F.size("_w").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", _repeated(F.col("_w")).cast("bigint").alias("n_repeat_words"), "n_marks", "n_capitals", *kept)


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    cut: float

    def holds(self, row: dict[str, float]) -> bool:
        return row[self.feature] >= self.cut if self.above else row[self.feature] < self.cut

    def column(self) -> Column:
        x = F.expr(FEATURES[self.feature])
        return x >= self.cut if self.above else x < self.cut

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.above else '<'} {self.cut:.4g}"


@dataclass(frozen=True)
class Rule:
    conditions: tuple[Condition, ...]
    precision: float
    support: int

    def holds(self, row: dict[str, float]) -> bool:
        return all(c.holds(row) for c in self.conditions)

    def column(self) -> Column:
        out = self.conditions[0].column()
        for c in self.conditions[1:]:
            out = out & c.column()
        return out

    def __str__(self) -> str:
        return " and ".join(map(str, self.conditions))


def _counts(rows: list[tuple[dict, bool]]) -> tuple[int, int]:
    bad = sum(b for _, b in rows)
    return bad, len(rows) - bad


def _grow(rows: list[tuple[dict, bool]]) -> list[Condition]:
    chosen: list[Condition] = []
    for _ in range(MAX_CONDITIONS):
        p, n = _counts(rows)
        if not p or not n:
            break
        base, best, gain = math.log2(p / (p + n)), None, 1e-9
        for name in FEATURES:
            ranked = sorted((r[name], b) for r, b in rows)
            values, bad = [v for v, _ in ranked], [0]
            for _, b in ranked:
                bad.append(bad[-1] + b)
            for cut in {values[len(values) * k // CUTS] for k in range(1, CUTS)} | {v for v, b in ranked if b and len(ranked) < 200}:
                k = bisect.bisect_left(values, cut)
                for above, got, size in ((True, p - bad[k], len(rows) - k), (False, bad[k], k)):
                    if got and (g := got * (math.log2(got / size) - base)) > gain:
                        best, gain = Condition(name, above, cut), g
        if best is None:
            break
        chosen = [c for c in chosen if (c.feature, c.above) != (best.feature, best.above)] + [best]  # the new cut is the tighter
        rows = [x for x in rows if best.holds(x[0])]
    return chosen


def _worth(conditions: list[Condition], rows: list[tuple[dict, bool]]) -> tuple[float, int, int]:
    p, n = _counts([x for x in rows if all(c.holds(x[0]) for c in conditions)])
    return (p - n) / (p + n) if p + n else -1.0, p, n


def learn(rows: list[tuple[dict[str, float], bool]], precision: float = PRECISION, support: int = SUPPORT) -> list[Rule]:
    """An ordered list of rejecting rules from ``(features, is_bad)``; empty if nothing is precise enough."""
    rules: list[Rule] = []
    left = [(r, b, zlib.crc32(repr(sorted(r.items())).encode()) % 3) for r, b in rows]
    while len(rules) < MAX_RULES:
        grow, prune = [(r, b) for r, b, k in left if k], [(r, b) for r, b, k in left if not k]
        conditions = _grow(grow)
        while len(conditions) > 1 and _worth(conditions[:-1], prune)[0] >= _worth(conditions, prune)[0]:
            conditions = conditions[:-1]
        if not conditions:
            break
        _, p, n = _worth(conditions, prune)
        _, p2, n2 = _worth(conditions, grow)
        if p + p2 < support or p < precision * (p + n) or p2 < precision * (p2 + n2) or not p + n:
            break
        rule = Rule(tuple(conditions), (p + p2) / (p + p2 + n + n2), p + p2 + n + n2)
        rules.append(rule)
        left = [x for x in left if not rule.holds(x[0])]
    return rules


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    """Learn from at most ``sample`` labelled documents, chosen by a hash of their ids.

    NULL labels and ids are left out.  An id counts once: contradicting labels as bad, and of several texts
    the one with the smallest statistics.  Without labels of both kinds the list is empty and everything is kept.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_id")).agg((F.min(label_col) == 0).alias("_bad"))
    few = known.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    joined = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(few), F.col("doc_id") == F.col("_id"))
    facts = statistics(joined, carry=("_bad",))
    once = facts.where("n_words > 0").groupBy("doc_id").agg(F.min(F.struct("n_words", "word_chars", "n_symbols", "n_marks", "n_capitals", "n_dup_lines", "n_repeat_words", "carried")).alias("x")).select("x.*")
    got = once.select(F.col("carried._bad").alias("bad"), *(F.expr(e).cast("double").alias(n) for n, e in FEATURES.items())).collect()
    return learn([({n: float(r[n]) for n in FEATURES}, bool(r["bad"])) for r in got])


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``base_failed``, ``kept`` and ``rule`` (what rejected the document, NULL if kept) to statistics."""
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    verdict = F.when(F.col("base_failed"), F.lit("base"))
    for r in rules:
        verdict = verdict.when(r.column(), F.lit(str(r)))
    return stats.withColumn("base_failed", failed).withColumn("rule", verdict).withColumn("kept", F.col("rule").isNull())
