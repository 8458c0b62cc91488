"""Language identification by averaged hashed subword embeddings and a linear softmax.

A text is the average of the embeddings of its byte n-grams (hashed into ``BUCKETS`` rows), and a softmax
over ``average @ weights`` gives the languages.  Both factors are trained in numpy by stochastic gradient
descent on a bounded sample of labelled documents.  A temperature and a rejection threshold are fitted on
part of the sample that training does not see.  As the model is linear in the counts, prediction needs one
product of the two factors per model and one table look-up per n-gram.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1 << 13
ORDERS = (1, 2, 3, 4)
DIM = 16
SAMPLE = 2_000
EPOCHS = 12
RATE = 0.5
BATCH = 32
RECALL = 0.995
UNKNOWN = "und"
_PLAIN = re.compile(r"[A-Za-z]")
_MAYBE = re.compile(r"[^\W\d_]+")  # letters, and numbers such as superscripts
_SLICE = 1 << 20


def has_letter(text: str | None) -> bool:
    """Whether the text holds a character of Unicode's letter categories."""
    if not text:
        return False
    return _PLAIN.search(text) is not None or any(c.isalpha() for m in _MAYBE.finditer(text) for c in m[0])


def ngram_counts(text: str, buckets: int = BUCKETS, orders: tuple[int, ...] = ORDERS) -> np.ndarray:
    """How often each bucket's byte n-grams occur in the lower-cased text."""
    raw = np.frombuffer(f" {text} ".lower().encode("utf-8", "surrogatepass"), dtype=np.uint8)
    out = np.zeros(buckets, dtype=np.float32)
    for at in range(0, len(raw), _SLICE):
        b = raw[at : at + _SLICE + max(orders) - 1].astype(np.uint32)
        h = np.zeros(len(b), dtype=np.uint32)
        for n in range(1, max(orders) + 1):
            last = len(b) - n + 1
            if last <= 0:
                break
            h = h[:last] * np.uint32(0x01000193) ^ b[n - 1 :]
            if n in orders:
                x = h[: min(last, _SLICE)] * np.uint32(0x9E3779B1)
                out += np.bincount((x ^ (x >> np.uint32(15))) % np.uint32(buckets), minlength=buckets)
    return out


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # buckets x languages: embeddings @ weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def scores(self, text: str) -> np.ndarray:
        counts = ngram_counts(text, len(self.table))
        z = (counts @ self.table / max(1.0, float(counts.sum())) + self.bias) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, probability, and whether the probability reaches the calibrated threshold."""
        if not has_letter(text) or not self.langs:
            return UNKNOWN, 0.0, False
        p = self.scores(text)
        k = int(p.argmax())
        return self.langs[k], float(p[k]), bool(p[k] >= self.threshold)


def train(counts: np.ndarray, names: list[str], dim: int = DIM, epochs: int = EPOCHS, rate: float = RATE, seed: int = 7) -> LanguageModel:
    """Fit on rows of n-gram counts, which are overwritten; every fifth row calibrates instead of training."""
    langs = sorted(set(names))
    if not langs:
        return LanguageModel([], np.zeros((counts.shape[1] if counts.ndim == 2 else BUCKETS, 0), np.float32), np.zeros(0, np.float32), 1.0, 1.0)
    y = np.array([langs.index(n) for n in names])
    x = counts
    x /= np.maximum(1.0, x.sum(axis=1, keepdims=True))
    held = np.arange(len(x)) % 5 == 4
    if held.all() or not held.any():
        held = np.zeros(len(x), bool)
    rng = np.random.default_rng(seed)
    # Scaling by the inverse root of a bucket's mean frequency lets rare n-grams learn as fast as common ones.
    scale = (1.0 / np.sqrt(x.mean(axis=0) + 1e-6)).astype(np.float32)
    x *= scale
    e = rng.normal(0, 0.1, (x.shape[1], dim)).astype(np.float32)
    w, b = rng.normal(0, 0.1, (dim, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    rows = np.flatnonzero(~held)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        for part in np.array_split(rng.permutation(rows), max(1, len(rows) // BATCH)):
            hidden = x[part] @ e
            z = hidden @ w + b
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(part)), y[part]] -= 1
            p /= len(part)
            back = p @ w.T
            w -= step * (hidden.T @ p)
            b -= step * p.sum(axis=0)
            e -= step * (x[part].T @ back)
    check = held if held.any() else ~held
    z, truth = x[check] @ e @ w + b, y[check]
    temperature = min((float(t) for t in np.geomspace(0.05, 20, 60)), key=lambda t: _loss(z / t, truth))
    p = _softmax(z / temperature)
    right = np.sort(p[np.arange(len(truth)), truth][p.argmax(axis=1) == truth])
    threshold = float(right[int((1 - RECALL) * len(right))]) if len(right) else 1.0
    return LanguageModel(langs, ((e * scale[:, None]) @ w).astype(np.float32), b, temperature, threshold)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(-np.log(_softmax(z)[np.arange(len(y)), y] + 1e-12).mean())


def held_out(id_col: str = "doc_id") -> Column:
    """True where the CRC32 of the id's decimal text is 2 modulo 4; such documents are never learned from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _quotas(sizes: list[tuple[str, int]], sample: int) -> dict[str, int]:
    """How many documents of each language are learned from: half the sample in equal parts, half by size.

    Adds up to ``sample`` at most.  Languages beyond the ``sample // 4`` most frequent are not learned.
    """
    sizes = sizes[: max(1, sample // 4)]
    total = sum(n for _, n in sizes)
    return {lang: sample // 2 // len(sizes) + sample // 2 * n // total for lang, n in sizes}


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, buckets: int = BUCKETS) -> LanguageModel:
    """Train on at most ``sample`` documents that have a language, a letter and are not held out.

    Each language has its own quota, so a rare one is learned too; within a language a hash of the id
    chooses.  An id counts once, with the least of its rows' languages and texts.
    """
    known = docs.where(F.col(id_col).isNotNull() & F.col(lang_col).isNotNull() & ~held_out(id_col) & F.col(text_col).rlike(r"\p{L}"))
    rows = known.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    turn = F.xxhash64("doc_id")
    sizes = rows.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct("doc_id").alias("ids"))
    sizes = [(r["lang"], r["n"], r["ids"]) for r in sizes.orderBy(F.desc("n"), "lang").limit(max(1, sample // 4)).collect()]
    quotas = _quotas([(g, n) for g, n, _ in sizes], sample) if sizes else {}
    # Twice the quota's share of the hash space, and some more, holds the quota's smallest hashes but for astronomically rare luck.
    edge = [(g, int(min(1.0, (2 * quotas[g] + 50) / max(1, ids)) * (1 << 63)) * 2 - (1 << 63)) for g, _, ids in sizes]
    spark = docs.sparkSession
    edges = spark.createDataFrame([(g, min(e, (1 << 63) - 1), quotas[g]) for g, e in edge], "_lang string, _edge bigint, _quota int")
    near = rows.select("doc_id", "lang").join(F.broadcast(edges), F.col("lang") == F.col("_lang")).where(turn <= F.col("_edge")).groupBy("doc_id").agg(F.min(F.struct("lang", "_quota")).alias("x"))
    place = F.row_number().over(Window.partitionBy("x.lang").orderBy(turn, "doc_id"))
    few = near.withColumn("place", place).where("place <= x._quota").select(F.col("doc_id").alias("_pick"), F.col("x.lang").alias("_lang"))
    rows = rows.join(F.broadcast(few), (F.col("doc_id") == F.col("_pick")) & (F.col("lang") == F.col("_lang")))
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text")).select("doc_id", "text", "lang")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(i, ngram_counts(t, buckets), g) for i, t, g in zip(*(c.to_pylist() for c in batch.columns), strict=True) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([g for _, _, g in got], pa.string()), pa.array([i for i, _, _ in got], pa.int64()), pa.array([c.astype(np.uint32).tobytes() for _, c, _ in got], pa.binary())], ["lang", "doc_id", "counts"])

    got = rows.mapInArrow(count, "lang string, doc_id bigint, counts binary").collect()
    got.sort(key=lambda r: (hash_id(r["doc_id"]), r["doc_id"]))
    names, x = [r["lang"] for r in got], np.empty((len(got), buckets), dtype=np.float32)
    for k in reversed(range(len(got))):
        x[k] = np.frombuffer(got.pop()["counts"], np.uint32)
    return train(x, names)


def hash_id(x: int) -> int:
    return (x * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & 0xFFFFFFFFFFFFFFFF


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score, accepted``.

    ``und`` with score 0 marks a NULL text or one without a letter.  ``accepted`` is false below the
    calibrated threshold; callers that reject treat those as ``und`` too.  Of equal scores the first language
    by code point wins.  A text is read whole, in slices.  Repeated rows are judged each; a NULL id is not
    held out; an empty table gives no rows.  Other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS x languages floats

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sent.value.predict(t.as_py()) for t in batch.column(2)]
            lang, score, ok = zip(*got, strict=True) if got else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(ok, pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "accepted"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), held_out(id_col).alias("held_out"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean")
