"""Quality classifier by co-training two views.

The content view sees what the text looks like (character classes, word and line statistics); the metadata
view sees only the page's record (source, language, length).  Both start from a bounded sample of labelled
documents.  In each round either view labels the documents of a bounded unlabelled pool it is most sure of,
and those pseudo-labels train the *other* view.  Each view is then calibrated on labelled documents that
neither trained on, and the calibrated log-odds add up (less the prior, which both contain) to one score.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import word_bounds, word_hashes

SAMPLE = 4_000
POOL = 4_000
ROUNDS = 5
PER_ROUND = 200
SURE = 0.97
THRESHOLD = 0.5
BINS = 8
_SOURCES, _LANGS = 256, 64  # hash slots
_CLASS = np.zeros(256, dtype=np.uint8)
for _k, _set in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\n", b".,;:'\"-()", b"!?", b"|", b"#*$%&<>=+~^_@/\\{}[]`"), 1):
    _CLASS[list(_set)] = _k


def content_view(text: str | None) -> np.ndarray:
    """Shares of character classes, then word, repetition and line statistics."""
    raw = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), dtype=np.uint8)
    shares = np.bincount(_CLASS[raw], minlength=10)[:10] / max(1, len(raw))
    starts, ends = word_bounds(raw)
    n = len(starts)
    if not n:
        return np.concatenate((shares, np.zeros(9)))
    h, size = word_hashes(raw, starts, ends), ends - starts
    lines = 1 + int((raw == 10).sum())
    last = _CLASS[raw[ends - 1]]
    more = (
        np.log1p(n), size.mean(), size.std(), len(np.unique(h)) / n, float((h[1:] == h[:-1]).sum()) / n,
        np.log1p(n / lines), float((last == 9).sum()) / n, float((last == 7).sum()) / n, float((size == 1).sum()) / n,
    )
    return np.concatenate((shares, more))


def metadata_view(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    """Hashed source and language, and the recorded length."""
    out = np.zeros(_SOURCES + _LANGS + 2)
    out[zlib.crc32(f"s{source}".encode("utf-8", "surrogatepass")) % _SOURCES] = 1
    out[_SOURCES + zlib.crc32(f"l{lang}".encode("utf-8", "surrogatepass")) % _LANGS] = 1
    out[-2:] = np.log1p(max(0, n_chars or 0)), n_chars is None
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logistic(a: np.ndarray, t: np.ndarray, ridge: float | np.ndarray) -> np.ndarray:
    """Penalised logistic regression by Newton steps, halved while they do not lower the loss."""
    w, ridge = np.zeros(a.shape[1]), ridge * np.ones(a.shape[1])

    def loss(w: np.ndarray) -> float:
        z = a @ w
        return float((np.logaddexp(0, z) - t * z).sum() + (ridge * w * w).sum() / 2)

    now = loss(w)
    for _ in range(50):
        p = _sigmoid(a @ w)
        step = np.linalg.solve((a * (p * (1 - p) + 1e-6)[:, None]).T @ a + np.diag(ridge), a.T @ (t - p) - ridge * w)
        while (new := loss(w + step)) > now and np.abs(step).max() > 1e-9:
            step /= 2
        w, now, done = w + step, new, now - new < 1e-9 * (1 + now)
        if done:
            break
    return w


@dataclass
class View:
    """Logistic regression over the features and their quantile bins."""

    mean: np.ndarray
    spread: np.ndarray
    graded: np.ndarray  # features with more than two values, which are binned
    cuts: np.ndarray  # graded features x BINS - 1
    weights: np.ndarray
    slope: float = 1.0
    shift: float = 0.0

    @staticmethod
    def shaped(x: np.ndarray) -> View:
        graded = np.array([k for k in range(x.shape[1]) if len(np.unique(x[:, k])) > 2], dtype=np.int64)
        cuts = np.quantile(x[:, graded], np.linspace(0, 1, BINS + 1)[1:-1], axis=0).T
        return View(x.mean(axis=0), x.std(axis=0) + 1e-9, graded, cuts, np.zeros(0))

    def expand(self, x: np.ndarray) -> np.ndarray:
        steps = (x[:, self.graded, None] > self.cuts[None]).reshape(len(x), -1)
        return np.concatenate((np.clip((x - self.mean) / self.spread, -8, 8), steps, np.ones((len(x), 1))), axis=1)

    def fit(self, x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> None:
        self.weights = _logistic(self.expand(x), y, ridge)

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.expand(x) @ self.weights

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Platt scaling with smoothed targets; the penalty keeps a view that knows nothing near the prior."""
        z, good = np.clip(self.raw(x), -30, 30), y.sum()
        t = np.where(y > 0, (good + 1) / (good + 2), 1 / (len(y) - good + 2))
        slope, shift = _logistic(np.stack((z, np.ones(len(z))), axis=1), t, np.array([1.0, 1e-3]))
        self.slope, self.shift = float(max(slope, 0.0)), float(shift)
        if slope < 0:  # the view orders documents the wrong way round: the prior alone
            self.shift = float(np.log(t.mean() / (1 - t.mean())))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.slope * np.clip(self.raw(x), -30, 30) + self.shift


@dataclass
class QualityModel:
    content: View | None
    metadata: View | None
    prior: float
    threshold: float = THRESHOLD

    def score(self, content: np.ndarray, metadata: np.ndarray) -> np.ndarray:
        """The probability that a document is good; 1 if there was nothing to learn from."""
        if self.content is None or self.metadata is None:
            return np.ones(len(content))
        z = self.content.logit(content) + self.metadata.logit(metadata) - self.prior
        return _sigmoid(z)


def co_train(content: np.ndarray, metadata: np.ndarray, y: np.ndarray, pool_content: np.ndarray, pool_metadata: np.ndarray, rounds: int = ROUNDS, per_round: int = PER_ROUND, sure: float = SURE) -> QualityModel:
    """Fit both views; every fourth labelled row calibrates.  One kind of label alone gives a model that keeps all."""
    if len(y) < 20 or y.min() == y.max():
        return QualityModel(None, None, 0.0)
    held = np.arange(len(y)) % 4 == 3
    views, sets = (View.shaped(content), View.shaped(metadata)), [[content[~held], y[~held]], [metadata[~held], y[~held]]]
    pools, free = (pool_content, pool_metadata), np.ones(len(pool_content), dtype=bool)
    for k in range(rounds + 1):
        for v, (x, t) in zip(views, sets, strict=True):
            v.fit(x, t)
        for v, x in zip(views, (content, metadata), strict=True):
            v.calibrate(x[held], y[held])
        if k == rounds:
            break
        for me, other in ((0, 1), (1, 0)):
            rows = np.flatnonzero(free)
            if not len(rows):
                continue
            p = _sigmoid(views[me].logit(pools[me][rows]))
            order = np.argsort(-np.abs(p - 0.5), kind="stable")
            picked = [i for i in order if max(p[i], 1 - p[i]) >= sure][:per_round]
            if picked:
                free[rows[picked]] = False
                sets[other] = [np.concatenate((sets[other][0], pools[other][rows[picked]])), np.concatenate((sets[other][1], (p[picked] > 0.5).astype(float)))]
    rate = float(np.clip(y.mean(), 1e-6, 1 - 1e-6))
    return QualityModel(*views, float(np.log(rate / (1 - rate))))


_INPUT = ("doc_id", "text", "source", "lang", "n_chars")


def _view_columns(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """The five columns the views read; metadata that ``docs`` lacks is NULL."""
    extra = {"source": "string", "lang": "string", "n_chars": "bigint"}
    columns = [F.col(id_col).cast("bigint"), F.col(text_col), *((F.col(c) if c in docs.columns else F.lit(None)).cast(k) for c, k in extra.items())]
    return [x.alias(c) for c, x in zip(_INPUT, columns, strict=True)]


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_view_columns(docs, id_col, text_col))


def _views(batch: pa.RecordBatch, at: int = 0) -> tuple[np.ndarray, np.ndarray]:
    text, rest = batch.column(at + 1), [batch.column(at + k).to_pylist() for k in (2, 3, 4)]
    content = [content_view(t.as_py()) for t in text]
    return np.array(content).reshape(len(content), -1), np.array([metadata_view(*m) for m in zip(*rest, strict=True)]).reshape(len(content), -1)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, pool: int = POOL) -> QualityModel:
    """Learn from at most ``sample`` labelled and ``pool`` unlabelled documents, each chosen by a hash of the id.

    NULL labels and ids are left out; of contradicting labels the lowest counts, and of several rows with one
    id the one with the least views, so what is collected is bounded by the two parameters.
    """
    known = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("bigint").alias("_pick")).agg(F.min(F.col(label_col).cast("double")).alias("_y"))
    few = known.orderBy(F.xxhash64("_pick"), "_pick").limit(sample)
    rest = docs.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("_pick")).distinct().join(known.select("_pick"), "_pick", "left_anti")
    rest = rest.orderBy(F.xxhash64("_pick"), "_pick").limit(pool).withColumn("_y", F.lit(None).cast("double"))
    rows = _rows(docs, id_col, text_col)
    rows = rows.join(F.broadcast(few.union(rest)), F.col("doc_id") == F.col("_pick")).select("_y", *_INPUT)

    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, metadata = _views(batch, 1)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(list(content), pa.list_(pa.float64())), pa.array(list(metadata), pa.list_(pa.float64()))], ["y", "doc_id", "content", "metadata"])

    seen = rows.mapInArrow(view, "y double, doc_id bigint, content array<double>, metadata array<double>")
    got = seen.groupBy("doc_id").agg(F.min(F.struct("content", "metadata", "y")).alias("x")).select("doc_id", "x.*").collect()
    got.sort(key=lambda r: (zlib.crc32(str(r["doc_id"]).encode()), r["doc_id"]))
    marked, free = [r for r in got if r["y"] is not None], [r for r in got if r["y"] is None]
    wide = (len(content_view("")), len(metadata_view(None, None, None)))
    def matrix(rows, name, n):
        return np.array([r[name] for r in rows], dtype=float).reshape(len(rows), n)
    return co_train(*(matrix(marked, c, n) for c, n in zip(("content", "metadata"), wide, strict=True)), np.array([r["y"] for r in marked], dtype=float), *(matrix(free, c, n) for c, n in zip(("content", "metadata"), wide, strict=True)))


def classify(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, score, kept``; score is the probability of good quality.

    NULL and empty texts are scored as texts without words; missing or NULL metadata counts as unknown.
    A score equal to the threshold keeps.  Repeated rows are scored each; an empty table gives no rows.  Columns other than text, source, lang and n_chars are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = model.score(*_views(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64()), pa.array(p >= model.threshold)], ["doc_id", "score", "kept"])

    return _rows(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double, kept boolean")


def keep_good(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier keeps."""
    packed = docs.select(*(F.col(c).alias(f"_{k}") for k, c in enumerate(docs.columns)), *_view_columns(docs, id_col, text_col))
    wide = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = model.score(*_views(batch, wide)) >= model.threshold
            yield batch.filter(pa.array(kept)).select(list(range(wide)))

    schema = packed.select(*(f"_{k}" for k in range(wide))).schema
    return packed.mapInArrow(run, schema).toDF(*docs.columns)
