"""Document quality by co-training two views.

One classifier sees the text's content (repetition, marks, letters), the other only what a crawler
knows of the record: language, source, length, stored and packed size, line layout. Both start from
labelled rows; in each round either one labels the unlabelled rows it is surest of for the other.
Each view is calibrated on labelled rows kept apart, and a last fit on these weighs the two
calibrated views. Every whole document is then scored with the combination.

Both classifiers are logistic regressions over binned features, so a feature may act in the middle
of its range only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from . import memos
from .linear import Rows, bounded_sample, fit_logistic, fit_scale, sigmoid

LABELED = 12_000     # labelled rows, a quarter of them for calibration
UNLABELED = 6_000    # rows that the views label for each other
ROUNDS = 4
SURE = 0.02          # share of the unlabelled rows that a view passes on per round and class
_BINS = 12
_CATEGORIES = 64
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*|~^=_<>{}[]\\@+")] = True


def content_features(text: str | None) -> list[float]:
    """The view of the text itself; an empty text gives zeros."""
    words = (text or "").split()
    if not words:
        return [0.0] * 11
    counts = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
    n, total = len(words), max(1, int(counts.sum()))
    letters = int(counts[65:91].sum() + counts[97:123].sum() + counts[128:].sum())
    return [
        len(set(words)) / n,
        sum(map(eq, words, words[1:])) / n,
        counts[_MARKS].sum() / total,
        counts[33] / n,
        counts[48:58].sum() / total,
        counts[65:91].sum() / max(1, letters),
        letters / total,
        (counts[44] + counts[46]) / n,
        sum(map(len, words)) / n,
        max(map(len, words)),
        len(set(words)) / n ** 0.8,
    ]


def record_features(text: str | None, lang: str | None, source: str | None,
                    n_chars: int | None) -> list[float]:
    """The view of the record: sizes and layout, then two category numbers."""
    raw = (text or "").encode()
    lines = raw.count(b"\n") + 1
    packed = len(zlib.compress(raw, 1)) if raw else 0
    return [
        float(np.log1p(max(0, n_chars or 0))), packed / max(1, len(raw)),
        len(raw) / max(1, len(text or "")), float(np.log1p(lines)),
        float(np.log1p(len(raw) / lines)),
        float(xxhash.xxh32_intdigest((lang or "").encode()) % _CATEGORIES),
        float(xxhash.xxh32_intdigest((source or "").encode()) % _CATEGORIES),
    ]


_RECORD_NUMBERS = 5  # the rest of the record view are categories


class View:
    """One classifier over binned features."""

    def __init__(self, values: np.ndarray, numbers: int):
        self.numbers = numbers
        levels = np.linspace(0, 1, _BINS + 1)[1:-1]
        self.cuts = [np.unique(np.quantile(values[:, k], levels)) if len(values) else np.empty(0)
                     for k in range(numbers)]
        sizes = [len(c) + 1 for c in self.cuts] + [_CATEGORIES] * (values.shape[1] - numbers)
        self.starts = np.cumsum([0, *sizes])
        self.weights, self.bias, self.slope, self.shift = np.zeros(self.starts[-1]), 0.0, 1.0, 0.0

    def at(self, values: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(self.cuts[k], values[:, k], "right") if k < self.numbers
                   else values[:, k].astype(np.int64) for k in range(values.shape[1])]
        return np.stack(columns, axis=1) + self.starts[:-1]

    def fit(self, at: np.ndarray, label: np.ndarray, weight: np.ndarray) -> None:
        self.weights, self.bias = fit_logistic(Rows(list(at), int(self.starts[-1])), label, weight,
                                               penalty=0.5, steps=200)

    def logit(self, at: np.ndarray) -> np.ndarray:
        return self.slope * (self.weights[at].sum(axis=1) + self.bias) + self.shift


class Model:
    """Two fitted views and their weights."""

    def __init__(self, views, weights, bias):
        self.views, self.weights, self.bias = views, weights, bias

    def score(self, content: np.ndarray, record: np.ndarray) -> np.ndarray:
        logits = [v.logit(v.at(x)) for v, x in zip(self.views, (content, record), strict=True)]
        return sigmoid(sum(w * x for w, x in zip(self.weights, logits, strict=True)) + self.bias)


def _combine(logits: np.ndarray, label: np.ndarray) -> tuple[np.ndarray, float]:
    """Non-negative weights of calibrated logits, by Newton steps from equal halves."""
    x = np.column_stack([logits, np.ones(len(logits))])
    theta = np.array([0.5, 0.5, 0.0])
    for _ in range(30):
        p = sigmoid(x @ theta)
        grad = x.T @ (p - label) + 1.0 * (theta - [0.5, 0.5, 0.0])
        hess = (x * (p * (1 - p))[:, None]).T @ x + 1.0 * np.eye(3)
        theta = theta - np.clip(np.linalg.solve(hess, grad), -1, 1)
        theta[:2] = np.maximum(theta[:2], 0)
    return theta[:2], float(theta[2])


def co_train(content, record, label, spare_content, spare_record) -> Model:
    """Fit both views; ``label`` is 1 for good. The spare rows are unlabelled."""
    views = [View(np.concatenate([content, spare_content]), content.shape[1]),
             View(np.concatenate([record, spare_record]), _RECORD_NUMBERS)]
    held = np.arange(len(label)) % 4 == 3
    at = [v.at(x) for v, x in zip(views, (content, record), strict=True)]
    spare = [v.at(x) for v, x in zip(views, (spare_content, spare_record), strict=True)]
    # Pseudo-labels that each view was given, by spare row.
    given = [dict(), dict()]
    for round_no in range(ROUNDS + 1):
        for k, view in enumerate(views):
            extra = np.fromiter(given[k], np.int64, len(given[k]))
            view.slope, view.shift = 1.0, 0.0
            view.fit(np.concatenate([at[k][~held], spare[k][extra]]),
                     np.concatenate([label[~held], np.array([given[k][i] for i in extra])]),
                     np.concatenate([np.ones((~held).sum()), np.full(len(extra), 0.5)]))
            view.slope, view.shift = fit_scale(view.logit(at[k][held]), label[held])
        if round_no == ROUNDS or not len(spare_content):
            break
        for k, view in enumerate(views):
            p = sigmoid(view.logit(spare[k]))
            order = np.argsort(p, kind="stable")
            few = max(1, int(SURE * len(order)))
            for i in order[:few]:
                if p[i] < 0.1:
                    given[1 - k].setdefault(int(i), 0.0)
            for i in order[::-1][:few]:
                if p[i] > 0.9:
                    given[1 - k].setdefault(int(i), 1.0)
    logits = np.stack([v.logit(a[held]) for v, a in zip(views, at, strict=True)], axis=1)
    return Model(views, *_combine(logits, label[held]))


def _features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Both views of rows (text, lang, source, n_chars)."""
    memos.claim("quality")
    texts, *rest = (c.to_pylist() for c in batch.columns[:4])
    content = np.array([content_features(t) for t in texts]).reshape(-1, 11)
    record = np.array([record_features(*r) for r in zip(texts, *rest, strict=True)]).reshape(-1, 7)
    return content, record


_VIEW = ["text", "lang", "source", "n_chars"]


def _viewed(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features and labels of a bounded sample, computed in the tasks."""
    def view(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, record = _features(batch)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(content)), pa.array(list(record)), batch.column(4)],
                ["content", "record", "label"])
    out = rows.mapInArrow(view, "content array<double>, record array<double>, label double"
                          ).toArrow()
    content, record = (np.array(out[k].to_pylist(), dtype=float) for k in ("content", "record"))
    return (content.reshape(-1, 11), record.reshape(-1, 7), np.array(out["label"].to_pylist(),
                                                                     dtype=float))


def fit(docs: DataFrame, labels: DataFrame, labeled: int = LABELED,
        unlabeled: int = UNLABELED) -> Model | None:
    """A model from ``labels`` (doc_id, quality 0 or 1; other values are ignored), or None when they
    do not hold both classes. ``docs`` has doc_id, text, lang, source, n_chars; any may be null."""
    docs = docs.select("doc_id", "text", "lang", "source", F.col("n_chars").cast("long"))
    known = labels.where(F.col("quality").isin(0, 1)).groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("label"))
    chosen = bounded_sample(known, labeled, F.col("doc_id"))
    content, record, label = _viewed(docs.join(F.broadcast(chosen), "doc_id").select(*_VIEW, "label"))
    if min(np.sum(label == 0), np.sum(label == 1)) < 8:
        return None
    spare_ids = bounded_sample(
        docs.select("doc_id").join(known, "doc_id", "left_anti"), unlabeled, F.col("doc_id"))
    spare = _viewed(docs.join(F.broadcast(spare_ids.distinct()), "doc_id").select(
        *_VIEW, F.lit(0.0).alias("label")))
    return co_train(content, record, label, spare[0], spare[1])


def score(docs: DataFrame, model: Model | None, to: str = "score") -> DataFrame:
    """Add (or replace) ``to``: probability that a document is good; 1 for all without a model."""
    if model is None:
        return docs.withColumn(to, F.lit(1.0))
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def scored(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for columns in batches:
            content, record = _features(pa.RecordBatch.from_arrays(list(columns), _VIEW))
            yield pa.array(shipped.value.score(content, record), pa.float64())
    return docs.withColumn(to, scored("text", "lang", "source", F.col("n_chars").cast("long")))
