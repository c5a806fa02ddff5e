"""Quality by ordinal cumulative-link regression.

Ratings are grades in order (any number of them). One weight vector over hashed text features is
shared by all grades, and ordered thresholds cut its score: P(grade > k) = sigmoid(score - t_k).
That gives an expected grade, and the probability of a grade or better, by which documents are
selected.

Features: the frequencies of hashed byte trigrams of the text, and of hashed marks of how words
follow one another (the same word again, a word seen before, a first one). All of a text counts.

The model is fitted on at most ``sample`` labelled rows, chosen by a hash of the id; scoring is one
pass without a shuffle.

Defined results: null and empty texts have no features and get the score of the empty text, which
``select`` rejects; labels that are null, or of documents that are not there, are left out; of
several labels of a document the lowest counts; with no labels, or one grade only, every document
has probability 1 (nothing is known against it), empty ones 0; other columns are kept by ``select``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from granary.llm.util import free_name, tune

DIM = 4096
MARKS = 16
SAMPLE = 6000
CUTOFF = 0.5


def feature_ids(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each byte trigram, and mark of each word."""
    b = np.frombuffer(raw, dtype=np.uint8).astype(np.uint32)
    if len(b) < 3:
        b = np.concatenate([b, np.full(3 - len(b), 32, np.uint32)])
    grams = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA6B) + b[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(20)
    words = raw.split()
    codes = np.fromiter(map(zlib.crc32, words), dtype=np.int64, count=len(words))
    marks = np.zeros(len(words), dtype=np.int64)
    if len(words):
        _, first = np.unique(codes, return_index=True)
        marks += 1
        marks[first] = 0
        marks[1:] += 2 * (codes[1:] == codes[:-1])
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        marks += 4 * np.minimum(lengths // 8, 3)
    return grams.astype(np.int64), marks


def vector(text: str | None) -> np.ndarray:
    """Features of one text, in [0, 1]."""
    raw = (text or "").encode("utf-8", "replace")
    if not raw.strip():
        return np.zeros(DIM + MARKS, dtype=np.float32)
    grams, marks = feature_ids(raw)
    out = np.zeros(DIM + MARKS, dtype=np.float32)
    out[:DIM] = np.sqrt(np.bincount(grams, minlength=DIM) / len(grams))
    out[DIM:] = np.bincount(marks, minlength=MARKS) / max(len(marks), 1)
    return out


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


class Ordinal:
    """Cumulative-link regression with a logit link, fitted by Adam on all rows at once."""

    def __init__(self, grades: list, weights: np.ndarray, thresholds: np.ndarray):
        self.grades, self.weights, self.thresholds = grades, weights, thresholds

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, grades: list, l2: float = 1e-4, steps: int = 400, rate: float = 0.05) -> Ordinal:
        k = len(grades) - 1
        w = np.zeros(x.shape[1])
        # Thresholds are a first one and positive gaps, so they stay in order.
        above = np.array([(y > j).mean() for j in range(k)])
        start = -np.log(np.clip(above, 1e-3, 1 - 1e-3) / np.clip(1 - above, 1e-3, 1))
        theta = np.concatenate([start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
        m, v = np.zeros(len(w) + k), np.zeros(len(w) + k)
        for step in range(1, steps + 1):
            t = np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))])
            eta = (x @ w.astype(x.dtype)).astype(np.float64)  # no copy of x in another type
            up = _sigmoid(eta[:, None] - t[None, :])  # P(grade > j)
            full = np.concatenate([np.ones((len(y), 1)), up, np.zeros((len(y), 1))], axis=1)
            p = np.maximum(full[np.arange(len(y)), y] - full[np.arange(len(y)), y + 1], 1e-9)
            d = np.concatenate([np.zeros((len(y), 1)), up * (1 - up), np.zeros((len(y), 1))], axis=1)
            lower, upper = d[np.arange(len(y)), y], d[np.arange(len(y)), y + 1]
            g_eta = -(lower - upper) / p / len(y)
            g_t = np.zeros(k)
            for j in range(k):
                g_t[j] = (np.where(y == j + 1, lower, 0) / p).sum() / len(y) - (np.where(y == j, upper, 0) / p).sum() / len(y)
            g_theta = np.concatenate([[g_t.sum()], np.array([g_t[j:].sum() * np.exp(theta[j]) for j in range(1, k)])])
            g = np.concatenate([(g_eta.astype(x.dtype) @ x).astype(np.float64) + l2 * w, g_theta])
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, theta = w - move[: len(w)], theta - move[len(w) :]
        return cls(grades, w, np.concatenate([theta[:1], theta[0] + np.cumsum(np.exp(theta[1:]))]))

    def above(self, x: np.ndarray) -> np.ndarray:
        """P(grade > k) for each threshold."""
        return _sigmoid((x @ self.weights)[:, None] - self.thresholds[None, :])


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", rating: str = "quality", sample: int = SAMPLE) -> Ordinal | None:
    """The model of at most about ``sample`` labelled rows; none with fewer than two grades."""
    tune(docs.sparkSession, 256)
    rated = labels.where(labels[doc_id].isNotNull() & labels[rating].isNotNull()).groupBy(labels[doc_id].alias("_id")).agg(F.min(labels[rating]).alias("_y"))
    n = rated.count()
    if not n:
        return None
    chosen = rated.where(F.pmod(F.xxhash64("_id", F.lit(4)), F.lit(1_000_000)) < min(1.0, sample / n) * 1_000_000)
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).join(chosen, "_id").select("_y", "_text").repartition(12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([vector(t.as_py()).astype(np.float16).tobytes() for t in b.column(1)], pa.binary())], names=["y", "v"])

    y_type = dict(rows.dtypes)["_y"]
    raw, grades_of = [], []
    for r in rows.mapInArrow(run, f"y {y_type}, v binary").toArrow().to_batches():  # ``sample`` rows of 8 KB
        grades_of += r.column(0).to_pylist()
        raw += r.column(1).to_pylist()
    grades = sorted(set(grades_of))
    if len(grades) < 2:
        return None
    order = sorted(range(len(raw)), key=lambda k: (grades_of[k], zlib.crc32(raw[k])))  # tasks end in any order
    x = np.empty((len(raw), DIM + MARKS), dtype=np.float32)
    for k, at in enumerate(order):
        x[k] = np.frombuffer(raw[at], dtype=np.float16)
        raw[at] = b""
    return Ordinal.fit(x, np.searchsorted(np.array(grades), np.array(grades_of)[order]), grades)


def score(docs: DataFrame, model: Ordinal | None, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, expected_grade and tail (the probability of the best half of the grades); with
    ``keep``, all columns of ``docs`` and those two under its names."""
    spark = tune(docs.sparkSession, 256)
    held = spark.sparkContext.broadcast(model)
    fields = list(docs.schema.fields) if keep else [StructField("doc_id", docs.schema[doc_id].dataType)]
    schema = StructType([*fields, *(StructField(n, DoubleType()) for n in keep or ("expected_grade", "tail"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for b in batches:
            x = np.array([vector(t.as_py()) for t in b.column(0)]).reshape(b.num_rows, -1)
            empty = ~x.any(axis=1) if b.num_rows else np.zeros(0, bool)
            if m is None:
                expected, tail = np.where(empty, 0.0, 1.0), np.where(empty, 0.0, 1.0)
            else:
                up = m.above(x)
                steps = np.diff(np.array(m.grades, dtype=float))
                expected, tail = m.grades[0] + up @ steps, np.where(empty, 0.0, up[:, len(m.grades) // 2 - 1])
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(1, b.num_columns)), pa.array(expected), pa.array(tail)], names=schema.names)

    own = [docs[c] for c in docs.columns] if keep else [docs[doc_id].alias("doc_id")]
    return docs.select(docs[text].alias(free_name(docs, "scored")), *own).mapInArrow(run, schema)


def select(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF, **kw) -> DataFrame:
    """The documents whose probability of a good grade is at least ``cutoff``, with their columns."""
    model = fit(docs, labels, **kw)
    names = {k: kw[k] for k in ("doc_id", "text") if k in kw}
    extra = (free_name(docs, "expected"), free_name(docs, "tail"))
    return score(docs, model, keep=extra, **names).where(F.col(extra[1]) >= cutoff).drop(*extra)
