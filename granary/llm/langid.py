"""Language identification by hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. An n-gram of letters is bound into one vector:
each letter's vector is permuted by its place and all are multiplied. A document bundles (adds) the
vectors of its n-grams; a language's prototype bundles its training documents, each at unit length.
A document gets the language whose prototype is nearest by cosine, both less the mean prototype,
which holds what all languages share.

Prototypes of the ``LANGUAGES`` most frequent languages are learned from at most ``per_lang`` documents
each, chosen by a hash of the id;
the whole table is then predicted in one pass without a shuffle.

Defined results: ``und`` and score 0 if the text is null or has no letter, or where nothing could be
learned; texts shorter than an n-gram are padded by word ends; training rows with a null or empty
language are left out; repeated rows are predicted one by one; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.llm.util import tune

DIM = 1024
N = 3
PER_LANG = 4000
#: Languages that are learned, the most frequent ones: a prototype is 8 KB on the driver and in each task. It bounds a column
#: that is no language, not the languages there are.
LANGUAGES = 10_000
SHARPNESS = 12.0
#: n-grams whose vectors a worker remembers (4 KB each).
REMEMBERED = 30_000
UNKNOWN = "und"


def fold_of(key: Column, folds: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def gram_codes(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct letter n-grams of a text, 21 bits a letter, and their counts. Runs of anything
    else are one word end (0)."""
    raw = np.frombuffer((text or "").lower().encode("utf-32-le", "replace"), dtype=np.uint32).astype(np.int64)
    is_letter = _letters()[raw]
    if not is_letter.any():
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = np.concatenate([[0], np.where(is_letter, raw, 0), [0]])
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]
    code = np.zeros(len(x) - N + 1, dtype=np.int64)
    for i in range(N):
        code = code << 21 | x[i : len(x) - N + 1 + i]
    return np.unique(code, return_counts=True)


class Space:
    """The vectors of letters and n-grams, made from the letters' numbers alone."""

    def __init__(self, dim: int = DIM):
        self.dim, self.letters, self.index = dim, {}, {}
        self.grams = np.zeros((1024, dim), dtype=np.float32)

    def letter(self, c: int) -> np.ndarray:
        v = self.letters.get(c)
        if v is None:
            v = self.letters[c] = np.random.default_rng([c, 1]).integers(0, 2, self.dim).astype(np.float32) * 2 - 1
        return v

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Where the n-grams' vectors stand in ``grams``."""
        if len(self.index) + len(codes) > REMEMBERED:
            self.index.clear()
        out = np.empty(len(codes), dtype=np.int64)
        for k, code in enumerate(codes.tolist()):
            at = self.index.get(code)
            if at is None:
                at = self.index[code] = len(self.index)
                if at >= len(self.grams):
                    self.grams = np.concatenate([self.grams, np.zeros_like(self.grams)])
                v = np.ones(self.dim, dtype=np.float32)
                for i in range(N):
                    v = v * np.roll(self.letter(code >> 21 * (N - 1 - i) & 0x1FFFFF), N - 1 - i)
                self.grams[at] = v
            out[k] = at
        return out

    def bundle(self, texts: list) -> np.ndarray:
        """One unit vector for each text; zeros where there is no letter."""
        found = [gram_codes(t) for t in texts]
        codes = np.unique(np.concatenate([c for c, _ in found])) if found else np.zeros(0, np.int64)
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for lo in range(0, len(codes), 8192):
            part = codes[lo : lo + 8192]
            counts = np.zeros((len(texts), len(part)), dtype=np.float32)
            for k, (c, n) in enumerate(found):
                at = np.searchsorted(part, c)
                ok = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == c)
                counts[k, at[ok]] = n[ok]
            at = self.rows(part)
            out += counts @ self.grams[at]
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm > 0, norm, 1)


def learn(docs: DataFrame, doc_id: str, text: str, lang: str, train: Column, per_lang: int = PER_LANG) -> dict[str, np.ndarray]:
    """The prototype of each language: the mean of its training documents' vectors."""
    tune(docs.sparkSession, 64)
    usable = docs.where(train & docs[lang].isNotNull() & (docs[lang] != "") & docs[text].isNotNull())
    # The most frequent values; a column that is no language has many.
    usable = usable.select(docs[lang].alias("lang"), docs[text].alias("text"), docs[doc_id].alias("doc_id"))
    sizes = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES)
    share = F.least(F.lit(1.0), F.lit(per_lang) / F.col("n"))
    chosen = usable.join(F.broadcast(sizes), "lang").where(F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(1_000_000)) < share * 1_000_000)  # LANGUAGES rows
    rows = chosen.select("lang", "text").repartition(12)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, sums = Space(), {}
        for b in batches:
            langs = b.column(0).to_pylist()
            for x, v in zip(langs, space.bundle(b.column(1).to_pylist())):
                sums[x] = sums.get(x, 0) + v.astype(np.float64)
        if sums:
            yield pa.RecordBatch.from_arrays([pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())], names=["lang", "v"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for b in batches:
            for x, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if x != now and now is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([total.tobytes()], pa.binary())], names=["lang", "v"])
                total = np.frombuffer(v) if x != now else total + np.frombuffer(v)
                now = x
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([total.tobytes()], pa.binary())], names=["lang", "v"])

    parts = rows.mapInArrow(run, "lang string, v binary").repartition(12, "lang").sortWithinPartitions("lang", "v")
    out = {r.lang: np.frombuffer(bytes(r.v)) for r in parts.mapInArrow(summed, "lang string, v binary").collect()}  # one row a language
    return {k: v / max(np.linalg.norm(v), 1e-12) for k, v in sorted(out.items())}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    spark = tune(docs.sparkSession, 64)
    names = list(prototypes)
    p = np.array([prototypes[k] for k in names], dtype=float).reshape(len(names), DIM)
    mean = p.mean(axis=0) if len(names) > 1 else np.zeros(DIM)
    centred = p - mean
    centred = centred / np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-12) if names else centred
    held = spark.sparkContext.broadcast((names, mean, centred))
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, mean, centred = held.value
        space = Space()
        for b in batches:
            v = space.bundle(b.column(1).to_pylist()).astype(np.float64)
            known = np.any(v != 0, axis=1) & bool(names)
            if names:
                x = v - mean
                cos = x @ centred.T / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                e = np.exp(SHARPNESS * (cos - cos.max(axis=1, keepdims=True)))
                e /= e.sum(axis=1, keepdims=True)
                best = cos.argmax(axis=1)
                score = np.where(known, e[np.arange(len(best)), best], 0.0)
                lang = [names[k] if ok else UNKNOWN for k, ok in zip(best, known)]
            else:
                score, lang = np.zeros(b.num_rows), [UNKNOWN] * b.num_rows
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {id_type}, lang_pred string, score double")


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows outside the held-out fold."""
    prototypes = learn(docs, doc_id, text, lang, F.coalesce(fold_of(docs[doc_id], folds) != held, F.lit(False)))
    found = predict(docs, prototypes, doc_id, text)
    return found.select("doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "lang_pred", "score")
