"""Packing in the order of a space-filling curve.

Each document gets a vector: its token ids hashed into buckets, projected to a few dimensions by a
fixed random matrix. The Hilbert key of the vector orders the documents so that neighbours are
alike; they are laid one after another along the curve and cut every ``length`` tokens. Only the
last sequence can be short, so the padding of a whole table is less than one sequence.

Texts are tokenized once. Tokens (two bytes each, compressed) go to a table in the shared folder;
the order is found from keys and counts alone, which are sorted by range; each document's tokens
then meet its place in one join. A key that many documents share is split by row, so no task holds
them all.

Defined results: a null text is packed as an empty one, that is its end token alone; repeated rows
and ids are packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.util import tune, written

LENGTH = 2048
END = 1
DIMS = 3
CURVE_BITS = 10
BUCKETS = 4096
#: Words whose ids a worker remembers.
REMEMBERED = 400_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


# Tokens. ---------------------------------------------------------------------------------------


class Words:
    """Splits texts as the byte-level pre-tokenizer does and remembers the ids of each word.

    The ids are those of the file, a byte-level BPE for ``tokenizers``: its pre-tokenizer splits a
    text into words, and each word is merged by itself. The merges are made by tiktoken's core from
    the same file's vocabulary, whose ids stand in merge order, which is several times faster. With
    ``added``, texts that hold one of the file's added tokens are left to ``tokenizers``, which gives
    such a token its own id; without, it is read as plain text."""

    def __init__(self, path: str, added: bool = False):
        import regex
        import tiktoken

        with open(path, encoding="utf-8") as f:
            told = json.load(f)
        model, names = told["model"], [t["content"] for t in told.get("added_tokens") or []]
        self.added, self.whole = None, None
        if added and names:
            import tokenizers

            self.added = regex.compile("|".join(map(regex.escape, names))).search
            self.whole = tokenizers.Tokenizer.from_file(path)
        as_byte = {c: b for b, c in byte_letters().items()}
        ranks = {bytes(as_byte[c] for c in word): i for word, i in model["vocab"].items() if all(c in as_byte for c in word) and not word.startswith("<|")}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.split = regex.compile(pattern).findall
        self.core = tiktoken.Encoding("words", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.seen: dict[str, bytes] = {}

    def ids(self, text: str) -> bytes:
        """The ids of the text, two bytes each."""
        if self.added and self.added(text):
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u2").tobytes()
        if len(self.seen) > REMEMBERED:
            self.seen.clear()
        seen, core, out = self.seen, self.core, []
        for w in self.split(text):
            b = seen.get(w)
            if b is None:
                b = seen[w] = np.array(core(w.encode("utf-8", "replace")), dtype="<u2").tobytes()
            out.append(b)
        return b"".join(out)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones for
    themselves, the others for the letters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


@functools.cache
def _words(path: str, added: bool) -> Words:
    return Words(path, added)


# Order. ----------------------------------------------------------------------------------------


def projection(dims: int = DIMS, buckets: int = BUCKETS, seed: int = 7) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((buckets, dims))


def hilbert(x: np.ndarray, bits: int = CURVE_BITS) -> np.ndarray:
    """Hilbert keys of points with integer coordinates below 2^bits, one point in a row (Skilling)."""
    x = x.astype(np.int64).copy()
    n = x.shape[1]
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            hit = (x[:, i] & q) > 0
            t = np.where(hit, 0, (x[:, 0] ^ x[:, i]) & p)
            x[:, 0] = np.where(hit, x[:, 0] ^ p, x[:, 0] ^ t)
            x[:, i] ^= t if i else 0
        q >>= 1
    for i in range(1, n):
        x[:, i] ^= x[:, i - 1]
    t = np.zeros(len(x), dtype=np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[:, n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t[:, None]
    key = np.zeros(len(x), dtype=np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[:, i] >> b & 1)
    return key


def curve_key(ids: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """The vector of one document as a point on the curve's grid."""
    if not len(ids):
        return np.zeros(matrix.shape[1], dtype=np.int64)
    counts = np.bincount((ids.astype(np.int64) * 40503 >> 4) % BUCKETS, minlength=BUCKETS)
    v = (np.sqrt(counts) @ matrix) / np.sqrt(len(ids))
    return np.clip((np.tanh(v / 2) + 1) / 2 * (1 << CURVE_BITS), 0, (1 << CURVE_BITS) - 1).astype(np.int64)


def tokenized(docs: DataFrame, doc_id: str, text: str, path: str, added: bool = False) -> DataFrame:
    """row, doc_id, key, n, ids of every row; n counts the end token, which ids do not hold."""
    spark = tune(docs.sparkSession, 256)
    id_type = docs.schema[doc_id].dataType.simpleString()
    held = spark.sparkContext.broadcast(projection())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pack = _words(path, added), zstandard.ZstdCompressor(level=1).compress
        for b in batches:
            raw = [words.ids(t.as_py() or "") for t in b.column(2)]
            points = np.array([curve_key(np.frombuffer(r, dtype="<u2"), held.value) for r in raw]).reshape(-1, DIMS)
            n = np.array([len(r) // 2 + 1 for r in raw], dtype=np.int64)
            cols = [b.column(0), b.column(1), pa.array(hilbert(points)), pa.array(n), pa.array([pack(r) for r in raw], pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, names=["row", "doc_id", "key", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_id].alias("doc_id"), docs[text].alias("text"))
    return rows.mapInArrow(run, f"row long, doc_id {id_type}, key long, n long, ids binary")


def places(rows: DataFrame) -> DataFrame:
    """row, at: how many tokens stand before the row's first along the curve."""
    slim = rows.select("row", "key", "n")
    sorted_rows = written(slim.repartitionByRange("key", "row").select("*", F.spark_partition_id().alias("part")), "curve")
    totals = sorted_rows.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()  # one row for each partition
    starts, at = [], 0
    for t in totals:
        starts.append((t.part, at))
        at += t.n
    base = rows.sparkSession.createDataFrame(starts, "part int, base long")
    before = Window.partitionBy("part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, -1)
    return sorted_rows.join(F.broadcast(base), "part").select("row", (F.col("base") + F.coalesce(F.sum("n").over(before), F.lit(0))).alias("at"))


def pack(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, end: int = END, tokenizer: str | None = None, added: bool = False) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids (little-endian, four bytes each),
    doc_tokens, sequence_id, offset. With ``added``, the file's added tokens have their own ids where a
    text quotes them."""
    rows = written(tokenized(docs, doc_id, text, tokenizer or default_tokenizer(), added), "tokens")
    id_type = docs.schema[doc_id].dataType.simpleString()

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
        for b in batches:
            out = [[] for _ in range(6)]
            owner, held = [], 0
            for k, (raw, n, at) in enumerate(zip(b.column(1), b.column(2).to_pylist(), b.column(3).to_pylist())):
                raw = unpack(raw.as_py(), max_output_size=2 * n)
                ids = np.append(np.frombuffer(raw, dtype="<u2").astype("<u4"), np.uint32(end)).astype("<u4")
                start = 0
                while start < n:
                    m = min(n - start, length - (at + start) % length)
                    for col, v in zip(out, (start, m, ids[start : start + m].tobytes(), n, (at + start) // length, (at + start) % length)):
                        col.append(v)
                    owner.append(k)
                    start += m
                held += 4 * n
                if held > 8_000_000 or k == b.num_rows - 1:
                    types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(out, types))], names=names)
                    out, owner, held = [[] for _ in range(6)], [], 0

    joined = rows.select("row", "doc_id", "ids", "n").join(places(rows), "row").select("doc_id", "ids", "n", "at")
    return joined.mapInArrow(cut_up, f"doc_id {id_type}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long")
