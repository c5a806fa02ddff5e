"""Nearest neighbours by multi-index hashing.

Vectors get binary codes: the signs of learned rotations of the centred vectors (iterative quantization,
one rotation for each ``dim`` bits), fitted on a bounded sample. A code is split into substrings, and the
index has a row for each substring of each code: its number, its value, the entry and the code. If two
codes differ in at most r bits, one of their m substrings differs in at most r // m; and not all of them
differ in more than their share, so the first r mod m + 1 substrings are probed within r // m bits and
the others within one bit less. Probes are rows too, and meet the index rows of their substring and
value. A pair is taken at the first substring that brings it, so it is found once.

The radius grows for each query until enough codes lie within it: most queries of clustered data end at
a small one. Where the data are spread evenly, a radius that holds the nearest holds a fixed share of all
codes. So codes go on beyond the substrings, to LONG bits: what lies within the radius is counted by how many
of all bits differ, and only the nearest by that count, a fixed number for each query, are written as pairs
and ranked by distance of the original vectors, in double precision. What no radius finds enough for is
compared with all entries, in blocks.

Equal vectors are one entry of the index, with the ids that can matter: the smallest k + 1, as ties
go to smaller ids. So a vector that fills a third of the table is compared once. A substring value that
very many codes have is dealt in parts, to which its probes are copied.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part, nor
do rows with a null id; vectors of another length than most are left out; a query's own row is no
candidate of it; repeated rows of one id and vector are one; with fewer candidates than k all are
returned; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.util import cut, tune

BITS, WIDTH = 128, 8
SUBSTRINGS = BITS // WIDTH
#: Bits of a whole code, of which the first BITS are the substrings.
LONG = 512
#: Radii that are tried one after another, and codes (times k + 1) that have to lie within one.
RADII = (18, 34, 53, 60)
ENOUGH = 16
#: Codes (times k + 1) that are ranked by vectors; they are counted by so many differing bits at a time.
SHORT, COUNTED = 32, 4
SAMPLE = 20_000
PART = 20_000  # index rows of one value that a task compares at a time
BLOCK = 4096  # entries that a task compares with queries that no radius settles
EVERY = 100


def usable(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """vec_id and v (doubles) of the rows that take part."""
    v = F.transform(df[vector], lambda x: x.cast("double"))
    d = df.where(df[vec_id].isNotNull() & df[vector].isNotNull()).select(df[vec_id].cast("long").alias("vec_id"), v.alias("v"))
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return d.where((F.size("v") > 0) & ~F.exists("v", bad) & F.exists("v", lambda x: x != 0)).distinct()


def learn(vectors: DataFrame, dim: int, sample: int = SAMPLE, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Mean and rotations (dim x LONG) of a sample of about ``sample`` vectors, chosen by hash."""
    n = vectors.count()
    share = min(1.0, sample / max(n, 1))
    got = vectors.where(F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1_000_000)) < share * 1_000_000).orderBy("vec_id").select("v").toArrow()
    x = got.column(0).combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim) if got.num_rows else np.zeros((1, dim))
    mean = x.mean(axis=0)
    x = x - mean
    k = min(dim, 64)
    _, vecs = np.linalg.eigh(x.T @ x)
    w = vecs[:, ::-1][:, :k]
    p, out = x @ w, []
    while sum(r.shape[1] for r in out) < LONG:
        r = np.linalg.qr(np.random.default_rng(len(out)).standard_normal((k, k)))[0]
        # The rotation that brings the data nearest to the corners of the cube; beyond the substrings a random one.
        for _ in range(rounds if sum(r.shape[1] for r in out) < BITS else 0):
            a, _, b = np.linalg.svd(np.sign(p @ r).T @ p)
            r = (a @ b).T
        out.append(w @ r)
    return mean, np.concatenate(out, axis=1)[:, :LONG]


def coded(vectors: DataFrame, mean: np.ndarray, rotation: np.ndarray) -> DataFrame:
    """The rows with their code, binary of LONG bits."""
    held = vectors.sparkSession.sparkContext.broadcast((mean, rotation))

    def run(batches):
        m, r = held.value
        for b in batches:
            x = b.column(b.schema.get_field_index("v")).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, len(m)) if b.num_rows else np.zeros((0, len(m)))
            raw = np.packbits((x - m) @ r > 0, axis=1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([row.tobytes() for row in raw], pa.binary())], names=[*b.schema.names, "code"])

    schema = ", ".join(f"{n} {t}" for n, t in vectors.dtypes) + ", code binary"
    return vectors.mapInArrow(run, schema)


@functools.cache
def masks(within: int) -> np.ndarray:
    """The substring values with at most that many bits set."""
    return np.array([m for m in range(1 << WIDTH) if m.bit_count() <= within], dtype=np.int64)


def limits(radius: int) -> np.ndarray:
    """How many bits each substring is probed within: if all differ in more, the codes differ in more
    than ``radius`` bits."""
    base, more = divmod(radius, SUBSTRINGS)
    return np.array([base if k <= more else base - 1 for k in range(SUBSTRINGS)])


ROWS = "sub int, value int, part int, query boolean, id long, code binary, most int"


def _rows(b: pa.RecordBatch, sub: np.ndarray, value: np.ndarray, part: np.ndarray, query: bool, at: np.ndarray, most: np.ndarray) -> pa.RecordBatch:
    cols = [pa.array(sub, pa.int32()), pa.array(value, pa.int32()), pa.array(part, pa.int32()), pa.array(np.full(len(at), query)), b.column(0).take(pa.array(at)), b.column(1).take(pa.array(at)), pa.array(most[at], pa.int32())]
    return pa.RecordBatch.from_arrays(cols, names=["sub", "value", "part", "query", "id", "code", "most"])


def _codes(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(max(1, len(column)), -1)


def indexed(entries: DataFrame, parts: int) -> DataFrame:
    """The index: a row (``ROWS``) for each substring of each code."""

    def run(batches):
        for b in batches:
            if b.num_rows:
                codes, n = _codes(b.column(1)), b.num_rows
                part = (b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(parts)
                yield _rows(b, np.tile(np.arange(SUBSTRINGS), n), codes[:, :SUBSTRINGS].ravel(), np.repeat(part.astype(np.int64), SUBSTRINGS), False, np.repeat(np.arange(n), SUBSTRINGS), np.zeros(n, int))

    return entries.select("entry", "code").mapInArrow(run, ROWS)


def probes(queries: DataFrame, radius: int, parts: int) -> DataFrame:
    """A row for each substring value that a query (query, code, most) has to look at, in every part."""
    within = limits(radius)

    def run(batches):
        for b in batches:
            for lo in range(0, b.num_rows, 64):
                some = b.slice(lo, 64)
                codes, most, n = _codes(some.column(1)), some.column(2).to_numpy(zero_copy_only=False), some.num_rows
                for k in range(SUBSTRINGS):
                    if within[k] >= 0:
                        flips = masks(int(within[k]))
                        value = np.repeat((codes[:, k].astype(np.int64)[:, None] ^ flips).ravel(), parts)
                        at = np.repeat(np.arange(n), len(flips) * parts)
                        yield _rows(some, np.full(len(at), k), value, np.tile(np.arange(parts), n * len(flips)), True, at, most)

    return queries.select("query", "code", "most").mapInArrow(run, ROWS)


class Counts:
    """How many codes are at each distance of each query, summed up in a task."""

    def __init__(self, rows: int = 400_000):
        self.rows, self.parts, self.held = rows, [], 0

    def add(self, query: np.ndarray, far: np.ndarray) -> None:
        if len(query):
            self.parts.append((query, far, np.ones(len(query), np.int64)))
            self.held += len(query)

    def summed(self) -> pa.RecordBatch:
        query, far, n = (np.concatenate(x) for x in zip(*self.parts))
        order = np.lexsort((far, query))
        query, far, n = query[order], far[order], n[order]
        first = np.flatnonzero(np.r_[True, (np.diff(query) != 0) | (np.diff(far) != 0)])
        self.parts = [(query[first], far[first], np.add.reduceat(n, first))]
        self.held = len(first)
        return pa.RecordBatch.from_arrays([pa.array(query[first]), pa.array(far[first].astype(np.int32)), pa.array(self.parts[0][2])], names=["query", "far", "n"])

    def full(self) -> Iterator[pa.RecordBatch]:
        """The counts so far, if even summed up they are many."""
        if self.held > self.rows:
            out = self.summed()
            if self.held > self.rows // 2:
                self.parts, self.held = [], 0
                yield out


def within(index: DataFrame, queries: DataFrame, radius: int, parts: int, pairs: bool = True) -> DataFrame:
    """query, entry: every pair of codes that differ in at most ``radius`` of the substrings' bits, once; if the queries have a column
    ``most``, those that are at most so far by COUNTED differing bits of the whole codes. Or (not ``pairs``) how many there are:
    query, far, n, each query's to be summed."""
    limit = limits(radius)
    queries = queries if "most" in queries.columns else queries.withColumn("most", F.lit(1 << 30))

    def compared(sub: int, entry: np.ndarray, own: np.ndarray, query: np.ndarray, theirs: np.ndarray, most: np.ndarray) -> Iterator[tuple]:
        own_sub, their_sub = (np.ascontiguousarray(x[:, :SUBSTRINGS]) for x in (own, theirs))
        for lo in range(0, len(query), max(1, 400_000 // max(len(entry), 1))):
            hi = lo + max(1, 400_000 // max(len(entry), 1))
            gap = np.bitwise_count(own_sub.view(np.uint64)[None, :, :] ^ their_sub[lo:hi].view(np.uint64)[:, None, :]).sum(axis=2, dtype=np.int16)
            at, of = np.nonzero(gap <= radius)
            first = (np.bitwise_count(own_sub[of] ^ their_sub[lo:hi][at]) <= limit).argmax(axis=1) == sub
            at, of = at[first], of[first]
            far = np.bitwise_count(own.view(np.uint64)[of] ^ theirs[lo:hi].view(np.uint64)[at]).sum(axis=1, dtype=np.int64) // COUNTED
            near = far <= most[lo:hi][at] if pairs else slice(None)
            yield query[lo:hi][at][near], entry[of][near], far[near]

    def run(batches):
        key, entries, codes, counts = None, [], [], Counts()
        for b in batches:
            cols = [b.column(k).to_numpy(zero_copy_only=False) for k in (0, 1, 2, 3, 4, 6)]
            raw = _codes(b.column(5))
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0) | (np.diff(cols[2]) != 0)) + 1
            for lo, hi in zip([0, *new.tolist()], [*new.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                now = (int(cols[0][lo]), int(cols[1][lo]), int(cols[2][lo]))
                if now != key:
                    key, entries, codes = now, [], []
                asks = cols[3][lo:hi].astype(bool)
                if not asks.all():
                    entries.append(cols[4][lo:hi][~asks])
                    codes.append(raw[lo:hi][~asks])
                if asks.any() and entries:
                    entries, codes = [np.concatenate(entries)], [np.ascontiguousarray(np.concatenate(codes))]
                    for query, entry, far in compared(key[0], entries[0], codes[0], cols[4][lo:hi][asks], np.ascontiguousarray(raw[lo:hi][asks]), cols[5][lo:hi][asks]):
                        if pairs:
                            yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(entry)], names=["query", "entry"])
                        else:
                            counts.add(query, far)
                            yield from counts.full()
        if counts.parts:
            yield counts.summed()

    rows = index.unionByName(probes(queries, radius, parts))
    rows = rows.repartition("sub", "value", "part").sortWithinPartitions("sub", "value", "part", "query")
    return rows.mapInArrow(run, "query long, entry long" if pairs else "query long, far int, n long")


def ranked(pairs: DataFrame, entries: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query, ids, score: the k + 1 nearest of the pairs (query, entry) of each query, by distance."""
    both = pairs.join(entries.select("entry", "ids", F.col("v").alias("x")), "entry").join(queries.select("query", F.col("v").alias("y")), "query")
    return _nearest(both.select("query", "ids", "x", "y"), k)


def _nearest(both: DataFrame, k: int) -> DataFrame:
    def run(batches):
        for b in batches:
            if b.num_rows:
                x, y = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for i in (2, 3))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.sqrt(((x - y) ** 2).sum(axis=1)))], names=["query", "ids", "score"])

    scored = both.mapInArrow(run, "query long, ids array<long>, score double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", F.col("ids")[0]))
    return scored.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")


def compared_with_all(entries: DataFrame, queries: DataFrame, k: int, n: int) -> DataFrame:
    """The same for queries (query, v) and every entry: blocks of entries meet the queries, and each block
    keeps its k + 1 best of a query, with what ties with the last."""
    blocks = max(1, -(-n // BLOCK))
    kind = "id long, block int, asks boolean, ids array<long>, v array<double>"
    own = entries.select(F.col("entry").alias("id"), F.pmod(F.xxhash64("entry"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asks"), "ids", "v")
    theirs = queries.select(F.col("query").alias("id"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"), F.array().cast("array<long>").alias("ids"), "v")

    def run(batches):
        block, ids, x = None, [], []
        for b in batches:
            at, asks = b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            v = b.column(4).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) if b.num_rows else None
            for r in range(b.num_rows):
                if at[r] != block:
                    block, ids, x = at[r], [], []
                if not asks[r]:
                    ids.append(b.column(3)[r].as_py())
                    x.append(v[r])
                elif ids:
                    x = x if isinstance(x, np.ndarray) else np.array(x)
                    d = np.sqrt(((x - v[r]) ** 2).sum(axis=1))
                    keep = np.flatnonzero(d <= np.partition(d, k)[k]) if len(d) > k + 1 else np.arange(len(d))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keep), b.column(0)[r].as_py())), pa.array([ids[j] for j in keep], pa.list_(pa.int64())), pa.array(d[keep])], names=["query", "ids", "score"])

    rows = own.unionByName(theirs).select([c.split()[0] for c in kind.split(", ")])
    found = rows.repartition("block").sortWithinPartitions("block", "asks").mapInArrow(run, "query long, ids array<long>, score double")
    nth = F.row_number().over(Window.partitionBy("query").orderBy("score", F.col("ids")[0]))
    return found.withColumn("nth", nth).where(F.col("nth") <= k + 1).drop("nth")


def nearest(entries: DataFrame, queries: DataFrame, k: int, radii: tuple[int, ...] = RADII, enough: int = ENOUGH) -> DataFrame:
    """query, ids, score: the k + 1 nearest found of each query. ``entries`` has entry, ids, v and code,
    ``queries`` query, v and code. The plan's size depends on the radii, not on the number of queries."""
    n = entries.count()
    parts = max(1, -(-n // ((1 << WIDTH) * PART)))
    index, open_, out = cut(indexed(entries, parts)), queries, None
    counted = Window.partitionBy("query").orderBy("far")
    for radius in radii:
        counts = within(index, open_.select("query", "code"), radius, parts, False).groupBy("query", "far").agg(F.sum("n").alias("n"))
        upto = counts.withColumn("upto", F.sum("n").over(counted))
        # Up to where so many are counted, or to the last, of the queries that have enough.
        most = F.coalesce(F.min(F.when(F.col("upto") >= SHORT * (k + 1), F.col("far"))), F.max("far")).alias("most")
        full = cut(upto.groupBy("query").agg(most, F.max("upto").alias("n")).where(F.col("n") >= min(enough * (k + 1), n)).select("query", "most"))
        if full.isEmpty():
            continue
        pairs = within(index, open_.join(full, "query").select("query", "code", "most"), radius, parts, True)
        settled = cut(ranked(pairs, entries, open_, k))
        out = settled if out is None else out.unionByName(settled)
        open_ = cut(open_.join(full, "query", "left_anti"))
        if open_.isEmpty():
            return out
    rest = compared_with_all(entries, open_, k, n)
    return rest if out is None else out.unionByName(rest)


def search(df: DataFrame, k: int = 10, vec_id: str = "vec_id", vector: str = "embedding", every: int = EVERY, radii: tuple[int, ...] = RADII, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row whose id is divisible by ``every``."""
    spark = tune(df.sparkSession, 8192)
    all_rows = cut(usable(df, vec_id, vector))
    common = all_rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if common is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dim = common.dim
    all_rows = all_rows.where(F.size("v") == dim)
    # One entry for each distinct vector; a rank in a window is pruned before the shuffle.
    named = all_rows.withColumn("key", F.md5(F.concat_ws(",", F.transform("v", lambda x: (x + F.lit(0.0)).cast("string")))))
    first = named.withColumn("nth", F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))).where(F.col("nth") <= k + 1)
    entries = first.groupBy("key").agg(F.min("vec_id").alias("entry"), F.sort_array(F.collect_list("vec_id")).alias("ids"), F.min_by("v", "vec_id").alias("v"))
    mean, rotation = learn(all_rows, dim, sample)
    index = cut(coded(entries.select("entry", "key", "ids", "v"), mean, rotation))
    asks = cut(named.where(F.col("vec_id") % every == 0).select("key", F.col("vec_id").alias("query_id")).join(index.select("key", F.col("entry").alias("query")), "key").select("query", "query_id"))
    queries = cut(index.join(asks.select(F.col("query").alias("entry")).distinct(), "entry", "left_semi").select(F.col("entry").alias("query"), "v", "code"))
    best = cut(nearest(index.select("entry", "ids", "v", "code"), queries, k, radii))
    flat = asks.join(best, "query").select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return flat.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def brute_force(spark: SparkSession, df: DataFrame, k: int = 10, every: int = EVERY) -> list[tuple]:
    """All (query_id, rank, vec_id, score) by comparing everything on the driver; for tests."""
    rows = sorted((r.vec_id, r.v) for r in usable(df, "vec_id", "embedding").collect())
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    out = []
    for i in np.flatnonzero(ids % every == 0):
        d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != ids[i]][:k]
        out += [(int(ids[i]), n + 1, int(ids[j]), float(d[j])) for n, j in enumerate(order)]
    return out
