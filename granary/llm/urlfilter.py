"""URL filter: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

A list entry is a host and a path; it fits that host and all its subdomains where a url's path
starts with the entry's. A url is turned into the canonical keys that could be listed (each suffix
of its host that has as many labels as some entry, with each prefix of its path that is as long as
some entry's), and each key is looked up in the filter. Only urls with a possible hit go on to the
exact join with the list, which removes false positives; the longest entry decides.

The filter has 512-bit blocks, one block for a key and eight bits in it. Its size is set by the
list and bounded by ``MAX_BLOCKS``: beyond that it lets more false positives through, and results
stay the same.

Defined results: a null url, or one without ``://``, has an empty host and path, fits no entry and
gets the default verdict; repeated rows are judged one by one; an empty table or list gives no rows
or default verdicts; entries that are repeated count once, and of entries with the same host and
path but different verdicts ``block`` wins. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_PER_KEY = 16
MAX_BLOCKS = 1 << 20  # 64 MB
WORDS = 8  # of 64 bits in a block
#: The seed of Spark's hash.
SPARK_SEED = 42


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    raw = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(raw, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    return F.concat(host, F.lit("\n"), path)


def bloom(keys: DataFrame, blocks: int) -> np.ndarray:
    """The filter of a column ``key``: the words of a block are merged by bit_or where the keys are, and
    reach the driver as 64 bytes for each block that is not empty, in columns."""
    g = F.xxhash64("key", F.lit(7))
    # The i-th six bits pick one of 64 places in the i-th word.
    words = [F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(g, {6 * i}) & 63 AS int))")).alias(f"w{i}") for i in range(WORDS)]
    rows = keys.select(F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int").alias("block"), g.alias("g")).groupBy("block").agg(*words).toArrow()  # 64 bytes x blocks at most
    out = np.zeros((blocks, WORDS), dtype=np.uint64)
    at = rows.column("block").to_numpy()
    for i in range(WORDS):
        out[at, i] = rows.column(f"w{i}").to_numpy().view(np.uint64)
    return out


def judge(pages: DataFrame, listed: DataFrame, row_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """row id, host, path, rule and verdict of every row of ``pages``.

    ``listed`` has host, path and verdict. It may be large: only its count, the lengths that occur in it
    (labels of hosts with characters of paths) and the filter's bits reach the driver. The plan is the same whatever the list."""
    spark = pages.sparkSession
    rules = (
        listed.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))  # block > allow
        .select(canonical(F.col("host"), F.col("path")).alias("key"), F.concat("host", "path").alias("rule"), "verdict", F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("chars"))
    )
    shapes = sorted((r.labels, r.chars) for r in rules.select("labels", "chars").distinct().collect())  # labels of a host x lengths of a path
    rows = pages.select(pages[row_id].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    if not shapes:
        return rows.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    n = rules.count()
    blocks = int(min(MAX_BLOCKS, max(1, -(-n * BITS_PER_KEY // 512))))
    held = spark.sparkContext.broadcast((bloom(rules.select("key"), blocks), shapes))
    id_type = pages.schema[row_id].dataType.simpleString()

    def possible(batches):
        """The rows with the keys that the filter lets through."""
        bits, shapes = held.value
        for b in batches:
            owner, keys = [], []
            for k, (host, path) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist())):
                ends = [len(host), *(i for i in range(len(host) - 1, -1, -1) if host[i] == ".")]
                suffixes = [host[i + 1 :] for i in ends[1:]] + [host]  # by number of labels
                for labels, chars in shapes:
                    if labels <= len(suffixes) and chars <= len(path):
                        owner.append(k)
                        keys.append(f"{suffixes[labels - 1]}\n{path[:chars]}")
            hit = np.ones(len(keys), dtype=bool)
            if keys:
                raw = [x.encode("utf-8", "surrogatepass") for x in keys]
                block = np.fromiter((xxhash.xxh64_intdigest(x, SPARK_SEED) for x in raw), dtype=np.uint64, count=len(raw)).view(np.int64) % len(bits)
                g = np.fromiter((_spark_hash_with(x, 7) for x in raw), dtype=np.uint64, count=len(raw))
                for i in range(WORDS):
                    hit &= (bits[block, i] >> ((g >> np.uint64(6 * i)) & np.uint64(63)) & np.uint64(1)).astype(bool)
            passed: list[list[str]] = [[] for _ in range(b.num_rows)]
            for k in np.flatnonzero(hit):
                passed[owner[k]].append(keys[k])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(passed, pa.list_(pa.string()))], names=["page_id", "host", "path", "keys"])

    flagged = rows.mapInArrow(possible, f"page_id {id_type}, host string, path string, keys array<string>")
    clear = flagged.where(F.size("keys") == 0).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    exact = (
        flagged.where(F.size("keys") > 0)
        .withColumn("rid", F.monotonically_increasing_id())
        .select("rid", "page_id", "host", "path", F.explode("keys").alias("key"))
        .join(rules.select("key", "rule", "verdict"), "key", "left")
        .groupBy("rid", "page_id", "host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), F.when(F.col("rule").isNotNull(), F.struct(F.length("rule"), F.col("rule")))).alias("b"))
        .select("page_id", "host", "path", F.col("b.rule").alias("rule"), F.coalesce("b.verdict", F.lit(default)).alias("verdict"))
    )
    return clear.unionByName(exact)


def _spark_hash_with(raw: bytes, more: int) -> int:
    """xxhash64 of a text and a small integer, as Spark has it: each value's hash seeds the next."""
    return _hash_int(more, xxhash.xxh64_intdigest(raw, SPARK_SEED))


def _hash_int(value: int, seed: int) -> int:
    return xxhash.xxh64_intdigest(value.to_bytes(4, "little"), seed)
