"""Benchmark decontamination: size-partitioned MinHash containment search, verified exactly.

An item is found in a document if at least ``threshold`` of the item's distinct word shingles stand
in the document. Items are partitioned by size, in powers of two, and each partition has its own length
of sketch: the smallest hashes of an item, one more than the shingles that the largest item of the
partition may miss. An item with n shingles that passes misses at most floor((1 - threshold) n), so at
least so many hashes less of its sketch stand in the document; documents with fewer are no candidates.
All shingles of a document that are not above the largest hash of any sketch are looked up (the others
are left out in the scan), so its length costs no recall, as it would in a sketch of it. Candidates are
verified by counting shared shingles as text.

Everything here is DataFrame expressions. Words are runs of letters and digits in lower case.

Defined results: null and empty texts, and items without words, match nothing; items with fewer
words than a shingle are one shingle of all their words; repeated items with one id are one item
with the shingles of all; repeated documents with one id count as one document with the shingles of
all; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.util import cut

WIDTH = 5
THRESHOLD = 0.8
#: Sketch rows (16 bytes each) up to which they are broadcast; beyond, both sides are shuffled.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def grams(w: Column, width: int) -> Column:
    """All runs of ``width`` words, as text; none if there are fewer words."""
    starts = F.when(F.size(w) >= width, F.sequence(F.lit(1), F.size(w) - F.lit(width - 1)))
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.array_join(F.slice(w, i, width), " "))


def hashed_grams(w: Column, width: int) -> Column:
    """The 64-bit hashes of ``grams``, without building their text: a hash of the word hashes."""
    starts = F.when(F.size(w) >= width, F.sequence(F.lit(0), F.size(w) - F.lit(width)))
    h = [lambda i, j=j: F.get(w, i + F.lit(j)) for j in range(width)]
    return F.transform(F.coalesce(starts, F.array().cast("array<int>")), lambda i: F.xxhash64(*[x(i) for x in h]))


def item_grams(items: DataFrame, item_id: str, text: str, width: int) -> DataFrame:
    """item_id, width, gram: the distinct shingles of each item."""
    w = items.select(items[item_id].alias("item_id"), words(items[text]).alias("w")).where("size(w) > 0 and item_id is not null")
    parts = [w.where(F.size("w") >= width).select("item_id", F.lit(width).alias("width"), F.explode(grams(F.col("w"), width)).alias("gram"))]
    parts += [w.where(F.size("w") == k).select("item_id", F.lit(k).alias("width"), F.array_join("w", " ").alias("gram")) for k in range(1, width)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """item_id, width, h, partition, need: the sketch of each item, as long as its partition's, and how
    many of its hashes a document must hold."""
    missed = lambda n: F.floor((1 - F.lit(threshold)) * n + F.lit(1e-9))
    nth = F.row_number().over(Window.partitionBy("item_id").orderBy("h", "gram"))
    sized = shingles.withColumn("partition", F.floor(F.log2(F.col("n"))).cast("int")).withColumn("nth", nth)
    length = missed(F.pow(F.lit(2), F.col("partition") + 1) - 1) + 1
    return sized.where(F.col("nth") <= length).select("item_id", "width", "h", "partition", (F.least(length, F.col("n")) - missed(F.col("n"))).cast("int").alias("need"))


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, item_id, shared, item_shingles, containment of every pair at or above ``threshold``."""
    shingles = item_grams(items, item_id, text, width)
    gram_words = F.split("gram", " ")
    hash_of = F.coalesce(*[F.when(F.col("width") == k, F.xxhash64(*[F.get(gram_words, F.lit(j)) for j in range(k)])) for k in range(1, width + 1)])
    shingles = cut(shingles.withColumn("h", hash_of).withColumn("n", F.count("*").over(Window.partitionBy("item_id"))))
    sketch = cut(sketches(shingles, threshold))
    n_sketch = sketch.count()
    bounds = {r.width: r.h for r in sketch.groupBy("width").agg(F.max("h").alias("h")).collect()}  # at most ``width`` rows
    widths = sorted(bounds)
    d = docs.select(docs[doc_id].alias("doc_id"), words(docs[text]).alias("w")).where("doc_id is not null and w is not null")
    if not widths:
        widths, bounds = [width], {width: -(2**63)}

    low = lambda k: F.filter(hashed_grams(F.col("w"), k), lambda h: h <= F.lit(bounds[k]).cast("long"))
    looked_up = d.select("doc_id", F.explode(F.concat(*[low(k) for k in widths])).alias("h"))
    keys = sketch.select("item_id", "h", "need")
    keys = F.broadcast(keys) if n_sketch <= BROADCAST_ROWS else keys
    hits = looked_up.join(keys, "h").groupBy("doc_id", "item_id").agg(F.count_distinct("h").alias("hits"), F.max("need").alias("need"))
    pairs = cut(hits.where("hits >= need").select("doc_id", "item_id"))

    # Exact: the shared shingles of candidates, as text.
    theirs = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).where("doc_id is not null")
    theirs = theirs.join(pairs.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", words(F.col("text")).alias("w"))
    grams_of = F.array_distinct(F.concat(*[grams(F.col("w"), k) for k in widths]))
    mine = shingles.select("item_id", "gram", "n")
    if n_sketch <= BROADCAST_ROWS:
        mine = F.broadcast(mine)  # at most 5 times the sketches' rows
    shared = (
        theirs.select("doc_id", F.explode(grams_of).alias("gram"))
        .join(mine, "gram")
        .join(pairs, ["doc_id", "item_id"], "left_semi")
        .groupBy("doc_id", "item_id", "n")
        .agg(F.count_distinct("gram").alias("shared"))
    )
    return shared.where(F.col("shared") >= F.lit(threshold) * F.col("n") - F.lit(1e-9)).select(
        "doc_id", "item_id", F.col("shared").cast("long").alias("shared"), F.col("n").cast("long").alias("item_shingles"), (F.col("shared") / F.col("n")).alias("containment")
    )


def clean(docs: DataFrame, items: DataFrame, **kw) -> DataFrame:
    """The documents in which no item is found; rows with a null id are kept."""
    key = kw.get("doc_id", "doc_id")
    found = find(docs, items, **kw).select(F.col("doc_id").alias(key)).distinct()
    return docs.join(found, key, "left_anti")
