"""Sharding by fixed virtual slots.

Records are hashed into a fixed number of virtual slots. Bytes are summed for each slot, and a
small versioned table says which shard holds which slot. Rebalancing edits that table; records are
never hashed anew. The table has ``slots`` rows at any input size, so it may be collected and
broadcast.

Defined results: a null text counts no bytes and has a null checksum; an empty text counts 0 bytes;
rows with a null id are hashed by their text; repeated rows share a slot and get places one after
another; an empty table gives no rows and a map whose slots are dealt evenly; other columns, also
ones that are called like the results, are ignored.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.llm.util import written
from granary.sources import shared

SLOTS = 8192
#: A slot with over 1 / (shards x HOT) of the bytes is split into FINE finer ones.
HOT, FINE = 8, 64
OVERHEAD = 8  # bytes that each record takes besides its text
MAP_SCHEMA = T.StructType(
    [
        T.StructField("version", T.IntegerType(), False),
        T.StructField("vslot", T.IntegerType(), False),
        T.StructField("shard", T.IntegerType(), False),
        T.StructField("base", T.LongType(), False),
    ]
)


def slot_of(key: Column, text: Column, slots: int) -> Column:
    """The virtual slot: a hash of the key, of the text where there is no key."""
    return F.pmod(F.coalesce(F.xxhash64(key), F.xxhash64(text)), F.lit(slots)).cast("int")


def records(docs: DataFrame, key: str, text: str, slots: int) -> DataFrame:
    """doc_id, size, text_crc32, rid (a number of the row), vslot, and fine (the finer slot that it has where its slot is split:
    a number that follows from slot and row alone) of every row. The text itself goes no further."""
    t = docs[text]
    rows = docs.select(
        docs[key].alias("doc_id"),
        (F.coalesce(F.octet_length(t), F.lit(0)) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(t).alias("text_crc32"),
        F.monotonically_increasing_id().alias("rid"),
        F.when(docs[key].isNull(), F.pmod(F.xxhash64(t), F.lit(slots)).cast("int")).otherwise(slot_of(docs[key], t, slots)).alias("vslot"),
    )
    return rows.withColumn("fine", (F.lit(slots) + F.col("vslot") * FINE + F.pmod(F.xxhash64("rid"), F.lit(FINE))).cast("int"))


def slot_stats(recs: DataFrame, slots: int, split: list[int] | tuple = ()) -> list[tuple[int, int, int]]:
    """(vslot, bytes, rows) of every slot, of the finer ones where a slot is split; at most slots x FINE rows reach the driver,
    and far fewer as only hot slots are split."""
    found = {r.vslot: (r.b, r.n) for r in recs.groupBy(_told_apart(split).alias("vslot")).agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    numbers = [s for s in range(slots) if s not in set(split)] + [slots + s * FINE + k for s in sorted(split) for k in range(FINE)]
    return [(s, *found.get(s, (0, 0))) for s in numbers]


def _told_apart(split: list[int] | tuple) -> Column:
    """The slot of a row: the finer one if its slot is split."""
    return F.when(F.col("vslot").isin(*split), F.col("fine")).otherwise(F.col("vslot")) if split else F.col("vslot")


def build_map(stats: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """Version 0: the largest slots first, each to the shard with the fewest bytes so far."""
    heap = [(0, 0, k) for k in range(shards)]
    out = {}
    for s, b, _ in sorted(stats, key=lambda x: (-x[1], x[0])):
        load, held, k = heapq.heappop(heap)
        out[s] = k
        heapq.heappush(heap, (load + b, held + 1, k))
    return out


def rebalance(held: dict[int, int], stats: list[tuple[int, int, int]], shards: int) -> dict[int, int]:
    """The next version for ``shards`` shards: slots move only off shards above the mean, to those
    below it, until none can give one away without falling below the mean; all others stay."""
    size = {s: b for s, b, _ in stats}
    loads = [0] * shards
    for s, k in held.items():
        if k < shards:
            loads[k] += size[s]
    mean = sum(size.values()) / shards
    out, homeless = dict(held), [s for s, k in held.items() if k >= shards]
    for k in range(shards):
        for s in sorted((s for s, h in held.items() if h == k), key=lambda s: (size[s], s), reverse=True):
            if loads[k] - size[s] >= mean and size[s]:
                loads[k] -= size[s]
                homeless.append(s)
    heap = [(b, k) for k, b in enumerate(loads)]
    heapq.heapify(heap)
    for s in sorted(homeless, key=lambda s: (-size[s], s)):
        b, k = heapq.heappop(heap)
        out[s] = k
        heapq.heappush(heap, (b + size[s], k))
    return out


def map_table(spark: SparkSession, version: int, held: dict[int, int], stats: list[tuple[int, int, int]]) -> DataFrame:
    """The map as rows: version, vslot, shard, and the place in the shard of the slot's first row."""
    rows, seen = [], {}
    for s, _, n in stats:
        k = held[s]
        rows.append((version, s, k, seen.get(k, 0)))
        seen[k] = seen.get(k, 0) + n
    return spark.createDataFrame(rows, MAP_SCHEMA)


class SlotMap:
    """The stored slot-to-shard map: a folder for each version, which is written once and never changed."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def versions(self) -> list[int]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = fs.listStatus(root) if fs.exists(root) else []
        done = [f.getPath() for f in found if fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{f.getPath()}/_SUCCESS"))]
        return sorted(int(p.getName().split("=")[1]) for p in done)

    def read(self, version: int | None = None) -> DataFrame:
        """A version of the map; the last one, if none is named."""
        at = self.versions()[-1] if version is None else version
        return self.spark.read.schema(MAP_SCHEMA).parquet(self._folder(at))

    def held(self, version: int | None = None) -> dict[int, int]:
        return {r.vslot: r.shard for r in self.read(version).select("vslot", "shard").collect()}  # one row for each slot

    def write(self, held: dict[int, int], stats: list[tuple[int, int, int]]) -> int:
        """Stores the next version and gives its number."""
        version = self.versions()[-1] + 1 if self.versions() else 0
        map_table(self.spark, version, held, stats).coalesce(1).write.parquet(self._folder(version))
        return version

    def rebalanced(self, stats: list[tuple[int, int, int]], shards: int) -> int:
        """Reads the last version, edits it for the bytes and the number of shards of now, and stores the
        result as the next."""
        old = self.held()
        known = {s: old[s] if s in old else k for (s, _, _), k in zip(stats, _spread(len(stats), shards))}
        return self.write(rebalance(known, stats, shards), stats)


def _spread(n: int, shards: int) -> list[int]:
    return [i % shards for i in range(n)]


def hot_slots(stats: list[tuple[int, int, int]], shards: int) -> list[int]:
    """Slots that hold too much for a balanced map: fewer than shards x HOT. An id that a large share of the rows has is one
    slot, whose rows are told apart by their own number."""
    total = sum(b for _, b, _ in stats)
    return [s for s, b, _ in stats if total and b * shards * HOT > total and b > 0]


def split_of(held: DataFrame, slots: int) -> list[int]:
    """The slots that a version of the map has split, told by their finer slots; the version says it itself, so any version
    places any rows as it placed them when it was made."""
    return sorted(r.s for r in held.where(F.col("vslot") >= slots).select(F.floor((F.col("vslot") - slots) / FINE).cast("int").alias("s")).distinct().collect())


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", slots: int = SLOTS, store: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with shard and place, slot-to-shard map). The map is read from the store at ``store`` and
    edited there where the bytes of now call for it; without a store there, or with an empty one, version
    0 is built. What is stored is what the rows are joined with."""
    spark = docs.sparkSession
    recs = written(records(docs, key, text, slots), "records")
    kept = SlotMap(spark, store or shared.fresh(spark, "slot-map"))
    before = split_of(kept.read(), slots) if kept.versions() else []  # what is split stays so
    split = sorted({*hot_slots(slot_stats(recs, slots), shards), *before})
    stats = slot_stats(recs, slots, split)
    version = kept.rebalanced(stats, shards) if kept.versions() else kept.write(build_map(stats, shards), stats)
    held = kept.read(version)
    return placed(recs, held, slots), held


def placed(recs: DataFrame, held: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Records in the shards of a version of the map, with their places there. A record whose slot the map lacks is an error."""
    rows = recs.withColumn("vslot", _told_apart(split_of(held, slots)))
    within = Window.partitionBy("vslot").orderBy("doc_id", "size", "text_crc32", "rid")
    found = rows.withColumn("nth", F.row_number().over(within) - 1).join(F.broadcast(held.select("vslot", "shard", "base")), "vslot", "left")  # at most slots + shards x HOT x FINE rows a version adds
    shard_ = F.coalesce("shard", F.raise_error(F.concat(F.lit("no shard for slot "), F.col("vslot"))).cast("int"))
    return found.select("doc_id", "size", "text_crc32", shard_.alias("shard"), (F.col("base") + F.col("nth")).cast("long").alias("slot"), "vslot")
