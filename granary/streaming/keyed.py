"""Keyed state: the last row of each key held by the stream itself, and a feed of what changes.

``transformWithState`` keeps the last row of each key in the state store. A post that is later than the held row (by
time, then ties) takes its place and goes out as a change; one that is not later changes nothing, so replays and late
posts leave the same rows whatever order they come in. The feed is appended, and the table is the last change of each key
(``current``). The store is kept by Spark in the checkpoint and moves with its partition.

A call to the store from Python costs far more than a row, so keys stand in ``buckets`` by their hash: a batch reads and
writes the list of a bucket that it touches at once, a few calls whatever number of keys it has. The number of buckets
is the checkpoint's: a query that goes on from one needs the same.

With ``idle``, a key that has had no later row for that long by the watermark goes out as expired and its state is freed.
A bucket has one timer, no later than its first key is due. Rows older than the watermark (``late`` behind the latest time)
are dropped before they reach the state.

Defined results: rows with a null key are left out; a null time or tie is earlier than any other; of rows that tie in time
and ties the first to come stays; an empty batch changes nothing.
"""

from __future__ import annotations

import contextlib
from collections.abc import Iterable, Iterator, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from granary.operators.dedup import latest_per_key

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


BUCKETS = 4096


def comparable(v):
    """A key's value as one that is equal and hashes equal where Spark groups alike (NaN is NaN)."""
    if isinstance(v, (list, tuple)):
        return tuple(map(comparable, v))
    if isinstance(v, bytearray):
        return bytes(v)
    return "NaN" if v != v else v


class LastRow(StatefulProcessor):
    """The last rows of a bucket's keys, by their time in microseconds (the last column) and ``ties``."""

    def __init__(self, schema: T.StructType, keys: Sequence[str], ties: Sequence[str], idle_ms: int | None):
        self.columns, self.schema, self.idle_ms = [f.name for f in schema], schema, idle_ms
        self.keys, self.order = [self.columns.index(k) for k in keys], [len(self.columns) - 1, *(self.columns.index(t) for t in ties)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getListState("rows", self.schema)

    def _key(self, row: tuple) -> tuple:
        return tuple(comparable(row[k]) for k in self.keys)

    def _rank(self, row: tuple) -> tuple:
        return tuple((True, row[k]) if row[k] is not None else (False,) for k in self.order)

    def _due(self, row: tuple) -> int | None:
        return None if self.idle_ms is None or row[-1] is None else row[-1] // 1000 + self.idle_ms

    def _out(self, row: tuple, change: str) -> Row:
        return Row(**dict(zip(self.columns[:-1], row)), change=change)

    def _wake(self, rows: Iterable[tuple]) -> None:
        """A timer no later than the first of these rows is due."""
        first = min((d for d in map(self._due, rows) if d is not None), default=None)
        if first is not None and first < min(self.handle.listTimers(), default=first + 1):
            self.handle.registerTimer(first)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        held = {self._key(row): row for row in self.held.get()}
        new: dict[tuple, tuple] = {}
        ranks: dict[tuple, tuple] = {}
        places = None
        for row in rows:
            places = places or [row.__fields__.index(c) for c in self.columns]
            row = tuple(row)
            row = tuple([row[k] for k in places])
            k, rank = self._key(row), self._rank(row)
            if k not in ranks:
                ranks[k] = self._rank(held[k]) if k in held else ()
            if rank > ranks[k]:
                new[k], ranks[k] = row, rank
        if new:
            out = [self._out(row, "update" if k in held else "insert") for k, row in new.items()]
            self.held.put([*(held | new).values()])
            if self.idle_ms is not None:
                self._wake(new.values())
            yield from out

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held, now = [*self.held.get()], timerValues.getCurrentWatermarkInMs()
        gone = [row for row in held if (due := self._due(row)) is not None and due <= now]
        if gone:
            left = [row for row in held if (due := self._due(row)) is None or due > now]
            self.held.put(left) if left else self.held.clear()
            held = left
        # The timer that has come goes only after this call.
        first = min((d for d in map(self._due, held) if d is not None), default=None)
        if first is not None:
            self.handle.registerTimer(first)
        yield from (self._out(row, "expire") for row in gone)

    def close(self) -> None:
        pass


def changes(stream: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str] = (), idle: str | None = None, late: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """The rows of the stream that take a key's place, with ``change``: insert, update or expire."""
    start = "timestamp'1970-01-01 00:00:00'"
    idle_ms = None if idle is None else stream.sparkSession.sql(f"SELECT unix_millis({start} + INTERVAL {idle}) - unix_millis({start})").first()[0]
    micros = next(n for n in (f"_us{k or ''}" for k in range(99)) if n not in stream.columns)
    rows = (stream if idle is None else stream.withWatermark(at, late)).dropna(subset=list(keys)).withColumn(micros, F.unix_micros(at))
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in rows.schema])
    out = T.StructType([*schema.fields[:-1], T.StructField("change", T.StringType())])
    bucket = next(n for n in (f"_bucket{k or ''}" for k in range(99)) if n not in stream.columns)
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    return dealt.groupBy(bucket).transformWithState(LastRow(schema, keys, ties, idle_ms), out, "Append", "none" if idle is None else "eventTime")


@contextlib.contextmanager
def rocksdb(spark: SparkSession):
    """The state store that keyed state needs, while a query is started; the session's own setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)


def stream_changes(stream: DataFrame, path: str, checkpoint: str, keys: Sequence[str], at: str, ties: Sequence[str] = (), idle: str | None = None, late: str = "0 seconds", available_now: bool = True, buckets: int = BUCKETS) -> StreamingQuery:
    """Appends the feed of changes to a Parquet table, exactly once by the sink's own log of files."""
    with rocksdb(stream.sparkSession):
        w = changes(stream, keys, at, ties, idle, late, buckets).writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if available_now else w).start()


def current(feed: DataFrame, keys: Sequence[str], at: str, ties: Sequence[str] = ()) -> DataFrame:
    """The table that a feed stands for: each key's last change, without expired ones."""
    rows = feed.withColumn("_gone", F.col("change") == "expire")
    return latest_per_key(rows, keys, at, [*[F.desc(t) for t in ties], F.desc("_gone")]).where("not _gone").drop("_gone", "change")
