"""Posts as they come: routing by action, keyed upserts, an append-only log.

The same functions serve batches and streams. An upsert keeps the last row of each key; a batch that
is played again changes nothing, since rows carry their time and its ties are broken."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from granary.functions.text import extras, slug
from granary.operators.dedup import latest_per_key
from granary.sources import shared

# The columns of the two tables.
ANNOTATION_COLUMNS = (
    "verse_id", "source_text", "verse_number", "classical_tamil", "modern_tamil", "english", "thinai", "turai", "akam_or_puram", "karu", "uri",
    "ullurai", "speaker_role", "metre", "pann", "dhvani_layer", "rasa_primary", "rasa_secondary", "themes", "philosophical_concept",
    "cultural_context", "storytelling_seed_narrative", "storytelling_seed_emotional", "nayika_bheda", "visual_imagery", "emotional_valence",
    "annotator", "annotation_confidence", "_updated_at",
)
TELEMETRY_COLUMNS = ("timestamp", "session_id", "endpoint", "provider", "status", "latency_ms", "input_chars", "output_chars", "audio_seconds", "cost_estimate_usd", "verse_id", "extra_json")


def routed(posts: DataFrame, body: str = "body") -> DataFrame:
    """posts (at, body as JSON text) with ``v``, ``action`` and, for annotations, the ``sheet`` they go to."""
    v = posts.withColumn("v", F.try_parse_json(body))
    return v.withColumn("action", F.coalesce(F.try_variant_get("v", "$.action", "string"), F.lit("annotation"))).withColumn("sheet", slug(F.try_variant_get("v", "$.text", "string")))


def of_action(posts: DataFrame, action: str) -> DataFrame:
    return posts.where(F.col("action") == action)


def annotation_rows(posts: DataFrame) -> DataFrame:
    """One row a post: every column as text, arrays and objects as JSON text, nulls as empty text."""
    value = lambda c: F.coalesce(F.try_variant_get("v", f"$.annotation.{c}", "string"), F.lit(""))
    cols = [F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if c == "_updated_at" else value(c).alias(c) for c in ANNOTATION_COLUMNS]
    return posts.select("sheet", "at", *cols).where("verse_id <> ''")


def telemetry_rows(posts: DataFrame, body: str = "body") -> DataFrame:
    """The log's columns; other keys go to ``extra_json``. A post that does not parse gives a row of
    empty texts, since logging never fails its caller."""
    m = F.from_json(F.col(body), "map<string,string>")
    known = [c for c in TELEMETRY_COLUMNS if c not in ("timestamp", "extra_json")]
    return posts.withColumn("_m", m).select(
        F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"), *[F.coalesce(F.col("_m")[c], F.lit("")).alias(c) for c in known], F.coalesce(extras(F.col("_m"), [*TELEMETRY_COLUMNS]), F.lit("")).alias("extra_json")
    )


def upserted(held: DataFrame | None, new: DataFrame, keys: Sequence[str], at: str, ties: Sequence[Column] = ()) -> DataFrame:
    """The last row of each key, whole; a null in it overwrites too."""
    rows = new if held is None else held.unionByName(new, allowMissingColumns=True)
    return latest_per_key(rows, keys, at, ties)


def repaired(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The table with exactly these columns; those it lacks are null, others go."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in columns])


class KeyedTable:
    """A keyed table in buckets of its key's hash, with a log of commits.

    A batch reads and writes only the buckets that it touches, in a folder of its own. A commit is a small numbered file that
    names each bucket's folder and, for each writer, the last of its batches that is in. It is put there only if no other has
    that number: of two writers at once one commits, and the other takes the new state and tries again, so neither loses rows.
    A batch that its writer plays again is in already and changes nothing. The layout (keys, order, number of buckets) is stored
    with the first commit and holds for whoever opens the table later. ``read(before)`` gives the table as it was before a
    commit, for the last ``keep`` commits; folders that none of these names are deleted, those of batches that are still being
    written excepted."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], at: str, ties: Sequence[str] = (), keep: int = 3, buckets: int = 64, writer: str = "writer"):
        self.spark, self.path, self.keep, self.writer = spark, path.rstrip("/"), keep, writer
        self.layout = {"keys": list(keys), "at": at, "ties": list(ties), "buckets": buckets}
        self._opened()

    def _opened(self) -> None:
        fs, file = self._fs("layout.json")
        if fs.exists(file):
            held = json.loads(self._text("layout.json"))
            if held["keys"] != self.layout["keys"]:
                raise ValueError(f"the table's keys are {held['keys']}")
            self.layout = held

    def _fs(self, name: str = ""):
        jvm, hadoop = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        return path.getFileSystem(hadoop), path

    def _text(self, name: str) -> str:
        return self.spark.read.text(f"{self.path}/{name}", wholetext=True).first().value

    def versions(self) -> list[int]:
        fs, root = self._fs("versions")
        return sorted(int(s.getPath().getName().split(".")[0]) for s in fs.listStatus(root) if s.getPath().getName().endswith(".json")) if fs.exists(root) else []

    def _commit(self, version: int) -> dict:
        """buckets: the folder of each; writers: the last batch of each."""
        return json.loads(self._text(f"versions/{version}.json"))

    def _held(self, version: int) -> dict[int, int]:
        """The commit that wrote each bucket last, as of a version."""
        return {int(b): int(f.split("-")[0]) for b, f in self._commit(version)["buckets"].items()}

    def _rows(self, buckets: dict[str, str], only: Sequence[int] | None = None) -> DataFrame | None:
        paths = [f"{self.path}/rows/version={f}/bucket={b}" for b, f in buckets.items() if only is None or int(b) in only]
        return self.spark.read.parquet(*paths) if paths else None

    def read(self, before: int | None = None) -> DataFrame | None:
        found = [v for v in self.versions() if before is None or v < before]
        return self._rows(self._commit(found[-1])["buckets"]) if found else None

    def merge(self, batch: DataFrame, number: int, tries: int = 20) -> bool:
        """Upserts a batch; False if this writer's batch of that number, or a later one, is in already."""
        if not self.versions():
            shared.put_new(self.spark, f"{self.path}/layout.json", json.dumps(self.layout))
            self._opened()
        at, ties = self.layout["at"], [F.col(t) for t in self.layout["ties"]]
        bucket = F.pmod(F.xxhash64(*self.layout["keys"]), F.lit(self.layout["buckets"])).cast("int")
        # What counts of a batch is its last row of each key; it is worked out once, however often it is needed here.
        batch = upserted(None, batch, self.layout["keys"], at, ties).persist(StorageLevel.DISK_ONLY)
        try:
            return self._merged(batch, number, tries, bucket, at, ties)
        finally:
            batch.unpersist()

    def _merged(self, batch: DataFrame, number: int, tries: int, bucket: Column, at: str, ties: list[Column]) -> bool:
        touched = sorted(r.b for r in batch.select(bucket.alias("b")).distinct().collect())  # at most ``buckets``
        for _ in range(tries):
            last = max(self.versions(), default=-1)
            held = self._commit(last) if last >= 0 else {"buckets": {}, "writers": {}}
            if held["writers"].get(self.writer, -1) >= number:
                return False
            folder = f"{last + 1}-{uuid.uuid4().hex[:12]}"
            if touched:
                out = upserted(self._rows(held["buckets"], touched), batch, self.layout["keys"], at, ties)
                files = max(1, self.spark.sparkContext.defaultParallelism // self.layout["buckets"])  # few buckets are written by all cores
                share = F.pmod(F.xxhash64(*self.layout["keys"], F.lit(1)), F.lit(files))
                out.withColumn("bucket", bucket).repartition("bucket", share).write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/rows/version={folder}")
            now = {"buckets": held["buckets"] | {str(b): folder for b in touched}, "writers": held["writers"] | {self.writer: number}}
            if shared.put_new(self.spark, f"{self.path}/versions/{last + 1}.json", json.dumps(now)):
                self._forget()
                return True
            shared.delete(self.spark, f"{self.path}/rows/version={folder}")
        raise RuntimeError(f"other writers committed first {tries} times")

    def _forget(self) -> None:
        """Deletes commits beyond the last ``keep``, and buckets that none of those names. Folders of the next number may be
        another writer's that has not committed yet."""
        versions = self.versions()
        for v in versions[: -self.keep]:
            shared.delete(self.spark, f"{self.path}/versions/{v}.json")
        named = {(int(b), f) for n in versions[-self.keep :] for b, f in self._commit(n)["buckets"].items()}
        fs, root = self._fs("rows")
        for folder in fs.listStatus(root) if fs.exists(root) else []:
            name = folder.getPath().getName().split("=")[1]
            if int(name.split("-")[0]) >= versions[-1]:
                continue
            for part in fs.listStatus(folder.getPath()):
                bucket = part.getPath().getName()
                if bucket.startswith("bucket=") and (int(bucket.split("=")[1]), name) not in named:
                    fs.delete(part.getPath(), True)


def stream_upserts(stream: DataFrame, table: KeyedTable, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, n: table.merge(df, n))
    return (w.trigger(availableNow=True) if available_now else w).start()


def stream_log(stream: DataFrame, path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Appends to a Parquet table; exactly once, by the sink's own log of files."""
    w = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w).start()


def tumbling(stream: DataFrame, at: str, length: str, by: Sequence[str], late: str = "10 minutes") -> DataFrame:
    """An extension: counts in windows of time, rows later than ``late`` left out."""
    return stream.withWatermark(at, late).groupBy(F.window(at, length), *by).agg(F.count("*").alias("n")).select("window.start", "window.end", *by, "n")


def state_rows(table: KeyedTable, sheet: str) -> DataFrame:
    """verse_id and json (empty texts as null) of a sheet's annotations, as rows."""
    held = table.read()
    if held is None:
        return table.spark.createDataFrame([], "verse_id string, json string")
    rows = held.where(F.col("sheet") == slug(F.lit(sheet)))
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) if kind == "string" else F.col(c) for c, kind in rows.dtypes if c not in ("sheet", "at")]
    return rows.select("verse_id", F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("json"))


def latest_state(table: KeyedTable, sheet: str) -> str:
    """The read end point: the sheet's annotations by id as one JSON text, ``{}`` if there are none. The answer to one request;
    ``state_rows`` has them as a table."""
    return json.dumps({r.verse_id: json.loads(r.json) for r in state_rows(table, sheet).collect()}, ensure_ascii=False)  # one text's annotations


def posted_once(stream: DataFrame, keys: Sequence[str], at: str, late: str = "1 hour") -> DataFrame:
    """The first post of each key within ``late`` of time: a post that comes again is dropped, and its key is forgotten once the
    watermark has passed it. Posts that are later than the watermark are dropped, too."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark(list(keys))


def answered(asked: DataFrame, log: DataFrame, on: Sequence[str], asked_at: str, log_at: str, within: str, late: str | None = "1 hour") -> DataFrame:
    """Each post with each log row of the same keys that came at its time or up to ``within`` after; as streams or tables. Both
    sides are kept in state only as long as a partner may still come: watermarks and the interval bound it. Rows later than the
    watermark find no partner. Sides that have a watermark already (``posted_once``) take ``late`` None. Key columns come once,
    ``log``'s other names must differ."""
    a, b = (asked, log) if late is None else (asked.withWatermark(asked_at, late), log.withWatermark(log_at, late))
    same = F.expr("true")
    for k in on:
        same = same & (F.col(f"_a.{k}") == F.col(f"_b.{k}"))
    span = (F.col(f"_b.{log_at}") >= F.col(f"_a.{asked_at}")) & (F.col(f"_b.{log_at}") <= F.col(f"_a.{asked_at}") + F.expr(f"INTERVAL {within}"))
    return a.alias("_a").join(b.alias("_b"), same & span).select("_a.*", *[F.col(f"_b.{c}") for c in log.columns if c not in on])


def handler(actions: dict[str, Callable[[DataFrame], None]]) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that gives each action's posts to its own handler; the batch is kept
    while they run."""

    def run(batch: DataFrame, _: int) -> None:
        posts = routed(batch).persist()
        try:
            for action, f in actions.items():
                f(of_action(posts, action))
        finally:
            posts.unpersist()

    return run
