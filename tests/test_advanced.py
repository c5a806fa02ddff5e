"""Long keys, keyed state, data sources, parser plug-ins."""

import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from granary.operators import lookups, plugins
from granary.operators.longkeys import Stretches
from granary.sources import hub, shared
from granary.streaming import keyed


def rows_of(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.fixture(scope="module")
def long_rows(spark):
    rng = random.Random(1)
    rows = []
    for k in range(3000):
        by = rng.choice(["a", "a", "a", "b", None, f"k{k % 50}"])
        rows.append((by, rng.randrange(900) if k % 97 else None, k, rng.randrange(9) if rng.random() < 0.05 else None))
    rows += [("hot", 7, 5000 + k, None) for k in range(400)]  # one place that cannot be cut
    return spark.createDataFrame(rows, "by string, at int, id int, number int").cache()


@pytest.mark.parametrize("by", [["by"], []])
def test_stretches_equal_plain_windows(long_rows, by):
    cut, w = Stretches(long_rows, by, "at", 100), Window.partitionBy(*by).orderBy("at", "id")
    assert cut.long and cut.rows.select(cut.column).distinct().count() > 5
    order = ["at", "id"]
    got = cut.last("number", order, "seen").last("number", order, "known", inclusive=False).running_sum(None, order, "n").neighbour("id", order, "before").neighbour("id", order, "after", after=True).table
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    want = long_rows.select("*", F.last("number", True).over(run).alias("seen"), F.last("number", True).over(w.rowsBetween(Window.unboundedPreceding, -1)).alias("known"), F.row_number().over(w).alias("n"), F.lag("id").over(w).alias("before"), F.lead("id").over(w).alias("after"))
    assert rows_of(got.select(want.columns)) == rows_of(want)


def test_short_keys_keep_the_plain_window(long_rows):
    cut = Stretches(long_rows, ["by"], "at", 100_000)
    assert not cut.long and rows_of(cut.running_sum(None, ["at", "id"], "n").table.select("id", "n")) == rows_of(lookups.numbered(long_rows, ["by"], ["at", "id"]).select("id", "n"))
    assert Stretches(long_rows.limit(0), ["by"], "at", 1).last("number", ["at"], "x").table.count() == 0


def test_look_ups_with_long_keys(spark, long_rows):
    rows = long_rows.where("at is not null").withColumn("place", F.col("at") * 10_000 + F.col("id"))
    right = spark.range(200).selectExpr("CASE WHEN id % 2 = 0 THEN 'a' ELSE 'b' END AS by", "CAST(id * 41000 AS INT) AS start", "id AS title", "CASE WHEN id % 3 = 0 THEN id END AS may")
    for strict in (False, True):
        plain, cut = (lookups.as_of(rows, right, ["by"], "place", "start", ["title", "may"], strict, long=n) for n in (None, 50))
        assert rows_of(plain) == rows_of(cut)
    for f in (
        lambda n: lookups.previous_plus_one(rows, ["by"], "place", "number", 7, long=n),
        lambda n: lookups.segments(rows, ["by"], "place", F.lit(-1), long=n),
        lambda n: lookups.gap_clusters(rows, ["by"], F.col("place") / 10, "place", 900, long=n),
        lambda n: lookups.numbered(rows, ["by"], ["place"], long=n),
    ):
        plain = f(None)
        assert rows_of(plain) == rows_of(f(60).select(plain.columns))


def test_one_long_key_runs_in_many_tasks(spark):
    page = spark.range(200_000, numPartitions=4).selectExpr("id AS at", "CASE WHEN id % 1000 = 0 THEN id END AS number")
    cut = Stretches(page, [], "at", 20_000).last("number", ["at"], "seen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [r.n for r in cut.rows.groupBy(F.spark_partition_id(), cut.column).agg(F.count("*").alias("n")).collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(sizes) >= 10 and max(sizes) < 40_000
    assert cut.table.where("seen <> at - at % 1000").count() == 0


EVENT = "k string, at timestamp, tie int, v string"


def replayed(spark, batches, **how):
    path = shared.fresh(spark, "test-posts")
    for n, rows in enumerate(batches):
        spark.createDataFrame(rows, EVENT).coalesce(1).write.parquet(f"{path}/b{n}")
    stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{path}/*")
    feed = shared.fresh(spark, "test-feed")
    for _ in range(2):  # started again, it goes on from its checkpoint and adds nothing
        keyed.stream_changes(stream, feed, f"{feed}-checkpoint", ["k"], "at", ["tie"], **how).awaitTermination()
    return spark.read.parquet(feed)


def test_replays_and_late_posts_leave_the_same_rows(spark):
    from datetime import datetime as D

    day = lambda n: D(2024, 1, n)
    first = [("a", day(1), 1, "old"), ("a", day(5), 1, "new"), ("b", day(2), 1, "x"), (None, day(9), 1, "no key"), ("c", None, 1, "no time")]
    second = [("a", day(5), 2, "tie wins"), ("a", day(3), 9, "late"), ("b", day(2), 1, "same again"), ("d", day(1), None, "d"), ("c", day(1), None, "timed")]
    want = [Row(k="a", at=day(5), tie=2, v="tie wins"), Row(k="b", at=day(2), tie=1, v="x"), Row(k="c", at=day(1), tie=None, v="timed"), Row(k="d", at=day(1), tie=None, v="d")]
    feed = replayed(spark, [first, second, first])
    assert keyed.current(feed, ["k"], "at", ["tie"]).orderBy("k").collect() == want
    assert rows_of(feed.where("change = 'insert'").select("k")) == ["('a',)", "('b',)", "('c',)", "('d',)"]
    assert feed.where("change = 'update'").count() == 2  # a replay changes nothing
    other = replayed(spark, [second, first])
    assert keyed.current(other, ["k"], "at", ["tie"]).where("k <> 'b'").orderBy("k").collect() == [want[0], *want[2:]]


def test_idle_keys_expire(spark):
    from datetime import datetime as D

    batches = [[("a", D(2024, 1, 1), 1, "x"), ("b", D(2024, 1, 1), 1, "x")], [("b", D(2024, 1, 3), 1, "y")], [("c", D(2024, 1, 4), 1, "z")], [("a", D(2023, 12, 1), 1, "too late"), ("c", D(2024, 1, 4, 1), 1, "z")]]
    feed = replayed(spark, batches, idle="2 DAYS")
    assert [r.k for r in keyed.current(feed, ["k"], "at", ["tie"]).orderBy("k").collect()] == ["b", "c"]
    assert [(r.k, r.v) for r in feed.where("change = 'expire'").collect()] == [("a", "x")]
    assert feed.where("v = 'too late'").count() == 0
    assert spark.conf.get(keyed.PROVIDER, "") != keyed.ROCKSDB


def test_splits_are_read_in_chunks_and_filters_are_pushed(spark, tmp_path):
    rng = random.Random(2)
    want = []
    for split in ("train", "test"):
        (tmp_path / split).mkdir()
        for part in range(2):
            lines = [json.dumps({"n": k, "t": rng.choice(["Ä" * rng.randrange(40), "MIT", ""])}, ensure_ascii=False) for k in range(50)]
            (tmp_path / split / f"part-{part}.json").write_text("\n".join(lines) + "\n" * (part == 0), encoding="utf-8")
            want += [(split, f"part-{part}.json", line) for line in lines]
    (tmp_path / "_hidden.json").write_text("{}")
    (tmp_path / "extra-1.jsonl").write_text('{"x": 1}\r\n\n{"x": 2}')
    want += [("extra", "extra-1.jsonl", '{"x": 1}'), ("extra", "extra-1.jsonl", '{"x": 2}')]
    hub.register(spark)
    for chunk in (211, 1 << 20):
        rows = spark.read.format("granary_splits").option("path", str(tmp_path)).option("chunk", chunk).load()
        assert rows_of(rows.select("split", "file", "json")) == sorted(map(str, want))
    load = lambda **o: spark.read.format("granary_splits").options(path=str(tmp_path), **o).load()
    plain = load()
    assert plain.where("split = 'test'").count() == 100 and plain.where("split = 'none'").count() == 0 and plain.count() == len(want)
    some = load(pushdown="true").where("split = 'test' AND json LIKE '%MIT%' AND offset > 0")
    assert rows_of(some.select("json")) == sorted(str((j,)) for s, f, j in want if s == "test" and "MIT" in j and not j.startswith('{"n": 0,'))
    assert some.rdd.getNumPartitions() == 2 and plain.rdd.getNumPartitions() == 5 and load(split="train,extra").rdd.getNumPartitions() == 3
    assert load(file="part-1.json").count() == 100 and load(split="none").count() == 0
    assert spark.read.format("granary_splits").options(path=str(tmp_path), contains="mit").load().count() == sum("mit" in j.lower() for _, _, j in want)


def answer(url):
    if "gone" in url:
        from granary.sources.fetch import NotFound

        raise NotFound
    if "down" in url:
        raise OSError
    return b"<html>" + url.encode().ljust(1000)


def test_a_task_for_each_host(spark, tmp_path):
    urls = [f"http://h{k % 3}.org/{k}" for k in range(9)] + ["http://h0.org/gone", "https://x.net:8080/down"]
    (tmp_path / "m.json").write_text("\n".join(json.dumps({"filename": f"f{k}", "url": u}) for k, u in enumerate(urls)))
    hub.register(spark)
    got = spark.read.format("granary_fetch").options(path=str(tmp_path), fetcher="tests.test_advanced:answer", gap="0", wait="0").load()
    assert got.rdd.getNumPartitions() == 4
    assert sorted((r.host, r.status, r["count"]) for r in got.groupBy("host", "status").count().collect()) == [("h0.org", "not_found", 1), ("h0.org", "success", 3), ("h1.org", "success", 3), ("h2.org", "success", 3), ("x.net", "failed", 1)]
    one = spark.read.format("granary_fetch").options(path=str(tmp_path), fetcher="tests.test_advanced:answer", gap="0", pushdown="true").load().where("host = 'h1.org'")
    assert one.rdd.getNumPartitions() == 1 and one.count() == 3


def test_plug_ins_carry_over_pages_and_name_their_columns(spark):
    pages = spark.createDataFrame([("x", 2, "<p>c &amp; d<p>e"), ("x", 1, "<h2>One</h2><p>a</p><ul><li>b</ul><h3>Two</h3>"), ("y", 1, "<p>z"), ("x", 3, None)], "file string, page long, html string")
    got = plugins.parsed(pages, "headed")
    assert got.columns == ["file", "page", "block", "heading", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([("x", 1, 1, "One", "a"), ("x", 1, 2, "One", "b"), ("x", 2, 1, "Two", "c & d"), ("x", 2, 2, "Two", "e"), ("y", 1, 1, None, "z")], key=str)
    texts = pages.select("file", "page", F.lit("l1\n---\n l2").alias("text"))
    assert plugins.parsed(texts, "numbered").agg(F.max("number")).first()[0] == 6
    with pytest.raises(Exception, match="needs the columns"):
        plugins.parsed(pages, "numbered").collect()
    with pytest.raises(Exception, match="no parser"):
        plugins.parsed(pages, "nothing").collect()


def test_two_writers_lose_nothing_and_the_layout_is_stored(spark, monkeypatch):
    from granary.streaming import ingest

    path = shared.fresh(spark, "commits")
    frame = lambda rows: spark.createDataFrame(rows, "k int, at int, v string")
    one = ingest.KeyedTable(spark, path, ["k"], "at", ["v"], buckets=4, writer="one")
    assert one.merge(frame([(k, 0, "a") for k in range(20)]), 0)
    two = ingest.KeyedTable(spark, path, ["k"], "at", ["v"], buckets=64, writer="two")
    assert two.layout["buckets"] == 4
    with pytest.raises(ValueError):
        ingest.KeyedTable(spark, path, ["v"], "at")
    real, raced = shared.put_new, []

    def slow(session, where, text):  # the other writer commits first, once
        if "versions" in where and not raced:
            raced.append(where)
            assert two.merge(frame([(3, 5, "two"), (100, 0, "two")]), 0)
        return real(session, where, text)

    monkeypatch.setattr(shared, "put_new", slow)
    assert one.merge(frame([(3, 4, "one"), (101, 0, "one")]), 1)
    assert {r.k: r.v for r in one.read().collect()} == {k: "two" if k == 3 else "a" for k in range(20)} | {100: "two", 101: "one"}
    assert two.versions() == [0, 1, 2] and not one.merge(frame([(3, 9, "again")]), 1) and not two.merge(frame([(3, 9, "again")]), 0)
    assert two.read(1).count() == 20 and two.read(2).count() == 21


def test_posts_once_and_answers_within_an_interval(spark):
    from granary.streaming import ingest

    posts = spark.sql("SELECT * FROM VALUES (1, 'u', timestamp'2024-01-01 10:00:00'), (2, 'u', timestamp'2024-01-01 11:00:00'), (3, null, timestamp'2024-01-01 11:00:00') AS t(post, user, at)")
    log = spark.sql("SELECT * FROM VALUES (7, 'u', timestamp'2024-01-01 11:30:00'), (8, 'u', timestamp'2024-01-01 09:59:59'), (9, null, timestamp'2024-01-01 11:00:00'), (10, 'u', timestamp'2024-01-01 12:00:00') AS t(row, user, seen)")
    got = ingest.answered(posts, log, ["user"], "at", "seen", "1 HOUR", None)
    assert got.columns == ["post", "user", "at", "row", "seen"] and rows_of(got.select("post", "row")) == ["(2, 10)", "(2, 7)"]


def stamped(prompt):
    import os
    import time

    where, n = prompt.split("|")
    with open(os.path.join(where, n), "w") as f:
        f.write(str(time.time()))
    return n


def test_a_host_is_asked_at_its_rate_by_all_tasks_together(spark, tmp_path):
    from granary.operators import annotate

    rows = [(k, "slow" if k % 2 else "fast", f"{tmp_path}|{k}") for k in range(60)] + [(99, "slow", None), (100, None, f"{tmp_path}|100")]
    df = spark.createDataFrame(rows, "id int, host string, prompt string")
    got = {r.id: r for r in annotate.paced(df, stamped, ["id"], "host", {"slow": 20.0, "fast": 200.0}, rate=100.0, lanes=4).collect()}
    assert len(got) == 62 and got[99].answer is None and got[99].tries == 0 and got[5].answer == "5" and got[100].answer == "100"
    times = sorted(float((tmp_path / str(k)).read_text()) for k in range(1, 60, 2))
    # Of 30 requests at 20 a second those after the lanes' first ones take a second at least; no second holds more than 20 and the lanes.
    assert all(sum(t <= u < t + 1 for u in times) <= 24 for t in times)


def test_rules_of_a_schema_file(spark, tmp_path):
    import dataclasses

    from granary.operators import schema, validate

    path = shared.put(spark, f"{tmp_path}/schema.json", schema.document())
    assert schema.read(spark, path) == schema.RULES
    open_ = schema.read(spark, shared.put(spark, f"{tmp_path}/open.json", schema.document(dataclasses.replace(schema.RULES, closed=False, comments={}))))
    entry = spark.createDataFrame([("f", "l", '{"verse_id": "AKAM-0001", "source_text": "Akananuru", "layer": "Sangam", "verse_number": "1", "classical_tamil": "x", "akam_or_puram": "Puram", "more": 1}')], "file string, label string, json string")
    assert [r.message for r in validate.errors(entry).collect()] == ["is not an allowed property"] and validate.errors(entry, rules=open_).count() == 0
    with pytest.raises(ValueError, match="format cannot be checked"):
        schema.read(spark, shared.put(spark, f"{tmp_path}/odd.json", '{"properties": {"x": {"type": "string", "format": "date"}}}'))


ASKED = []


def answering(prompt):
    from granary.operators import annotate

    ASKED.append(prompt)
    if "gamma" in prompt:
        raise annotate.Failed(400)
    return 'Here: {"thinai": "Palai"}'


def test_annotate_and_fetch_commands(spark, tmp_path):
    from granary import __main__ as commands

    entry = lambda k, t, thinai: {"verse_id": f"AKAM-000{k}", "source_text": "Akananuru", "layer": "Sangam", "verse_number": str(k), "classical_tamil": t, "akam_or_puram": "Akam", "thinai": thinai}
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(json.dumps([entry(1, "alpha", None), entry(2, "beta", "Mullai"), entry(3, "gamma", None)]))
    out = f"{tmp_path}/out"
    assert commands.run(spark, ["annotate", f"{tmp_path}/in", "--client", "tests.test_advanced:answering", "--out", out, "--dry-run"]) == 0
    assert commands.run(spark, ["annotate", f"{tmp_path}/in", "--client", "tests.test_advanced:answering", "--out", out, "--delay", "0"]) == 1
    assert {(r.verse_id, r.thinai) for r in spark.read.json(f"{out}_annotated").collect()} == {("AKAM-0001", "Palai"), ("AKAM-0002", "Palai"), ("AKAM-0003", None)}
    assert [(r.verse_id, r.reason) for r in spark.read.json(f"{out}_failed").collect()] == [("AKAM-0003", "no answer")]
    (tmp_path / "m").mkdir()
    (tmp_path / "m" / "m.json").write_text(json.dumps({"filename": "a", "url": "http://h.org/a"}) + "\n" + json.dumps({"filename": "b", "url": "http://h.org/gone"}))
    args = ["fetch", f"{tmp_path}/m", "--fetcher", "tests.test_advanced:answer", "--out", f"{tmp_path}/got", "--gap", "0"]
    assert commands.run(spark, [*args, "--dry-run"]) == 0 and commands.run(spark, args) == 0
    assert {(r.filename, r.status) for r in spark.read.parquet(f"{tmp_path}/got").collect()} == {("a", "success"), ("b", "not_found")}


def test_many_keys_cost_few_calls_to_the_store(spark, monkeypatch):
    """r2_keyed_state, r2_expiring_state: several calls were made for each key and batch."""
    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("x", T.DoubleType()), T.StructField("_us", T.LongType())])

    class Store:
        def __init__(self):
            self.rows, self.timers, self.calls = [], [], 0

        def getListState(self, name, schema):
            return self

        def get(self):
            self.calls += 1
            return iter(self.rows)

        def put(self, rows):
            self.calls += 1
            self.rows = rows

        def clear(self):
            self.put([])

        def listTimers(self):
            self.calls += 1
            return iter(self.timers)

        def registerTimer(self, at):
            self.calls += 1
            self.timers.append(at)

        def getCurrentWatermarkInMs(self):
            return 10 + 2000

    last, store = keyed.LastRow(schema, ["k", "x"], [], 2000), Store()
    last.init(store)
    nan = lambda: float("nan")
    post = lambda rows: [(r.k, r.change) for r in last.handleInputRows((0,), iter([Row(_bucket=0, _us=us, k=k, x=x) for k, x, us in rows]), store)]
    assert len(post([(str(n), 1.0, n * 1000) for n in range(1000)])) == 1000
    assert post([("5", 1.0, 5000), ("7", 1.0, 900_000), ("7", 1.0, 800_000), ("7", nan(), 1), ("7", nan(), 2_000_000), ("n", 0.0, None)]) == [("7", "update"), ("7", "insert"), ("n", "insert")]
    assert store.timers == [2000] and store.calls <= 10
    gone = [r.k for r in last.handleExpiredTimer((0,), store, None)]
    assert gone == [str(n) for n in range(11) if n != 7] and store.timers == [2000, 2011] and len(store.rows) == 992 and store.calls <= 15


def test_buckets_of_many_keys_expire(spark):
    from datetime import datetime as D

    batches = [[(f"k{n}", D(2024, 1, 1, n % 24), 1, "x") for n in range(400)], [(f"k{n}", D(2024, 1, 2), 1, "y") for n in range(0, 400, 2)], [("c", D(2024, 1, 3, 12), 1, "z")]]
    feed = replayed(spark, batches, idle="2 DAYS", buckets=3)
    left = {r.k: r.v for r in keyed.current(feed, ["k"], "at", ["tie"]).collect()}
    assert left == {"c": "z"} | {f"k{n}": "y" for n in range(0, 400, 2)} | {f"k{n}": "x" for n in range(1, 400, 2) if n % 24 > 12}
    assert feed.where("change = 'expire'").count() == len([n for n in range(1, 400, 2) if n % 24 <= 12])
