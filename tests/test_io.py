import json
import os

from pyspark.sql import functions as F

from granary.operators import sinks
from granary.plans import pipeline
from granary.sources import corpus, fetch
from granary.streaming import ingest


def test_corpus_files(spark, tmp_path):
    for name, text in {"a.json": '[{"verse_id":"A"},{"x":1}]', "b.json": '{"verse_id":"B"}', "c.json": "5", "d.json": "{broken", "_x.json": "[]", "corpus_statistics.json": "{}", "e.txt": "[]"}.items():
        (tmp_path / name).write_text(text)
    rows, bad = corpus.entries_of(corpus.corpus_files(spark, str(tmp_path)))
    assert sorted((r.file, r.pos, r.label) for r in rows.collect()) == [("a.json", 0, "A"), ("a.json", 1, "entry 1"), ("b.json", 0, "B")]
    assert sorted((r.file, r.message) for r in bad.collect()) == [("c.json", "is neither an array nor an object"), ("d.json", "does not parse as JSON")]
    assert corpus.typed(rows).where("verse_id = 'B'").count() == 1
    assert corpus.pages(spark, f"{tmp_path}/*.txt").first().html == "[]"


def test_keyed_sheet(spark):
    df = spark.createDataFrame([("A", 1, "old", "x"), ("A", 2, "", '["p"]'), ("B", 3, "t", "[broken"), ("", 4, "", "")], "verse_id string, row int, english string, karu string")
    got = {r.verse_id: r for r in corpus.keyed_sheet(df, "verse_id", "row").withColumn("j", F.to_json("karu_json")).collect()}
    assert set(got) == {"A", "B"} and got["A"].english is None and got["A"].j == '["p"]' and (got["B"].j, got["B"].karu) == (None, "[broken")


def test_dictionary(spark):
    words = spark.createDataFrame([("a",), ("b",)], "form string")
    table = spark.createDataFrame([("a", "l", ["d"], "s")], "form string, lemma string, definitions array<string>, source string")
    assert {r.form: len(r.entries) for r in corpus.dictionary(words, table).collect()} == {"a": 1, "b": 0}


def test_fetch(spark):
    waits, tries = [], []

    def flaky(url):
        tries.append(url)
        if url == "gone":
            raise fetch.NotFound
        if len(tries) < 3:
            raise OSError
        return b"<html>" + b"x" * 2000

    assert fetch.get(flaky, "u", pause=waits.append)[0] == "success" and waits == [5.0, 10.0]
    assert fetch.get(flaky, "gone", pause=waits.append)[0] == "not_found" and len(waits) == 2
    m = spark.createDataFrame([("a1.html", "u"), ("a2.html", "v"), ("b.html", "w")], "filename string, url string")
    there = spark.createDataFrame([("a1.html",)], "filename string")
    chosen = fetch.selected(m, fetch.aliased("A", {"a": ["a"]}))
    got = fetch.fetch_all(chosen, there, lambda u: b"tiny", gap=0)
    assert sorted((r.filename, r.status, r.warning) for r in got.collect()) == [("a1.html", "skipped", ""), ("a2.html", "success", "small")]
    assert {r.status: r.n for r in fetch.status_counts(got).collect()} == {"skipped": 1, "success": 1}


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("A", None), ("B", "x")], "verse_id string, english string")
    sinks.write_entries(df, f"{tmp_path}/out", None)
    lines = [json.loads(x) for f in os.listdir(tmp_path / "out") if f.startswith("part") for x in (tmp_path / "out" / f).read_text().splitlines()]
    assert sorted(x["verse_id"] for x in lines) == ["A", "B"] and all("english" in x for x in lines)
    assert sinks.write_report(df.limit(0), f"{tmp_path}/none") is False and not os.path.exists(tmp_path / "none")
    assert sinks.write_report(df, f"{tmp_path}/csv") and [x.count() for x in sinks.split(df, F.col("english") == "x")] == [1, 1]


def posts(spark, *rows):
    return spark.createDataFrame([(t, json.dumps(b) if not isinstance(b, str) else b) for t, b in rows], "at string, body string").withColumn("at", F.to_timestamp("at"))


ROWS = (
    ("2024-01-01 00:00:01", {"text": "Some Text", "annotation": {"verse_id": "A", "english": "old", "karu": ["x"]}}),
    ("2024-01-01 00:00:02", {"action": "annotation", "text": "some_text", "annotation": {"verse_id": "A", "english": None}}),
    ("2024-01-01 00:00:03", {"action": "log", "endpoint": "lookup", "latency_ms": 5, "more": "m"}),
    ("2024-01-01 00:00:04", "broken"),
)


def test_stream_of_posts(spark, tmp_path):
    posts(spark, *ROWS).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("at timestamp, body string").parquet(f"{tmp_path}/in")
    table = ingest.KeyedTable(spark, f"{tmp_path}/table", ["sheet", "verse_id"], "at")
    ingest.stream_upserts(ingest.annotation_rows(ingest.of_action(ingest.routed(stream), "annotation")), table, f"{tmp_path}/c1").awaitTermination()
    got = json.loads(ingest.latest_state(table, "Some Text"))
    assert set(got) == {"A"} and got["A"]["english"] is None and got["A"]["karu"] is None
    assert ingest.latest_state(ingest.KeyedTable(spark, f"{tmp_path}/no", ["k"], "at"), "x") == "{}"
    batch = ingest.annotation_rows(ingest.of_action(ingest.routed(posts(spark, *ROWS[:1])), "annotation"))
    before = table.read().count()
    for _ in range(2):  # an old post, played twice
        table.merge(batch, 9)
    assert table.read().count() == before and json.loads(ingest.latest_state(table, "some text"))["A"]["english"] is None
    ingest.stream_log(ingest.telemetry_rows(ingest.of_action(ingest.routed(stream), "log")), f"{tmp_path}/log", f"{tmp_path}/c2").awaitTermination()
    (row,) = spark.read.parquet(f"{tmp_path}/log").collect()
    assert (row.endpoint, row.latency_ms, row.provider) == ("lookup", "5", "") and json.loads(row.extra_json) == {"action": "log", "more": "m"}
    assert ingest.repaired(spark.createDataFrame([(1, 2)], "a int, z int"), ["a", "b"]).columns == ["a", "b"]


def test_build(spark, tmp_path):
    entry = lambda *xs: spark.createDataFrame([(f"PURN-{n:03d}", "Purananuru", "Sangam", str(n), t, "Puram", e) for n, t, e in xs], "verse_id string, source_text string, layer string, verse_number string, classical_tamil string, akam_or_puram string, english string")

    def broken(s):
        raise FileNotFoundError

    text = pipeline.Text("puram", {"one": lambda s: entry((1, "a b", None), (2, "c d", None)), "two": lambda s: entry((1, "a b", "e"))})
    ref = spark.createDataFrame([(0, "c d", "new")], "idx int, classic string, description string")
    run = pipeline.build(spark, [text, pipeline.Text("other", {"x": broken})], ref, out=str(tmp_path))
    assert {r.verse_id: (r.english, r.modern_tamil) for r in run.entries.collect()} == {"PURN-001": ("e", None), "PURN-002": (None, "new")}
    by = {(r.stage, r.text): r.success for r in pipeline.results(spark, run).collect()}
    assert by[("extract", "puram")] and not by[("extract", "other")] and not run.ok()
    assert run.statistics.where("is_total = 1").first().entries == 2
    again = pipeline.build(spark, [text], out=str(tmp_path), stages=["extract"])
    assert again.results == [("extract", "puram", True, "skipped: output exists")] and again.entries.count() == 2
    assert pipeline.build(spark, [pipeline.Text("new", {"p": broken})], dry=True).results == [("extract", "new", True, "dry run: p")]
    assert pipeline.selected(None, False) == ["extract", "validate", "integrate", "statistics"]
