"""Hot keys, wide ranges and large dimensions: the same results as plain ways, in plans that hold."""

import json
import random

import pytest
from pyspark.sql import functions as F

from granary import __main__ as commands
from granary.operators import contain, lookups, match
from granary.sources import shared
from granary.streaming import ingest


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_text_or_line_that_fills_a_third_of_the_rows_gives_one_candidate_each(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice(["same text here", f"one line\n{'x ' * rng.randint(1, 60)}{i}", f"other {i} words"])) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, text string")
    f = match.features(df, "id", "text")
    assert match.equal_texts(f, f, True).count() <= 300 and match.equal_lines(f, f, True).count() <= 300
    got = sorted(tuple(r) for r in match.best_matches(df, df, "id", "id", "text", "text", same_id=True).collect())
    assert got == sorted(tuple(r) for r in match.brute_force(df, df, "id", "id", "text", "text", same_id=True).collect())


def test_ranges_keep_repeated_rows_without_a_join(spark, monkeypatch):
    v = spark.createDataFrame([(5,), (5,), (None,), (40,)], "v int")
    ranges = spark.createDataFrame([(k, 10 * k, 10 * k + 12, f"r{k}") for k in range(30)], "ord int, start int, end int, label string")
    got = lookups.first_range(v, "v", ranges)
    want = [(None, None), (5, "r0"), (5, "r0"), (40, "r3")]
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want and "Join" not in plan_of(got) and "Exchange" not in plan_of(got)
    monkeypatch.setattr(lookups, "RANGES", 3)
    got = lookups.first_range(v, "v", ranges)
    assert sorted((tuple(r) for r in got.collect()), key=key) == want and "NestedLoop" not in plan_of(got)
    assert lookups.first_range(v, "v", ranges.limit(0)).where("label is not null").count() == 0


def test_wide_gaps_are_listed_in_stretches(spark, monkeypatch):
    monkeypatch.setattr(lookups, "STRETCH", 7)
    g = spark.createDataFrame([("a", 1), ("a", 100), ("a", 100), ("b", None), ("b", 4)], "k string, n int")
    got = lookups.sequence_gaps(g, ["k"], "n")
    assert sorted(r.n for r in got.collect()) == list(range(2, 100)) and dict(got.dtypes)["n"] == "int"


def test_dimensions_are_broadcast_by_their_size(spark):
    d = spark.range(50).select("id", F.col("id").cast("string").alias("name"))
    assert "BroadcastHashJoin" in plan_of(lookups.enrich(spark.range(10), d, "id"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Broadcast" not in plan_of(lookups.enrich(spark.range(10), d, "id", most=10))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    asked = spark.createDataFrame([("a.json",), ("../b",), (None,)], "path string")
    listed = spark.createDataFrame([("a.json",), ("a.json",)], "file string")
    assert sorted((str(r.path), r.open) for r in lookups.guarded(asked, "path", listed, "file").collect()) == [("../b", False), ("None", False), ("a.json", True)]


@pytest.mark.parametrize(("most", "few"), [(contain.ITEMS, 0), (0, 0), (0, 1000)])
def test_items_by_one_automaton_or_by_joins(spark, monkeypatch, most, few):
    monkeypatch.setattr(contain, "FEW", few)
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["alpha", "beta", "go", "x", "delta"]) for _ in range(6))) for i in range(60)] + [(99, None), (98, "")]
    items = [(1, "x"), (2, "go"), (3, "beta go"), (4, "ta"), (5, ""), (6, None), (7, "zz"), (8, "alpha beta x")]
    d, i = spark.createDataFrame(docs, "doc_id int, text string"), spark.createDataFrame(items, "item_id int, text string")
    got = sorted(tuple(r) for r in contain.contained(d, i, "doc_id", "item_id", "text", most).collect())
    assert got == sorted((a, b) for a, t in docs for b, u in items if t and u and u in t)


def test_a_batch_writes_only_its_buckets(spark):
    t = ingest.KeyedTable(spark, shared.fresh(spark, "keyed"), ["k"], "at", ["v"], keep=2, buckets=8)
    frame = lambda rows: spark.createDataFrame(rows, "k int, at int, v string")
    assert t.read() is None
    t.merge(frame([(i, 0, "a") for i in range(100)]), 0)
    t.merge(frame([(3, 1, "b")]), 1)
    assert len([b for b, v in t._held(1).items() if v == 1]) == 1
    t.merge(frame([(3, 1, "b")]), 1)  # played again
    t.merge(frame([]), 2)
    t.merge(frame([(200, 0, "c"), (4, -1, "late")]), 3)
    got = {r.k: r.v for r in t.read().collect()}
    assert got == {i: "b" if i == 3 else "a" for i in range(100)} | {200: "c"}
    assert t.versions() == [2, 3] and t.read(3).count() == 100


def test_command_lines(spark, tmp_path):
    good = {"verse_id": "PURN-001", "source_text": "Purananuru", "layer": "Sangam", "verse_number": "1", "classical_tamil": "one two three", "akam_or_puram": "Puram"}
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps([good]))
    (tmp_path / "ref.txt").write_text(json.dumps({"idx": 7, "classic": "one two three", "description": "d"}))
    assert commands.run(spark, ["validate", str(folder)]) == 0 and commands.run(spark, ["statistics", str(folder)]) == 0
    out = f"{tmp_path}/out"
    assert commands.run(spark, ["match", str(folder), "--reference", f"{tmp_path}/ref.txt", "--out", out]) == 0
    assert [r.modern_tamil for r in spark.read.json(f"{out}_enriched").collect()] == ["d"]
    assert commands.run(spark, ["export", str(folder), "--out", f"{out}-md"]) == 0 and spark.read.text(f"{out}-md").count() > 3
    (folder / "b.json").write_text("[{}]")
    assert commands.run(spark, ["validate", str(folder)]) == 1
