"""One small test for each finding of the third round that was right."""

import json
import random

from pyspark.sql import functions as F

from granary.operators import lookups, match, scan, sinks, sketches
from granary.operators.longkeys import Stretches
from granary.sources import hub
from granary.streaming import ingest


def test_long_manifest_is_dealt_by_host(tmp_path, monkeypatch):
    """a manifest of more rows than the driver plans was an error."""
    rows = [{"filename": str(k), "url": f"https://h{k % 5}.example/{'de' if k % 3 else 'en'}/{k}"} for k in range(40)]
    (tmp_path / "m.json").write_text("\n".join(map(json.dumps, rows)))
    read = lambda **more: [(r[0], r[1], r[3], p) for p, part in enumerate(parts(**more)) for r in reader(**more).read(part)]
    reader = lambda **more: hub.FetchReader({"path": str(tmp_path), "fetcher": "granary.plans.advanced:page_bytes", "gap": "0", "wait": "0"} | more)
    parts = lambda **more: reader(**more).partitions()
    short = read()
    monkeypatch.setattr(hub, "LISTED", 10)
    long = read()
    assert all(isinstance(p, hub.Lane) for p in parts())
    assert sorted(r[:3] for r in long) == sorted(r[:3] for r in short) and len(long) == 40
    assert len({(r[0], r[3]) for r in long}) == 5  # no host is asked by two tasks
    assert {r[0] for r in read(host="h1.example,h2.example")} == {"h1.example", "h2.example"}


def test_dotted_numbers_of_five_digits(spark):
    """numbers from 10000 on were left out."""
    verse = "தமிழ் " * 8
    page = spark.createDataFrame([(1, f"<strong>1.. Sub.</strong>\n9999.<br>{verse} 9999<br>\n10000.<br>{verse} 10000<br>")], "page int, html string")
    assert sorted((r.number, r.text) for r in scan.dotted_lines(page, "html", ["page"]).collect()) == [("10000", verse.strip()), ("9999", verse.strip())]


def test_arrays_stand_in_one_file_however_tasks_are_joined(spark, tmp_path):
    """the end of an array went to another file where the two sides of the union were put together differently."""
    conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB", "spark.sql.shuffle.partitions": "20"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        df = spark.range(20_000).select((F.col("id") % 9).cast("string").alias("source"), "id", F.sha2(F.col("id").cast("string"), 256).alias("x"))
        sinks.write_arrays(df, str(tmp_path / "a"), "source", ["id"])
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    for k in range(9):
        (file,) = (tmp_path / "a" / f"text={k}").glob("*.txt")
        assert [e["id"] for e in json.loads(file.read_text())] == list(range(k, 20_000, 9))


def test_of_two_titles_at_one_place_the_largest_counts(spark):
    """which of two came was left open."""
    for rows in ([(1, 5, "a"), (1, 5, "b"), (1, 4, "c")], [(1, 5, "b"), (1, 5, "a"), (1, 4, "c")]):
        assert lookups.last_title(spark.createDataFrame(rows, "k int, at int, t string").coalesce(1), "k", "at", "t").first().t == "b"


def test_figures_beyond_what_sketches_hold_are_exact(spark):
    """quantiles and distinct counts were estimates beyond k rows and 2 ** nominal things."""
    rng = random.Random(3)
    rows = [(g, rng.randrange(700), float(rng.randrange(900)) if rng.random() < 0.97 else None) for g in "ab" for _ in range(4000)] + [("c", 1, None), ("d", 2, 7.0)]
    df = spark.createDataFrame(rows, "g string, thing int, value double")
    parts = sketches.partials(df, ["g"], "value", "thing", k=8, nominal=4)
    for slack in (0.002, 0.2):  # too little at k = 8, so what was missed is sought again, and enough
        got = {r.g: (r.p50, r.p95, r.distinct_things) for r in sketches.sharpened(parts, df, ["g"], "value", "thing", slack=slack, nominal=4).collect()}
        for g in "abcd":
            values = sorted(v for k, _, v in rows if k == g and v is not None)
            at = lambda num: values[max(-(-num * len(values) // 100), 1) - 1] if values else None
            assert got[g] == (at(50), at(95), len({t for k, t, _ in rows if k == g}))


def test_stretches_are_found_by_halving(spark):
    """every row was held against all cuts of its key."""
    df = spark.range(3000).select((F.col("id") % 2).alias("k"), F.when(F.col("id") % 50 > 1, (F.col("id") * 7919) % 1500).alias("at"), "id")
    s = Stretches(df, ["k"], "at", 100)
    assert "filter(" not in s.rows._jdf.queryExecution().optimizedPlan().toString().lower().replace("filter (", "")
    ranges = s.rows.groupBy("k", s.column).agg(F.min("at").alias("lo"), F.max("at").alias("hi"), F.count("*").alias("n")).orderBy("k", s.column).collect()
    assert len(ranges) > 20 and max(r.n for r in ranges) < 300 and ranges[0][1] == 0
    assert all(a.k != b.k or a.hi < b.lo for a, b in zip(ranges, ranges[1:]))


def test_unlike_texts_are_no_candidates(spark, monkeypatch):
    """Texts that share common words were written as pairs, with all their features; a text that is empty when cleaned was an error."""
    rng = random.Random(7)
    words = lambda n, common=0.1: [rng.choice(("of", "the", "and", "in", "to")) if rng.random() < common else "".join(rng.choices("abcdefgh", k=7)) for _ in range(n)]
    texts = [" ".join(words(5)) + "\n" + " ".join(words(90, 0.6)) for _ in range(150)]
    texts += [" ".join(words(1)) + "\n" + t.split("\n")[1].replace("the", "that", 1) for t in texts[:9]] + [texts[20] + " more", texts[21], "\\n", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, t string")
    monkeypatch.setattr(match, "WORK", 1_000_000)  # several blocks of a step
    f = match.signed(match.features(df, "id", "t")).persist()
    assert match.may_match(f, f, True, 0.5).count() < 200
    f.unpersist()
    got = sorted(map(tuple, match.best_matches(df, df, "id", "id", "t", "t", same_id=True).collect()))
    assert got == sorted(map(tuple, match.brute_force(df, df, "id", "id", "t", "t", same_id=True).collect())) and len(got) > 12


def test_pages_are_dealt_to_more_tasks_than_are_put_together(spark):
    """adaptive execution made a few tasks of many, which sorted all events of their pages."""
    page = "".join(f"<strong>{k}. Title</strong><br>prose<ul>{'தமிழ் ' * 9}</ul>" for k in range(1, 4))
    pages = spark.range(40).select("id", F.lit(page).alias("html"))
    rows = scan.grouped(scan.events(pages, "html", ["id"]), ["id"], F.col("kind") == "strong", 120)
    assert rows.select(F.spark_partition_id()).distinct().count() > 8
    assert scan.bold_numbers(pages, "html", ["id"]).count() == 120


def test_rows_of_a_small_file_are_dealt_to_all_cores(spark):
    """all lines of a file that is one split were cleaned by one task."""
    from granary.plans import catalog, editions  # registers both

    assert catalog.QUERIES and editions.spread is catalog.spread
    for name in ("f2_f3_clean_lines", "token_ngram"):
        got = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert got.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and got.count() == 200


def test_a_batch_is_worked_out_once(spark, tmp_path):
    """each merge worked its batch out to see which buckets it touches, and again to write them."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = spark.range(500).selectExpr("id % 50 AS k", "id AS at").mapInArrow(run, "k long, at long")
    held = ingest.KeyedTable(spark, str(tmp_path / "held"), ["k"], "at", buckets=2)
    assert held.merge(rows, 0) and seen.value == 500
    assert sorted(map(tuple, held.read().select("k", "at").collect())) == [(k, 450 + k) for k in range(50)]
