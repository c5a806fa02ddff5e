"""The pipeline's stages on the smallest tables, and the registered queries' contract."""

import random

import corpus_pipeline
from granary.llm import queries
from tests.conftest import DATA
from tests.llm.test_pairs import crowd_of, plain_groups, texts


def test_stages_keep_the_columns_and_act(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, left = docs.columns, docs.count()
    labels = {r.doc_id: r for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == columns, name
        ids = {r.doc_id for r in out.select("doc_id").collect()}
        assert 0 < len(ids) <= left and ids <= {r.doc_id for r in docs.select("doc_id").collect()}
        if name == "quality":
            assert not [i for i in ids if i in labels and labels[i].quality == 0]
        docs, left = spark.createDataFrame(out.collect(), out.schema), len(ids)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    assert {r.doc_id for r in pieces.collect()} == ids


def test_near_dedup_stage_matches_brute_force(spark):
    rng, rows = random.Random(70), crowd_of(300, 71)
    for t, foreign in zip(texts(40, 72), texts(40, 73)):
        w, more = t.split(), foreign.split()
        rows += [t, " ".join(w[: len(w) - rng.randint(1, len(w) // 5)]), " ".join(w + more[: rng.randint(1, len(w) // 5)])]
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    kept = corpus_pipeline.one_of_a_kind(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, low in plain_groups(rows).items() if i == low)


def test_names():
    assert [int(n[2:].split("_")[0]) for n in queries.QUERIES] == list(range(1, 11))
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert len(corpus_pipeline.STAGES) == 5


EDGES = "doc_id long, text string, lang string, source string, n_chars long, id long, _scored int, _tail string, h long, root int, word string"


def test_stages_on_empty_tables_nulls_and_clashing_columns(spark):
    good = " ".join(texts(3, 80))
    rows = [(1, good, None, None, None, 1, 1, "t", 1, 1, "w"), (2, None, "en", "s", 0, 1, 1, "t", 1, 1, "w"), (None, good + " more", "en", "s", 0, 1, 1, "t", 1, 1, "w"), (3, "", "en", "s", 0, 1, 1, "t", 1, 1, "w"), (1, good, "en", "s", 0, 1, 1, "t", 1, 1, "w"), (4, "word " * 60_000, "en", "s", 0, 1, 1, "t", 1, 1, "w")]
    for docs in (spark.createDataFrame(rows, EDGES), spark.createDataFrame([], EDGES)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, DATA)
            assert out.columns == docs.columns and out.count() <= n, name
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).select("doc_id").distinct().count() <= n


def test_decontamination_stage_matches_brute_force(spark):
    from tests.llm.test_pairs import plain_find

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    w = items[0][1].split()
    rows += [(90_001, "before " + items[1][1] + " after"), (90_002, " ".join(w[: len(w) // 2])), (90_003, " ".join([*w[:-1], "changed"]))]
    gone = {r[0] for r in plain_find(rows, items)}
    assert {90_001, 90_003} <= gone and 90_002 not in gone
    kept = corpus_pipeline.no_benchmark(spark, spark.createDataFrame(rows, "doc_id long, text string"), DATA)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - gone


def test_classifiers_on_rows_that_they_have_not_seen(spark):
    from pyspark.sql import functions as F

    from granary.llm import quality, toxicity

    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    half = F.pmod(F.xxhash64("doc_id", F.lit(77)), F.lit(2)) == 0
    seen = quality.score(docs, quality.fit(docs, labels.where(half))).join(labels.where(~half), "doc_id")
    right = seen.select(((F.col("tail") >= quality.CUTOFF) == (F.col("quality") == 1)).cast("int").alias("ok")).agg(F.avg("ok")).first()[0]
    assert right >= 0.95
    judged = toxicity.judge(docs, labels).where("held_out").join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r.toxic, r.predicted): r["count"] for r in judged}
    # Some labels follow nothing in their text: the recall of round 1 was 85 of 97.
    assert n[1, 1] >= 0.85 * (n[1, 1] + n.get((1, 0), 0)) and n[1, 1] >= 0.95 * (n[1, 1] + n.get((0, 1), 0))
