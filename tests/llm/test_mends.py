"""Old maps with hot ids, many languages, clashing names, broken markup."""

import random
import time

import numpy as np
from pyspark.sql import functions as F

from granary.llm import htmltext, langid, mih, sharding, simhash, toxicity


def test_any_version_places_any_records(spark):
    from granary.sources import shared

    store = shared.fresh(spark, "map")
    rows = lambda hot, n: [(h, f"text {h} {k}") for h in hot for k in range(n)] + [(1000 + k, f"other {k}") for k in range(1000)]
    first = spark.createDataFrame(rows((1, 2, 3), 300), "doc_id long, text string")
    later = spark.createDataFrame(rows((2, 3, 4, 5, 6, 7), 300), "doc_id long, text string")
    _, v0 = sharding.shard(first, 6, store=store)
    placed, v1 = sharding.shard(later, 6, store=store)
    assert placed.count() == 2800 and sharding.split_of(v0, sharding.SLOTS) and set(sharding.split_of(v0, sharding.SLOTS)) <= set(sharding.split_of(v1, sharding.SLOTS))
    recs = sharding.records(later, "doc_id", "text", sharding.SLOTS)
    kept = sharding.SlotMap(spark, store)
    by = [{(r.doc_id, r.text_crc32): (r.vslot, r.shard) for r in sharding.placed(recs, kept.read(v)).collect()} for v in (0, 1)]
    assert len(by[0]) == len(by[1]) == 2800
    moved = kept.read(0).alias("a").join(kept.read(1).alias("b"), "vslot").where("a.shard <> b.shard").select("vslot").collect()
    moved = {r.vslot for r in moved}
    same = [k for k in by[0] if by[0][k][0] == by[1][k][0] and by[0][k][0] not in moved]
    assert len(same) > 1000 and all(by[0][k] == by[1][k] for k in same)
    sizes = [r.b for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 6 and max(sizes) < 1.1 * min(sizes)


def test_hundreds_of_languages_are_all_predicted(spark):
    rng = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 1800)]
    text = lambda k: " ".join("".join(rng.choice(letters[3 * k : 3 * k + 3]) for _ in range(4)) for _ in range(8))
    rows = [(4 * k + j, text(k), f"l{k}", "x", 1) for k in range(600) for j in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _l string, _n int")
    got = langid.identify(docs).collect()
    right = {r[0]: r[2] for r in rows}
    assert len(got) == 2400 and len({r.lang_pred for r in got}) > 590
    assert sum(r.lang_pred == right[r.doc_id] for r in got) > 0.98 * len(got)


def test_near_dedup_keeps_columns_of_any_name(spark):
    rng = random.Random(5)
    words = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta".split()) + str(rng.randrange(90)) for _ in range(60)) for _ in range(12)]
    rows = [(k, words[k % 12] + (" tail" if k >= 12 else ""), k, "a", "b", 0, "c", 1.0) for k in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, low long, id string, s string, n int, root string, first double")
    kept = simhash.deduplicate(docs)
    assert sorted(kept.columns) == sorted(docs.columns) and sorted(r.doc_id for r in kept.collect()) == list(range(12))


def test_broken_markup_is_read_in_linear_time():
    for piece in ("<a ", "<", "</p <!-- ", "<a href='x", '<a "', "<script", "&lt;a <b"):
        began = time.perf_counter()
        htmltext.blocks("<p>text</p>" + piece * (5_000_000 // len(piece)))
        assert time.perf_counter() - began < 5, piece
    texts = lambda page: [t for t, *_ in htmltext.blocks(page)]
    assert texts("<p>a</p><!-- <b>no</b> more") == ["a"] and texts("<p>a</p>b <!-- no") == ["a", "b"]
    assert texts("<p>a</p><script>if (a > b) x") == ["a"] and texts("<p>a</p><script>x > 1</script>b < c") == ["a", "b < c"]
    assert texts("<p>a <br>tail <unclosed") == ["a", "tail <unclosed"] and texts("no tags") == ["no tags"] and texts(None) == []


def test_as_many_vectors_are_ranked_in_a_larger_table(spark, monkeypatch):
    """op1_mih: all codes within the radius were, which is a fixed share of evenly spread data."""
    seen, ranked = [], mih.ranked
    monkeypatch.setattr(mih, "ranked", lambda pairs, *rest: seen.append(pairs.count()) or ranked(pairs, *rest))
    monkeypatch.setattr(mih, "SHORT", 16)
    x = np.random.default_rng(9).standard_normal((6000, 48))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    for n in (3000, 6000):
        seen.clear()
        found = {(r.query_id, r.vec_id) for r in mih.search(df.where(f"vec_id < {n}")).collect()}
        true = {(q, v) for q, _, v, _ in mih.brute_force(spark, df.where(f"vec_id < {n}"))}
        assert len(found) == len(true) and len(found & true) >= 0.85 * len(true)
        assert sum(seen) <= 2 * 16 * 11 * n // 100


def test_near_dedup_links_by_fingerprints(spark, monkeypatch):
    """pipeline: the stage used no fingerprint; what fingerprints link is compared and joins groups by itself."""
    rng, seen, kept = random.Random(6), [], simhash.checked
    words = lambda n: [f"w{rng.randrange(900)}" for _ in range(n)]
    texts = [words(300) for _ in range(30)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)] + [(30 + k, " ".join([*t[:-1], "other"])) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for text in (rows[0][1], "a b", ""):
        x = simhash.shingle_hashes(text).tolist()
        assert simhash.set_fingerprint(np.array(x, dtype=np.uint64)) == sum(1 << k for k in range(64) if 2 * sum(v >> k & 1 for v in x) > len(x))
    sets = simhash.begun(docs, "doc_id", "text", 5, 0.8)
    pairs = {(r.a, r.b) for r in simhash.linked(sets, 0.8).collect()}
    fp = {r.id: (r.fp % 2**64, r.doc_id) for r in sets.collect()}
    near = {(fp[a][1] % 30, fp[b][1] % 30) for a in fp for b in fp if a != b and (fp[a][0] ^ fp[b][0]).bit_count() <= 3}
    assert len(near) > 10 and {(fp[a][1] % 30, fp[b][1] % 30) for a, b in pairs} == near
    monkeypatch.setattr(simhash, "checked", lambda p, *rest: seen.append({frozenset((r.a, r.b)) for r in p.collect()}) or kept(p, *rest))
    assert len(simhash.groups(docs).collect()) == 30
    assert {frozenset(p) for p in pairs} <= seen[0]


def test_packed_grams_make_the_same_model_in_less_memory(monkeypatch):
    """pipeline, op8_toxicity: each worker held the counts twice as texts, and all marks of all tokens."""
    rng = random.Random(2)
    counts = {}
    for _ in range(4000):
        for g in toxicity.grams_of("".join(rng.choice("abcdefghijklmnopqé") for _ in range(rng.randint(1, 8)))):
            counts[g] = counts.get(g, 0) + 1
    number = lambda g: sum(ord(c) << 16 * k for k, c in enumerate(reversed(g)))
    packed = np.array([number(g) for g in counts], dtype=np.uint64), np.array([*counts.values()])
    a, b = toxicity.CharModel(counts), toxicity.CharModel(packed)
    assert (a.dense == b.dense).all() and a.letters == b.letters and a.counts == b.counts == counts
    assert not {"counts", "context"} & vars(toxicity.CharModel(packed)).keys()
    monkeypatch.setattr(toxicity, "WITH_MARKS", 100)
    reader = toxicity.Reader(b, None, False)
    for k in range(50):
        reader.ids(" ".join(f"word{k}x{j}".replace("0", "o") for j in range(40)))
    assert len(reader.tokens) <= 140
