"""Nearest neighbours, near-duplicates and decontamination against brute force."""

import math
import random
import re

import numpy as np
import pytest
import xxhash

from granary.llm import components, decontaminate, mih, simhash

DOCS = "doc_id long, text string, fp string, id string, anchor int"  # clashing extra columns


def texts(n, seed=0):
    rng = random.Random(seed)
    vocab = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    return [" ".join(rng.choice(vocab) for _ in range(rng.randint(30, 90))) for _ in range(n)]


def plain_fingerprint(t, width=3):
    t = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    grams = [" ".join(w[i : i + width]) for i in range(len(w) - width + 1)] if len(w) >= width else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hs) > len(hs)) if hs else 0


def plain_components(ids, fps, bits):
    label = list(range(len(ids)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(ids)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= bits:
                label[find(i)] = find(j)
    low = {}
    for i, d in enumerate(ids):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [low.get(find(i)) for i in range(len(ids))]


@pytest.mark.parametrize("t", ["", None, " \t", "one", "One TWO", "a b c", "É é\x0bx  y", "z " * 50, "ab cd ef gh " * 9000])
def test_fingerprint(t):
    assert simhash.fingerprint(t) == plain_fingerprint(t)


def test_codes_are_perfect_and_pigeonhole_holds():
    rng = np.random.default_rng(1)
    for parts, radius in ((simhash.HALVES, 4), (simhash.QUARTERS, 1)):
        width = sum(n for _, n in parts)
        x = rng.integers(0, 1 << width, 3000, dtype=np.uint32)
        h = simhash.home(x, parts)
        assert np.bitwise_count(h ^ x).max() == radius and (simhash.home(h, parts) == h).all()
        row, anchor = simhash.reached(x, parts)
        got = {(r, a) for r, a in zip(row.tolist(), anchor.tolist())}
        for bit in range(width):
            assert all((k, a) in got for k, a in enumerate(simhash.home(x ^ np.uint32(1 << bit), parts).tolist()))


def test_components_match_brute_force(spark):
    base = texts(60)
    rows, rng = [], random.Random(3)
    for k, t in enumerate(base):
        rows.append(t)
        for _ in range(k % 4):
            w = t.split()
            w[rng.randrange(len(w))] = "changed"
            rows.append(" ".join(w))
    rows += [base[0]] * 30 + [None, "", "  ", "x y", "x y"]
    ids = list(range(len(rows)))
    data = [(i, t, "f", "i", 1) for i, t in zip(ids, rows)] + [(None, base[1], None, None, None), (7, base[1], "", "", 0)]
    got = simhash.near_duplicates(spark.createDataFrame(data, DOCS)).collect()
    assert len(got) == len(data)
    fps = [plain_fingerprint(d[1]) for d in data]
    want = plain_components([d[0] for d in data], fps, 3)
    key = lambda x: tuple((v is None, v) for v in x)
    as_long = lambda f: f - 2**64 if f >= 2**63 else f
    assert sorted(((r.doc_id, r.fp, r.component_id) for r in got), key=key) == sorted(((d[0], as_long(f), c) for d, f, c in zip(data, fps, want)), key=key)


def test_crowded_anchors_lose_no_component(spark):
    rng = np.random.default_rng(5)
    centre = int(rng.integers(0, 2**62))
    fps = {centre ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (400, 2))} | {int(x) for x in rng.integers(0, 2**62, 300)}
    fps = sorted(fps)
    nodes = spark.createDataFrame([(f, f) for f in fps], "fp long, id long")
    edges = simhash.links(nodes, 3, chunk=40)
    assert edges.count() < 40 * len(fps)  # of about 80,000 pairs
    root = {r.node: r.root for r in components.connected(edges).collect()}
    want = plain_components(fps, fps, 3)
    assert [root.get(f, f) for f in fps] == want


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(200, 201), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in components.connected(edges).collect()}
    assert got == {i: 0 for i in range(61)} | {200: 200, 201: 200}


def test_deduplicate_keeps_one_of_each(spark):
    base = texts(20, 9)
    near = [t.replace(" ", "  ", 3) + " tail" for t in base[:10]]
    rows = [(i, t, None, None, None) for i, t in enumerate(base + near + base[:5])] + [(None, base[0], None, None, None), (900, None, None, None, None), (901, "", None, None, None)]
    kept = simhash.deduplicate(spark.createDataFrame(rows, DOCS))
    assert kept.columns == ["doc_id", "text", "fp", "id", "anchor"]
    assert sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x)) == [*range(20), 900, None]


def plain_groups(rows, similarity=0.8):
    """id: smallest id of its group, by the similarity of all pairs."""
    sets = [(i, set(simhash.shingle_hashes(t).tolist())) for i, t in rows]
    label = {i: i for i, _ in sets}
    for k, (i, x) in enumerate(sets):
        for j, y in sets[:k]:
            both = len(x & y)
            if label[i] != label[j] and both >= similarity * (len(x) + len(y) - both) - 1e-9:
                low, high = sorted((label[i], label[j]))
                label = {d: low if v == high else v for d, v in label.items()}
    return label


def held_groups(spark, rows):
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return {i: i for i, _ in rows} | {r.id: r.group_id for r in simhash.groups(docs).collect()}


def crowd_of(n, seed):
    """Near copies of one text of 200 words, with 0 to 4 words edited."""
    rng = random.Random(seed)
    base, out = " ".join(texts(8, seed)).split()[:200], set()
    while len(out) < n:
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(200)] = f"new{rng.randrange(10**6)}"
        out.add(" ".join(w))
    return sorted(out, key=lambda t: hash_of(t))


def hash_of(t):
    return xxhash.xxh64_intdigest(t.encode(), 3)


@pytest.mark.parametrize("paired", [4, 512])
def test_groups_of_a_crowd_match_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng, line = random.Random(8), "this line stands in every one of these texts without any change"
    rows = list(enumerate(crowd_of(400, 21) + [f"{t} {line}" for t in texts(120, 22)] + [line, f"{line} x", "", None, "?!"]))
    rng.shuffle(rows)
    want = plain_groups(rows)
    assert len(set(want.values())) > 100
    assert held_groups(spark, rows) == want


@pytest.mark.parametrize("paired", [4, 512])
def test_blocks_of_a_crowd_lose_no_link(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "BLOCK", 5_000)
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rows = list(enumerate(crowd_of(150, 31) + crowd_of(60, 32)))
    assert held_groups(spark, rows) == plain_groups(rows)


@pytest.mark.parametrize("listed", ["none", "half", "all"])
def test_groups_do_not_depend_on_the_list_of_common_shingles(spark, monkeypatch, listed):
    """F6 of round 4: the sample behind the list sets an order of shingles; no list loses a pair, not even none or a wrong one."""
    monkeypatch.setattr(simhash, "PAIRED", 16)
    rows = list(enumerate(crowd_of(80, 41) + [f"{t} and this line too in every one of them" for t in texts(60, 42)]))
    every = np.unique(np.concatenate([simhash.shingle_hashes(t) for _, t in rows]))
    chosen = {"none": every[:0], "half": np.sort(np.random.default_rng(1).choice(every, len(every) // 2, replace=False)), "all": every}[listed]
    monkeypatch.setattr(simhash, "common_shingles", lambda *_: chosen)
    assert held_groups(spark, rows) == plain_groups(rows)


def test_spanning_links_join_what_all_links_join():
    sets = [simhash.shingle_hashes(t) for t in crowd_of(120, 41) + texts(10, 42)]
    found = simhash.spanning(np.arange(130), np.arange(130), sets, 0.8)
    label = {i: i for i in range(130)}
    for a, b in found:
        low, high = sorted((label[a], label[b]))
        label = {d: low if v == high else v for d, v in label.items()}
    assert len(found) < 130
    assert label == plain_groups([(i, t) for i, t in enumerate(crowd_of(120, 41) + texts(10, 42))])


def test_cut_and_extended_copies_are_found(spark):
    rng, base, rows = random.Random(50), [f"{a} {b} {c}" for a, b, c in zip(texts(60, 51), texts(60, 52), texts(60, 53))], []
    for t, foreign in zip(base, texts(60, 54)):
        w = t.split()
        n = len(w)
        scattered = [x if rng.random() > 0.02 else "other" for x in w]
        for copy in (w, w[: n - rng.randint(0, n // 5)], w + foreign.split()[: rng.randint(0, n // 5)], scattered):
            rows.append((len(rows), " ".join(copy)))
    want = plain_groups(rows)
    assert held_groups(spark, rows) == want
    assert sum(want[4 * k + 1] == 4 * k for k in range(60)) > 40 and sum(want[4 * k + 2] == 4 * k for k in range(60)) > 40


def test_prefixes_of_similar_sets_meet():
    rng = random.Random(60)
    for n in range(1, 60):
        m = rng.randint(math.ceil(0.8 * n), n)
        x, y = set(range(n)), set(rng.sample(range(n), m))
        assert len(x & y) / len(x | y) >= 0.8 - 1e-9
        assert set(sorted(x)[: simhash.prefix_length(n, 0.8)]) & set(sorted(y)[: simhash.prefix_length(m, 0.8)])


def test_similarity_threshold_is_exact(spark):
    a = texts(1, 4)[0].split()
    b = ["other"] + a[1:]
    c = [x if i % 6 else "other" for i, x in enumerate(a)]
    shingles = [set(simhash.shingle_hashes(" ".join(w)).tolist()) for w in (a, b, c)]
    j = [len(shingles[0] & s) / len(shingles[0] | s) for s in shingles]
    assert j[1] >= 0.8 > j[2]
    docs = spark.createDataFrame([(i, " ".join(w), None, None, None) for i, w in enumerate((a, b, c))], DOCS)
    pairs = spark.createDataFrame([(1, 0), (2, 0)], "a long, b long")
    held = simhash.shingled(docs, "doc_id", "text", 5).selectExpr("doc_id as id", "s")
    assert [tuple(r) for r in simhash.checked(pairs, held, 0.8).collect()] == [(1, 0)]


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(none).count() == 0 and simhash.deduplicate(none).count() == 0
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.find(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b c d e f g", None, None, None)], DOCS)
    assert decontaminate.find(docs, items.limit(0)).count() == 0 and decontaminate.clean(docs, items.limit(0)).count() == 1
    assert mih.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


# Decontamination. ------------------------------------------------------------------------------


def plain_find(docs, items, width=5, threshold=0.8):
    split = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    grams = lambda w, k: {" ".join(w[i : i + k]) for i in range(len(w) - k + 1)}
    out = []
    for i, t in items:
        w = split(t)
        if not w:
            continue
        k = min(width, len(w))
        g = grams(w, k)
        for d, u in docs:
            if d is not None and len(g & grams(split(u), k)) >= threshold * len(g) - 1e-9:
                out.append((d, i, len(g & grams(split(u), k)), len(g)))
    return sorted(out)


def test_find_matches_brute_force(spark):
    base = texts(40, 11)
    items = [(k, " ".join(base[k].split()[5:30])) for k in range(12)] + [(50, "two words"), (51, None), (52, "?!"), (53, base[39])]
    docs = [(k, t) for k, t in enumerate(base)]
    w = base[3].split()
    docs += [(100, " ".join(w[:18] + ["cut"] + w[18:])), (101, " ".join(w[:17])), (102, "TWO, words"), (103, None), (104, ""), (None, base[0]), (105, (base[7] + " ") * 200), (0, base[0])]
    d = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in docs], DOCS)
    i = spark.createDataFrame([(k, t, 1) for k, t in items], "item_id long, text string, doc_id int")
    got = sorted((r.doc_id, r.item_id, r.shared, r.item_shingles) for r in decontaminate.find(d, i).collect())
    want = plain_find(sorted(set(docs), key=str), items)
    assert got == sorted(set(want))
    gone = {r[0] for r in want}
    assert sorted((r.doc_id for r in decontaminate.clean(d, i).collect()), key=lambda x: (x is None, x)) == sorted((x for x, _ in docs if x is None or x not in gone), key=lambda x: (x is None, x))


def test_without_broadcast(spark, monkeypatch):
    base = texts(10, 12)
    d = spark.createDataFrame([(k, t, None, None, None) for k, t in enumerate(base)], DOCS)
    i = spark.createDataFrame([(1, " ".join(base[4].split()[2:25]))], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert [(r.doc_id, r.item_id) for r in decontaminate.find(d, i).collect()] == [(4, 1)]


# Nearest neighbours. ---------------------------------------------------------------------------


def test_recall_and_order(spark):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1500, 32))
    x[700:1000] = x[5]  # a vector that fills a fifth of the table
    rows = [(i, [float(v) for v in r], 1, 2.0) for i, r in enumerate(x)]
    rows += [(2000, None, 1, 1.0), (2100, [0.0] * 32, 1, 1.0), (2200, [float("nan")] * 32, 1, 1.0), (2300, [None] * 32, 1, 1.0), (2400, [1.0] * 7, 1, 1.0), (None, [1.0] * 32, 1, 1.0), rows[100]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, query int, score double")
    got = mih.search(df, every=50).collect()
    want = mih.brute_force(spark, df.where("vec_id < 1500"), every=50)
    found = {(r.query_id, r.vec_id): r.score for r in got}
    true = {(q, v): s for q, _, v, s in want}
    assert len(found) == len(got) == len(true)
    assert len(set(found) & set(true)) >= 0.9 * len(true)
    assert all(abs(found[k] - true[k]) < 1e-9 for k in set(found) & set(true))
    per = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        per.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(per[r.query_id]) and r.vec_id != r.query_id
    assert all(v == sorted(v) for v in per.values())
    hot = [v for _, v in per[750]]
    assert hot == [5, *range(700, 709)]


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (100, [-1.0, 0.0]), (7, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.rank, r.vec_id): round(r.score, 6) for r in mih.search(df).collect()}
    assert got == {(0, 1, 7): 1.414214, (0, 2, 100): 2.0, (100, 1, 7): 1.414214, (100, 2, 0): 2.0}


def test_probing_finds_every_code_within_the_radius(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, (6, mih.SUBSTRINGS), dtype=np.uint8)
    codes = [c ^ np.packbits(rng.random(mih.BITS) < rng.random() * 0.4) for c in np.repeat(base, 40, axis=0)]
    entries = spark.createDataFrame([(i, bytearray(c.tobytes())) for i, c in enumerate(codes)], "entry long, code binary")
    asks = spark.createDataFrame([(i, bytearray(codes[i].tobytes())) for i in range(0, 240, 20)], "query long, code binary")
    for radius in (0, 5, 18, 40, 60):
        for parts in (1, 3):
            got = sorted(tuple(r) for r in mih.within(mih.indexed(entries, parts), asks, radius, parts).collect())
            assert got == sorted((q, i) for q in range(0, 240, 20) for i, c in enumerate(codes) if int(np.bitwise_count(c ^ codes[q]).sum()) <= radius)


def test_recall_on_the_tables(spark):
    for sf, least in (("sf0.01", 0.9), ("sf0.1", 0.9)):
        df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
        found = {(r.query_id, r.vec_id) for r in mih.search(df).collect()}
        true = {(q, v) for q, _, v, _ in mih.brute_force(spark, df)}
        assert len(found) == len(true) and len(found & true) >= least * len(true)


def test_clustered_data_settles_at_a_small_radius(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((8, 32))
    x = np.concatenate([c + 0.05 * rng.standard_normal((250, 32)) for c in centres])
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id) for r in mih.search(df, radii=(34,)).collect()}
    true = {(q, v) for q, _, v, _ in mih.brute_force(spark, df)}
    assert len(got) == len(true) and len(got & true) >= 0.95 * len(true)
