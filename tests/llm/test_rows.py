"""Packing, sharding, url filter, and the learned operators."""

import random
import zlib

import numpy as np
import pytest

from granary.llm import htmltext, langid, packing, quality, sharding, toxicity, urlfilter


def test_packing_round_trip(spark):
    import public_tokenizers
    import tokenizers

    tk = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tk.encode_special_tokens = True
    texts = ["", None, "Hello  world'll \n\n x", "<|endoftext|> ü 日本語 🎉 ١٢", "word " * 5000, "a\tb\r\nc", "same", "same"]
    rows = [(i if i != 3 else None, t, 9, b"x") for i, t in enumerate(texts)]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, n int, ids binary")).collect()
    want = [np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], dtype="<u4") for t in texts]
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    for (d, *_), ids in zip(rows, want):
        pieces = sorted(by[d], key=lambda r: r.start)
        assert b"".join(bytes(r.ids) for r in pieces) == ids.tobytes()
        at = 0
        for r in pieces:
            assert (r.start, r.doc_tokens, len(r.ids)) == (at, len(ids), 4 * r.length) and r.length > 0
            at += r.length
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = sum(map(len, want))
    assert sorted(seqs) == list(range(-(-total // 2048)))
    for s in seqs.values():
        at = 0
        for o, n in sorted(s):
            assert o == at
            at += n
        assert at <= 2048
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_added_tokens_have_the_ids_of_the_file(spark):
    import corpus_pipeline
    import public_tokenizers
    import tokenizers

    tk = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a<|endoftext|>b", "<|endoftext|><|endoftext|> x", "plain text", "<|endof text|>"]
    want = [np.array(tk.encode(t, add_special_tokens=False).ids + [1], dtype="<u4") for t in texts]
    assert want[0].tolist() == [64, 50256, 65, 1]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in corpus_pipeline.packed(spark, docs, "").collect()}
    assert got == {i: (len(w), zlib.crc32(w.tobytes())) for i, w in enumerate(want)}


def test_hilbert_is_a_walk():
    pts = np.array([(i, j, k) for i in range(8) for j in range(8) for k in range(8)])
    keys = packing.hilbert(pts, 3)
    assert sorted(keys) == list(range(512)) and np.abs(np.diff(pts[np.argsort(keys)], axis=0)).sum(axis=1).max() == 1


def test_sharding(spark):
    rng = random.Random(0)
    rows = [(i, "x" * rng.randint(0, 400), "s", 1) for i in range(3000)] + [(5, "again", "s", 1), (5, "again", "s", 1), (None, "no id", "s", 1), (9999, None, "s", 1), (9998, "é", "s", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, shard string, slot int")
    placed, held = sharding.shard(df, 8)
    got = placed.collect()
    assert len(got) == len(rows) and held.count() == sharding.SLOTS
    want = sorted(((d, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for d, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    sizes, places = [0] * 8, [[] for _ in range(8)]
    for r in got:
        sizes[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert max(sizes) < 1.02 * min(sizes)
    assert all(sorted(p) == list(range(len(p))) for p in places)
    empty, held = sharding.shard(df.limit(0), 8)
    assert empty.count() == 0 and {r["count"] for r in held.groupBy("shard").count().collect()} == {sharding.SLOTS // 8}


def test_rebalancing_moves_little():
    rng = random.Random(1)
    stats = [(s, rng.randint(1, 100), 1) for s in range(512)]
    v0 = sharding.build_map(stats, 8)
    v1 = sharding.rebalance(v0, stats, 9)
    moved = [s for s in v0 if v0[s] != v1[s]]
    loads = [sum(b for s, b, _ in stats if v1[s] == k) for k in range(9)]
    assert max(loads) < 1.05 * min(loads) and len(moved) < 0.2 * len(stats) and {v1[s] for s in moved} == {8}
    v2 = sharding.rebalance(v1, stats, 8)
    assert all(v2[s] == v1[s] for s in v1 if v1[s] < 8) and set(v2.values()) == set(range(8))


URLS = [
    ("http://A.Example.NET/en/x?q#f", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/de/", "example.net", "/de/", "net/", "block"),
    ("https://net", "net", "", None, "allow"),
    ("https://badexample.com/de/x", "badexample.com", "/de/x", None, "allow"),
    ("x://b.example.com/de/http://q.net/", "b.example.com", "/de/http://q.net/", "example.com/de/", "block"),
    ("http://x.org/fr/", "x.org", "/fr/", "org/fr/", "allow"),
    ("http://x.org?a=://net/", "x.org", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
]


def test_urlfilter(spark):
    from granary.llm.queries import URL_RULES

    rows = [(i, u, "h", "k") for i, (u, *_) in enumerate(URLS)] + [(0, URLS[0][0], "h", "k")]
    df = spark.createDataFrame(rows, "page_id long, url string, host string, key string")
    listed = spark.createDataFrame(URL_RULES * 2, "host string, path string, verdict string")
    got = sorted(tuple(r) for r in urlfilter.judge(df, listed).select("page_id", "host", "path", "rule", "verdict").collect())
    assert got == sorted([(i, *x[1:]) for i, x in enumerate(URLS)] + [(0, *URLS[0][1:])])
    assert {r.verdict for r in urlfilter.judge(df, listed.limit(0)).collect()} == {"allow"}
    assert urlfilter.judge(df.limit(0), listed).count() == 0


def test_bloom_has_no_false_negatives_and_few_positives(spark):
    listed = spark.range(3000).selectExpr("concat('host', id, '.example.com') as host", "'/' as path", "'block' as verdict")
    pages = spark.range(6000).selectExpr("id as page_id", "concat('http://host', id, '.example.com/x') as url")
    got = {r.page_id: r.verdict for r in urlfilter.judge(pages, listed).collect()}
    assert all(got[i] == ("block" if i < 3000 else "allow") for i in range(6000))


# Learned operators. ----------------------------------------------------------------------------


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def test_langid(spark):
    rng = random.Random(0)
    letters = {"aa": "abcde", "bb": "vwxyz", "cc": "бвгдж"}
    rows = [(i, words(rng, letters[k], 60), k, "p") for i, k in enumerate(list(letters) * 60)]
    rows += [(900, None, "aa", ""), (901, "123 !?", "aa", ""), (902, "", None, ""), (903, "a", None, ""), (None, words(rng, "vwxyz", 30), "bb", ""), (904, "бвг " * 40000, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert len(got) == len(rows)
    assert all(got[d].lang_pred == x for d, _, x, _ in rows[:180]) and got[None].lang_pred == "bb" and got[904].lang_pred == "cc"
    assert [got[d].lang_pred for d in (900, 901, 902)] == ["und"] * 3 and got[900].score == 0
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got.values())
    assert {r.lang_pred for r in langid.identify(df.where("doc_id >= 903")).collect()} == {"und"}
    assert langid.identify(df.limit(0)).count() == 0


def test_bound_ngrams_are_what_is_bundled():
    s = langid.Space(64)
    codes, counts = langid.gram_codes("Aba!")
    want = sum(n * np.roll(s.letter(c >> 42), 2) * np.roll(s.letter(c >> 21 & 0x1FFFFF), 1) * s.letter(c & 0x1FFFFF) for c, n in zip(codes.tolist(), counts.tolist()))
    got = s.bundle(["Aba!"])[0]
    assert np.allclose(got, want / np.linalg.norm(want), atol=1e-5)


def test_ordinal_recovers_thresholds():
    rng = np.random.default_rng(0)
    x = rng.standard_normal((4000, 3))
    noise = np.log(1 / rng.random(4000) - 1)
    y = np.digitize(x @ [2.0, -1.0, 0.0] + noise, [-1.5, 0.0, 2.0])
    m = quality.Ordinal.fit(x, y, [0, 1, 2, 3], l2=0, steps=1500)
    assert np.allclose(m.weights, [2, -1, 0], atol=0.25) and np.allclose(m.thresholds, [-1.5, 0, 2], atol=0.25)
    assert (np.diff(m.above(x), axis=1) <= 0).all()


def test_quality(spark):
    rng = random.Random(0)
    clean = lambda: " ".join(words(rng, "abcdefgh", 12) + "." for _ in range(5))
    junk = lambda: words(rng, "abcdefgh", 40).replace(" ", "### ").upper()
    rows = [(i, junk() if i % 4 == 0 else clean(), "q") for i in range(400)] + [(900, None, ""), (901, " ", ""), (None, clean(), "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality string")
    labels = spark.createDataFrame([(i, 0 if i % 4 == 0 else 1 + i % 2) for i in range(0, 300)] + [(5, None), (None, 1), (7777, 1)], "doc_id long, quality int")
    kept = quality.select(docs, labels)
    assert kept.columns == ["doc_id", "text", "quality"]
    assert {r.doc_id for r in kept.collect()} == {i for i in range(400) if i % 4} | {None}
    assert quality.select(docs, labels.limit(0)).count() == 401 and quality.select(docs.limit(0), labels).count() == 0
    got = quality.score(docs, quality.fit(docs, labels)).collect()
    assert len(got) == len(rows) and all(0 <= r.expected_grade <= 2 for r in got)


@pytest.fixture(scope="module")
def toxic_tables(spark):
    rng = random.Random(0)
    bad = ["stupid", "idiot", "moron"]
    rows, labels = [], []
    for i in range(600):
        w = words(rng, "abcdehlnorst", 40).split()
        if i % 4 == 0:
            w[rng.randrange(40)] = rng.choice(bad)
            w[rng.randrange(40)] = rng.choice(bad)
        rows.append((i, " ".join(w), "t"))
        labels.append((i, int(i % 4 == 0)))
    return rows, labels


def test_toxicity(spark, toxic_tables):
    rows, labels = toxic_tables
    extra = [(900, None, ""), (901, "", ""), (902, "abcd 1d10t and 5tup1d rest", ""), (903, "so m o r o n and i d i o t now", ""), (904, "stuuuupid iiiidiot", ""), (905, "abc, den *** ol### 123 a b", ""), (None, rows[0][1], ""), (906, "nord " * 20000 + " st*pid m0ron", "")]
    docs = spark.createDataFrame(rows + extra, "doc_id long, text string, score string")
    lab = spark.createDataFrame(labels + [(1, None), (None, 1), (7777, 1)], "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.judge(docs, lab).collect()}
    assert len(got) == 608
    assert sum(got[i].predicted != y for i, y in labels) == 0
    assert [got[k].predicted for k in (900, 901, 902, 903, 904, 905, 906, None)] == [0, 0, 1, 1, 1, 0, 1, 1]
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in got.values())
    kept = toxicity.select(docs, lab)
    assert kept.columns == ["doc_id", "text", "score"] and kept.where("doc_id % 4 <> 0 and doc_id < 600").count() == 450
    assert {r.score for r in toxicity.judge(docs, lab.limit(0)).collect()} == {0.0}
    assert toxicity.judge(docs.limit(0), lab).count() == 0


def test_lattice_decodes():
    seen = ["stupid", "idiot", "the", "and", "pathetic", "loser", "worthless"]
    counts = {}
    for w in seen * 20:
        for g in toxicity.grams_of(w):
            counts[g] = counts.get(g, 0) + 1
    m = toxicity.CharModel(counts)
    for noisy, want in {"1d10t": "idiot", "s.t.u.p.i.d": "stupid", "p@the7ic": "pathetic", "lo$er": "loser", "looooser": "loser", "st*pid": "stupid", "worthle$$": "worthless"}.items():
        assert toxicity.decode(noisy, m) == want


@pytest.fixture(scope="module")
def word_model():
    seen = "stupid idiot the and pathetic loser worthless you are a fool this is with some what they have from".split()
    counts = {}
    for w in seen * 20:
        for g in toxicity.grams_of(w):
            counts[g] = counts.get(g, 0) + 1
    return toxicity.CharModel(counts)


def test_long_tokens_are_read_whole(word_model):
    got = toxicity.Reader(word_model).ids("the p@the.tic fool lo$er" + "-" * 30 + "." * 30 + "x")
    assert "=pathetic" in got and "^loser" in got
    assert "^stupid" in toxicity.Reader(word_model).ids("s t u p i d " + "y o u a r e a f o o l " * 4)


def hits(text, model):
    """Which of the words are found in the text as whole words."""
    got = toxicity.Reader(model).ids(text)
    return {w for w in ("stupid", "idiot", "loser") if f"={w}" in got}


def test_long_runs_and_tokens_are_read_whole(word_model):
    filler = "y o u a r e a f o o l " * 4
    assert hits(filler + "s t u p i d i d i o t", word_model) == {"stupid", "idiot"}
    assert hits("-".join("y0u are the fool and this is what they have 5tup1d".split()), word_model) == {"stupid"}
    assert "=pathetic" in toxicity.Reader(word_model).ids("the p@the.tic fool")
    assert toxicity.decode("lo$er" + "-" * 30 + "." * 30, word_model) == "loser"


@pytest.mark.parametrize("t", ["st upid", "stu pid", "s  t  u  p  i  d", "stu\npid", "stu-\npid", "you are a s t u p i d fool", "y o u  a r e  a  s t u p i d  f o o l", "st up1d"])
def test_spaces_are_in_the_lattice(word_model, t):
    assert hits(f"this is {t} and they have", word_model) == {"stupid"}


def test_what_is_not_wanted_alone_is_passed_over(word_model):
    wanted = {"=stupid", "^idio"}
    for t in ("st upid", "stu pid", "id iot", "i diot", "are st upid", "s t u p i d"):
        assert toxicity.Reader(word_model, wanted).ids(t) == toxicity.Reader(word_model).ids(t) & wanted != set()


def test_whole_words_stay_apart(word_model):
    assert toxicity.parted(("you", "are", "a", "fool"), word_model) == ["you", "are", "a", "fool"]
    assert hits("you are a fool and they have what this is", word_model) == set()


PAGES = [
    ("<nav><a href=x>Home</a></nav><article><h1>Title &amp; more</h1><p>First line of text here.<p>Second&nbsp;line,  wrapped\nhere.</article><footer>&copy; x</footer>", "Title & more\nFirst line of text here.\nSecond line, wrapped here."),
    ("", ""),
    (None, ""),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><!-- <p>no</p> -->", ""),
]


def test_htmltext(spark):
    rows = [(i, f"u{i}", h, "x", 1) for i, (h, _) in enumerate(PAGES)] + [(0, "u0", PAGES[0][0], "x", 1), (None, None, PAGES[0][0], "x", 1), (9, "u", "<article>" + "<p>A long line of words for this text.</p>" * 5000 + "</article>", "x", 1)]
    got = htmltext.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")).collect()
    assert len(got) == len(rows) and all(r.n_chars == len(r.text) for r in got)
    by = {r.page_id: r.text for r in got}
    assert [by[i] for i in range(len(PAGES))] == [t for _, t in PAGES] and by[None] == PAGES[0][1]
    assert by[9].count("\n") == 4999
    assert htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_labeller_on_held_out_templates():
    xs, ys = htmltext.labelled(htmltext.synthetic(150, 77))
    right = [((p >= 0.5) == y).mean() for p, y in zip(htmltext.trained().label(xs), ys)]
    assert np.mean(right) > 0.98


def test_gradients():
    rng = np.random.default_rng(0)
    m = htmltext.Lstm(rng, dim=5, hidden=3)
    x, mask = rng.standard_normal((4, 2, 5)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], dtype=bool)
    d = rng.standard_normal((4, 2, 3)) * mask[:, :, None]
    tape = []
    m.forward(x, mask, tape)
    grads = m.backward(x, tape, d)
    for p, g in zip(m.params, grads):
        i = tuple(rng.integers(s) for s in p.shape)
        old = p[i]
        p[i] = old + 1e-5
        hi = (m.forward(x, mask) * d).sum()
        p[i] = old - 1e-5
        lo = (m.forward(x, mask) * d).sum()
        p[i] = old
        assert abs((hi - lo) / 2e-5 - g[i]) < 1e-4


def test_wild_lattices_in_arrays_are_decoded_alike(word_model, monkeypatch):
    rng = random.Random(5)
    for _ in range(40):
        token = "".join(rng.choice("stupidoer*#1$0.") for _ in range(rng.randint(1, 12)))
        places = toxicity.lattice(token)
        monkeypatch.setattr(toxicity, "WILD_PLACES", 10**9)
        plain = toxicity.viterbi(places, word_model)
        fast = toxicity.viterbi_in_arrays(places, word_model)
        spelt = lambda w: sum(word_model.logp(("^" + w[:i])[-3:], c) for i, c in enumerate(w + "$"))
        assert fast == plain or abs(spelt(fast) - spelt(plain)) < 1e-3


def test_dense_table_is_the_model(word_model):
    rng, m = random.Random(6), word_model
    for _ in range(300):
        w = "".join(rng.choice(m.letters) for _ in range(5))
        i = rng.randint(1, 5)
        before, c = ("^" + w[: i - 1])[-3:], (w + "$")[i - 1]
        code = [toxicity.PAD] * (3 - len(before)) + m.codes(before) + m.codes(c)
        at = 0
        for k in code:
            at = at * m.size + k
        assert abs(m.dense[at] - m.logp(before, c)) < 1e-3


def test_very_long_tokens_take_linear_time(word_model):
    import time

    began = time.perf_counter()
    wanted = {"=stupid", "^idio"}
    for t in ("st" * 50_000, "a.-" * 30_000, "*a" * 200, "5tup1d-" * 5_000):
        got = toxicity.Reader(word_model, wanted).ids(t)
    assert got == {"=stupid"} and time.perf_counter() - began < 60


def test_columns_called_like_work_columns_are_kept(spark, toxic_tables):
    rows, labels = toxic_tables
    lab = spark.createDataFrame([(i, y, 1 - y) for i, y in labels], "doc_id long, toxic int, quality int")
    docs = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t, _ in rows[:80]], "doc_id long, text string, _scored int, _score int, _tail int, _expected int, _toxicity int")
    for module in (toxicity, quality):
        kept = module.select(docs, lab)
        assert kept.columns == docs.columns and 0 < kept.count() <= 80


@pytest.mark.parametrize("room", [4, 48])
def test_counted_grams_are_the_grams_of_the_words(monkeypatch, room):
    monkeypatch.setattr(toxicity.GramTable, "ROOM", room)
    rng, toks = random.Random(1), []
    for _ in range(500):
        toks.append("".join(rng.choice("abcñ1. \nß😀") for _ in range(rng.randint(0, 12))))
    weights = [rng.randint(1, 9) for _ in toks]
    t, got, want = toxicity.GramTable(), {}, {}
    for lo in (0, 100):
        t.add(toks[lo : lo + 100 if lo == 0 else None], np.array(weights[lo : lo + 100 if lo == 0 else None]))
    t.add(["", "1"], np.array([1, 1]))
    for g, n in zip(*t.counts()):
        got[toxicity.spelt(int(g))] = got.get(toxicity.spelt(int(g)), 0) + int(n)
    for t, k in zip(toks, weights):
        for w in toxicity._PLAIN.findall(t):
            for g in toxicity.grams_of(w):
                want[g] = want.get(g, 0) + k
    assert got == want


def test_hashes_are_those_of_spark(spark):
    texts = ["", "a", "host\n/x", "é日本", "z" * 100]
    df = spark.createDataFrame([(t,) for t in texts], "k string").selectExpr("k", "xxhash64(k) as h", "xxhash64(k, 7) as g")
    for r in df.collect():
        raw = r.k.encode()
        assert r.h % 2**64 == urlfilter.xxhash.xxh64_intdigest(raw, urlfilter.SPARK_SEED) and r.g % 2**64 == urlfilter._spark_hash_with(raw, 7)


def test_a_list_of_many_shapes_has_the_same_plan(spark):
    rng = random.Random(3)
    hosts = [".".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(60)]
    listed = [(rng.choice(hosts), "/" + "p" * rng.randint(0, 40), rng.choice(["block", "allow"])) for _ in range(300)]
    urls = [f"x://{rng.choice(hosts)}/{'p' * rng.randint(0, 50)}" for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = spark.createDataFrame(listed, "host string, path string, verdict string")
    best = {}
    for h, p, v in listed:
        best[h, p] = max(v, best.get((h, p), ""))
    got = {r.page_id: (r.rule, r.verdict) for r in urlfilter.judge(df, rules).collect()}
    for i, u in enumerate(urls):
        host, path = u[4:].split("/", 1)[0], "/" + u[4:].split("/", 1)[1]
        fits = [(len(h + p), h + p, v) for (h, p), v in best.items() if (host == h or host.endswith("." + h)) and path.startswith(p)]
        assert got[i] == (max(fits)[1:] if fits else (None, "allow"))


def test_the_stored_map_is_edited_version_by_version(spark):
    from granary.sources import shared

    rng, store = random.Random(4), shared.fresh(spark, "map")
    df = spark.createDataFrame([(i, "x" * rng.randint(0, 300)) for i in range(4000)], "doc_id long, text string")
    _, v0 = sharding.shard(df, 8, store=store)
    more = df.unionByName(spark.createDataFrame([(i, "y" * 300) for i in range(9000, 10500)], "doc_id long, text string"))
    rows, v1 = sharding.shard(more, 9, store=store)
    kept = sharding.SlotMap(spark, store)
    assert kept.versions() == [0, 1] and v0.first().version == 0 and v1.first().version == 1
    sizes = {r.shard: r.b for r in rows.groupBy("shard").sum("size").withColumnRenamed("sum(size)", "b").collect()}
    assert len(sizes) == 9 and max(sizes.values()) < 1.03 * min(sizes.values())
    stayed = kept.read(0).alias("a").join(kept.read(1).alias("b"), "vslot").where("a.shard = b.shard").count()
    assert stayed > 0.6 * sharding.SLOTS
    assert sharding.placed(sharding.records(more, "doc_id", "text", sharding.SLOTS), kept.read(0)).count() == 5500


def test_an_id_that_a_third_of_the_rows_has_is_split(spark):
    df = spark.createDataFrame([(7 if i % 3 == 0 else i, "text of some length") for i in range(3000)], "doc_id long, text string")
    rows, _ = sharding.shard(df, 6)
    got = rows.collect()
    sizes, places = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        places.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 3000 and max(sizes.values()) < 1.1 * min(sizes.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_only_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    rng = random.Random(1)
    rows = [(i, words(rng, "abcde" if i % 2 else "vwxyz", 30), "aa" if i % 2 else "bb") for i in range(80)] + [(100 + i, "q", f"dirt{i}") for i in range(50)]
    got = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in got.collect()} == {"aa", "bb"}


def block_scores(model, pages):
    """Precision and recall of main blocks."""
    xs, ys = htmltext.labelled(pages)
    said, true = np.concatenate([p >= 0.5 for p in model.label(xs)]), np.concatenate(ys) > 0
    return (said & true).sum() / max(said.sum(), 1), (said & true).sum() / true.sum()


@pytest.mark.parametrize("held", [("cells",), ("wiki", "bare")])
def test_labeller_on_families_that_it_has_not_seen(held):
    model = htmltext.trained(1200, 5, tuple(f for f in htmltext.FAMILIES if f not in held))
    precision, recall = block_scores(model, htmltext.synthetic(150, 78, held))
    assert precision >= 0.9 and recall >= 0.9


def test_long_pages_are_read_as_one():
    model = htmltext.trained()
    found = htmltext.blocks(htmltext.synthetic(1, 9)[0][0] + "".join(f"<p>{t}</p>" for t in ["A line of text, which goes on.", "Another one."] * 60))
    whole = model.label([htmltext.vectors(found)])[0]
    old, htmltext.LONG = htmltext.LONG, 13
    try:
        assert np.allclose(model.label_long(found), whole, atol=1e-5)
    finally:
        htmltext.LONG = old


_P = "The river rose in the night, and by the morning the lower streets were under water again."
_Q = "Nobody in the town could remember a flood that came so early in the year, or so fast."
_M = '<a href="/a">Home</a> <a href="/b">News</a> <a href="/c">Sport</a> <a href="/d">Contact</a>'
_L = "<ul><li><a href=/a>Home</a></li><li><a href=/b>News</a></li><li><a href=/c>Weather</a></li></ul>"
#: Pages written by hand: (page, what of P and Q and a title has to be kept, what must not be).
HAND_MADE = [
    (f"<div class=top>{_M}</div><div class=wrap><div class=col><h1>Flood</h1><div>{_P}</div><div>{_Q}</div></div></div><div class=footer>&copy; 2020 The Paper</div>", "The Paper"),
    (f"<div id=mw-page><div id=content><h1 id=firstHeading>Flood</h1><div id=bodyContent><p>{_P}</p><p>{_Q}</p></div></div></div><div id=p-navigation>{_L}</div>", "Weather"),
    (f"<table><tr><td width=120>{_L}</td><td><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></td></tr></table>", "Weather"),
    (f"<h1>Flood</h1><p>{_P}</p><p>{_Q}</p>", None),
    (f"<h1>Flood</h1><p>{_P}<p>{_Q}<hr>{_M}", "Sport"),
    (f"<main><article><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></article><div class=replies><div class=cmt><b>ann</b><p>First! What a story that was.</p></div><div class=cmt><b>bob</b><p>I do not agree with this at all.</p></div></div></main>", "First!"),
    (f"<header><h1>The Paper</h1><nav>{_L}</nav></header><main><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></main><footer><p>All rights reserved.</p></footer>", "rights"),
    (f"<body><div class=cookie-banner><p>We use cookies to make this site better.</p><button>OK</button></div><article><h2>Flood</h2><p>{_P}</p><p>{_Q}</p></article>", "cookies"),
    (f"<div class=post><h2>Flood</h2><div class=entry><p>{_P}</p><p>{_Q}</p></div><div class=share><a href=x>Tweet</a> <a href=y>Mail</a></div></div><div class=sidebar><h3>Recent</h3>{_L}</div>", "Tweet"),
    (f"<nav>{_L}</nav><section class=story><h1>Flood</h1><p>{_P}</p><aside class=related><h4>Read more</h4><a href=/x>A storm is coming</a></aside><p>{_Q}</p></section>", "storm"),
    (f"<div class=page><div class=menu>{_L}</div><div class=text><h1>Flood</h1>{_P}<br><br>{_Q}<br></div></div>", "Weather"),
    (f"<form class=search><label>Search</label><input><button>Go</button></form><article><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></article>", "Search"),
    (f"<article><h1>Flood</h1><p>{_P}</p><div class=advertisement><p>Buy the best boots in town today!</p></div><p>{_Q}</p></article>", "boots"),
    (f"<main><h1>Flood</h1><p>{_P}</p><blockquote>{_Q}</blockquote></main><section id=comments><h2>2 comments</h2><ol><li><p>Nice one, thanks for it.</p></li><li><p>Terrible news for all of us.</p></li></ol></section>", "Terrible"),
    (f"<div class=breadcrumb><a href=/>Home</a> &gt; <a href=/n>News</a></div><article class=post><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></article><div class=newsletter><p>Subscribe to our newsletter.</p></div>", "newsletter"),
    (f"<div id=header><div id=logo>The Paper</div>{_M}</div><div id=main><h1>Flood</h1><p>{_P}</p><ul><li>{_Q}</li></ul></div><div id=footer>Imprint and legal</div>", "Imprint"),
    (f"<article><h1>Flood</h1><p>{_P}</p><pre>{_Q}</pre></article><div class=author><a href=/me>By Ann Lee</a></div>", "Ann Lee"),
    (f"<div class=container><div class=row><div class=col-8><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></div><div class=col-4><div class=widget><h3>Popular</h3>{_L}</div></div></div></div>", "Popular"),
    (f"<section><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></section><section class=promo><p>Only today: half the price of everything.</p></section>", "half the price"),
    (f"<script>var x='<p>no</p>'</script><div role=main><h1>Flood</h1><p>{_P}</p><p>{_Q}</p></div><div role=contentinfo class=site-footer><p>Copyright The Paper 2021</p></div>", "Copyright"),
]


def test_hand_made_pages():
    model = htmltext.trained()
    kept = total = spared = told = 0
    for page, (_, other) in zip(htmltext.main_blocks([p for p, _ in HAND_MADE], model), HAND_MADE):
        text = "\n".join(page)
        kept += sum(x in text for x in ("Flood", _P, _Q))
        total += 3
        if other:
            spared += other not in text
            told += 1
    assert kept >= 0.9 * total and spared >= 0.9 * told, (kept, total, spared, told)
