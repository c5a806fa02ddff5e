"""Hard negatives and phrase collocations against brute force."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from granary.llm import negatives, phrases

KIND = "vec_id long, label int, embedding array<float>, q string, id int, cell int"  # clashing extra columns


def plain_negatives(rows, k=5, m=10):
    held = {}
    for i, label, v in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        q = [math.floor(256 * float(np.float32(x))) for x in v]
        if sum(x * x for x in q) < 1 << 62:
            held[i] = min(held.get(i, (label, q)), (label, q))
    out = []
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    for i in sorted(held):
        if i % 100:
            continue
        label, q = held[i]
        best = sorted((-dot(q, w), j, lab) for j, (lab, w) in held.items() if j != i)
        for s, p, _ in [x for x in best if x[2] == label][:k]:
            fits = [(n, -t) for t, n, lab in best if lab != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, p, r + 1, n, -s, t) for r, (n, t) in enumerate(fits[:m])]
    return sorted(out)


def vectors(seed, n, dim, clusters=0):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, dim)) + (rng.standard_normal((clusters, dim))[rng.integers(0, clusters, n)] * 6 if clusters else 0)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    return [(i * 5, int(rng.integers(0, 3)), [float(v) for v in x[i].astype(np.float32)]) for i in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], KIND)


@pytest.mark.parametrize("clusters", [0, 8])
def test_negatives_equal_brute_force(spark, monkeypatch, clusters):
    monkeypatch.setattr(negatives, "FIRST", 40)
    monkeypatch.setattr(negatives, "GROW", 3)
    monkeypatch.setattr(negatives, "PIVOTS", 6)
    monkeypatch.setattr(negatives, "VALUES", 500)
    rows = vectors(clusters, 600, 7, clusters)
    hot = rows[3][2]
    rows += [(10_000 + i, i % 2, hot) for i in range(300)]  # a third has one vector
    rows += [(20_000, 0, hot), (20_000, 0, hot), (20_001, None, hot), (None, 1, hot), (20_100, 1, None), (20_200, 1, [0.1, None]), (20_300, 1, [float("nan")]), (20_400, 1, [float("inf")] * 7)]
    rows += [(20_500, 1, [0.0] * 7), (20_600, 1, []), (20_700, 2, [0.5] * 3), (20_800, 2, [0.25] * 12), (20_900, 1, [-0.5] * 7), (5, 2, hot)]
    got = sorted(tuple(r) for r in negatives.mine(table(spark, rows)).collect())
    want = plain_negatives(rows)
    assert got == want and len(want) > 100


def test_negatives_of_large_numbers_and_small_tables(spark):
    rows = [(k * 50, k % 2, [3e5 * math.sin(k * j + 1) for j in range(1, 5)]) for k in range(60)] + [(9_000, 0, [1e30, 0.0, 0.0, 0.0])]
    assert sorted(tuple(r) for r in negatives.mine(table(spark, rows)).collect()) == plain_negatives(rows)
    for some in ([], rows[:1], rows[:2], [(1, 0, [1.0]), (2, 1, [1.0])]):
        assert sorted(tuple(r) for r in negatives.mine(table(spark, some)).collect()) == plain_negatives(some)


def test_keys_exclude_cells_of_clustered_points(spark, monkeypatch):
    monkeypatch.setattr(negatives, "FIRST", 100)
    rows = vectors(1, 1500, 8, 12)
    seen = []
    real = negatives.planned

    def counted(state, space, cells, budget):
        out = real(state, space, cells, budget)
        seen.append(sum(cells.rows[a.cell] for r in out.select("at").collect() for a in r["at"]))
        return out

    monkeypatch.setattr(negatives, "planned", counted)
    got = sorted(tuple(r) for r in negatives.mine(table(spark, rows)).collect())
    assert got == plain_negatives(rows)
    anchors = sum(r[0] % 100 == 0 for r in rows)
    first = seen[: seen.index(0)]  # the positives' rounds
    assert sum(first) < 0.5 * anchors * len(rows)


def plain_phrases(rows, least, top=2000, hides=80):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= hides * c[p[i : i + k]]}
        rows_ = []
        for p, a in cand.items():
            if p not in gone:
                score, _, left, right = min((2_000_000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
                rows_.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, r + 1, p.decode(), -a, left, right, n[lang], -s) for r, (s, a, p, left, right) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def corpus(seed, n=300):
    rng = random.Random(seed)
    vocab = [f"{rng.choice('äbcдe日')}{k}" for k in range(40)] + ["a\xa0b", "\x1cq", "O'Neil"]
    rows = []
    for k in range(n):
        words = [rng.choice(vocab[: 3 + rng.randrange(40)]) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!"]) for w in words)
        rows.append((text, rng.choice(["en", "de", None, "en", "en"])))
    rows += [("New York City Hall opens. " * 40, "en"), ("the the the the the " * 200, "en"), (None, "en"), ("", "fr"), (" .,;", None), ("word", "xx"), ("ends with new york", "en")]
    return rows + rows[:40] * 3


COLUMNS = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]


def phrase_rows(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("small", [phrases.WORDS, 0])
def test_phrases_equal_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(phrases, "CHUNK", 501)
    monkeypatch.setattr(phrases, "RANGE", 400)
    monkeypatch.setattr(phrases, "BLOB", 50)
    monkeypatch.setattr(phrases, "BLOCK", 5000)
    monkeypatch.setattr(phrases, "HELD", 60)
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, "x", 1, b"y") for r in rows], "text string, lang string, word string, n int, gram binary")
    got = phrase_rows(phrases.mine(docs, least=8, top=60, small=small))
    want = plain_phrases(rows, 8, 60)
    assert got == want and any(r[2].count(" ") == 3 for r in want)


def test_phrases_of_tables_with_nothing_to_find(spark):
    kind = "text string, lang string"
    for rows in ([], [("", "en"), (None, None)], [("a b c", "en")] * 29):
        assert phrase_rows(phrases.mine(spark.createDataFrame(rows, kind))) == plain_phrases(rows, 30) == []
    rows = [("a b c", "en")] * 30 + [("Ä b", None)] * 31
    assert phrase_rows(phrases.mine(spark.createDataFrame(rows, kind))) == plain_phrases(rows, 30)


def test_scores_past_64_bits(spark):
    big = 8_000_000_000_000_000_000
    words = spark.createDataFrame([(1, "en", b"a", big), (2, "en", b"b", big)], "id long, lang string, word binary, n long")
    grams = spark.createDataFrame([(b"\0\0\0\1\0\0\0\2", big - 1)], "gram binary, a long")
    r = phrases.scored(grams, words).first()
    assert r.score == 2_000_000 * (big - 1) // (2 * big) and (r.l, r.r, r.lang) == (big, big, "en")


def test_ranges_follow_the_counts():
    starts, weights = np.array([1, 2, 3, 4]), np.array([5000.0, 300, 200, 100])
    hi, lo = phrases.bounds(starts, weights, 500)
    keys = list(zip(hi.tolist(), lo.tolist()))
    assert keys == sorted(set(keys)) and len(keys) > 8 and any(k[1] for k in keys)
    rng = np.random.default_rng(0)
    x, y = (rng.integers(0, 1 << 62, 1000, dtype=np.uint64) % np.uint64(7) << np.uint64(s) for s in (33, 15))
    assert (phrases.radix_order(x, y) == np.lexsort((y, x))).all()
    for width in (1, 2, 3, 4):
        top = (1 << 8 * width) - 1
        a, b = np.array([1 << 32 | top, top << 32 | 1], np.uint64), np.array([0, top << 32 | top], np.uint64)
        back = phrases.unpacked(phrases.packed(a, b, width).tobytes(), width)
        assert (back[0] == a).all() and (back[1] == b).all()
