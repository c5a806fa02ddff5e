"""License scans against plain dynamic programming over the whole text."""

import random
import re

import pytest

from granary.llm import licenses as L


def plain_places(norm, notice, edits):
    """Ends of word-bounded places within the allowed edits, with the fewest edits that reach them (Sellers)."""
    out = {}
    for start in [0] + [m.end() for m in re.finditer(" ", norm)]:
        row = list(range(len(notice) + 1))
        for end in range(start, min(len(norm), start + len(notice) + edits) + 1):
            if row[-1] <= edits and (end == len(norm) or norm[end] == " ") and end > start:
                out[(start, end)] = row[-1]
            if end < len(norm):
                new = [row[0] + 1]
                for k, c in enumerate(notice):
                    new.append(min(row[k] + (c != norm[end]), row[k + 1] + 1, new[-1] + 1))
                row = new
    return out


def spoilt(rng, notice, edits):
    s = list(notice)
    for _ in range(edits):
        at = rng.randrange(1, len(s) - 1)
        kind = rng.randrange(3)
        if kind == 0:
            s[at] = rng.choice("abcxyz")
        elif kind == 1:
            s.insert(at, rng.choice("abcxyz "))
        else:
            del s[at]
    return "".join(s)


def test_nothing_within_the_edits_is_missed():
    rng, finder = random.Random(4), L.finder()
    for _ in range(8):
        words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 30))]
        for _ in range(rng.randint(1, 3)):
            notice = rng.choice(L.NOTICES)[0]
            words.insert(rng.randint(0, len(words)), spoilt(rng, notice, rng.randint(0, L.allowed(notice) + 1)))
        norm = " ".join(" ".join(words).split())
        got = finder.places(norm)
        for i, (notice, _, e) in enumerate(finder.notices):
            plain = plain_places(norm, notice, e)
            mine = [(s, t, k) for j, s, t, k in got if j == i]
            assert all(plain[(s, t)] == k for s, t, k in mine)
            for s, t in plain:  # each place is one that was found or overlaps a better one
                assert any(a < t and s < b for a, b, _ in mine), (norm, notice, norm[s:t])
            assert all(b <= c for (_, b, _), (c, _, _) in zip(mine, mine[1:]))


def plain_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    at, labels = [], set()
    for phrase, label in L.BASE:
        p = phrase.split(" ")
        here = [i for i in range(len(words)) if words[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


EDGES = [
    None, "", " \t\n", "MIT License", "mit-license, MIT\nLICENSE mit_license", "Übermit license", "mit license" * 3, "cc by cc by\x00cc by-nc 4.0", "ＭＩＴ License K", "mit license " * 20_000,
    "x" * 300_000 + " apache licence.", "Licensed under the Apache License, Version 2.0", "GNU Lesser General Public License", "Free text about a license and what is licensed.",
]


@pytest.mark.parametrize("text", EDGES)
def test_base_is_plain(text):
    got = L.scanned(text)
    assert got[:5] == plain_base(text)
    assert 0 <= got[6] <= 1 and set(filter(None, got[4].split(","))) <= set(filter(None, got[5].split(",")))
    for label, notice, edits, first, n, start, end in got[7]:
        assert L.words_of(text)[first : first + n] == L.words_of(text[start:end]) and edits <= L.allowed(notice)


def test_scan_as_a_table(spark):
    rows = [(None if k == 1 else k, t, "a", 1.0) for k, t in enumerate(EDGES + EDGES[:4])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _t string, n_words double")
    got = L.scan(docs).collect()
    assert len(got) == len(rows)
    want = sorted([(r[0], *L.scanned(r[1])[:7]) for r in rows], key=str)
    assert sorted([tuple(r)[:8] for r in got], key=str) == want
    assert L.scan(docs.limit(0)).count() == 0
    fuzzy = L.scan(spark.createDataFrame([(1, "Released under teh Apache  Licens, see GNU Genral Public Licence.")], "doc_id long, text string")).first()
    assert fuzzy.labels == "apache,gpl" and fuzzy.base_labels == "" and 0 < fuzzy.score < 1
    assert {(s.label, s.edits, s.start, s.end) for s in fuzzy.spans} >= {("apache", 1, 19, 33), ("gpl", 1, 39, 64)}


def test_own_notices_and_words_that_are_no_notice(spark):
    docs = spark.createDataFrame([(1, "All internal use only, please"), (2, "internal use")], "doc_id long, text string")
    got = {r.doc_id: r.labels for r in L.scan(docs, notices=[("internal use only", "internal")], base=[]).collect()}
    assert got == {1: "internal", 2: ""}
    with pytest.raises(ValueError):
        L.Finder([("Two  Spaces", "x")])
