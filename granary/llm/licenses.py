"""License scans: short notices found with a bounded number of edits.

A text becomes its words (A-Z in lower case; anything but digits, letters and characters beyond ASCII parts
words), joined by one space. A notice of n characters may have n // 12 edits (insertions, deletions,
substitutions), begins where a word begins and ends where one ends. It is split into as many pieces as it may
have edits, and one more: a place within that many edits holds one piece unchanged (pigeonhole). One
Aho-Corasick automaton finds the pieces of all notices in one pass over the whole text; around each hit the
regex library's bounded-error matching looks for the best place and counts its edits. Of overlapping places of
one notice the one of fewest edits counts, then the first.

The base labels are plain: places where a phrase's words stand one after another, overlaps included.

Rows are independent of each other, so nothing is shuffled, and a task holds one batch of texts.

Defined results: a null text counts as empty; texts without words have ``n_words`` 0, no labels and score 0;
null ids, repeated rows and ties are kept as they are, a row each; texts are read whole, however long;
columns other than the id and the text are ignored, whatever they are called; an empty table gives no rows.
"""

from __future__ import annotations

import bisect
import functools
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.util import tune

#: Phrases and labels of the base.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

#: Short notices (words in lower case) and the labels that they give.
NOTICES = (
    ("gnu general public license", "gpl"),
    ("gnu general public licence", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu library general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("gnu free documentation license", "gfdl"),
    ("apache license", "apache"),
    ("licensed under the apache license version 2 0", "apache"),
    ("mit license", "mit"),
    ("mit licence", "mit"),
    ("permission is hereby granted free of charge to any person", "mit"),
    ("bsd license", "bsd"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("isc license", "isc"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("boost software license", "bsl"),
    ("european union public licence", "eupl"),
    ("open database license", "odbl"),
    ("artistic license", "artistic"),
    ("this is free and unencumbered software released", "unlicense"),
    ("dedicated to the public domain", "public-domain"),
    ("cc0 1 0 universal", "cc0"),
    ("cc by", "cc-by"),
    ("cc by sa", "cc-by-sa"),
    ("cc by nd", "cc-by-nd"),
    ("cc by nc", "cc-by-nc"),
    ("cc by nc sa", "cc-by-nc-sa"),
    ("cc by nc nd", "cc-by-nc-nd"),
    ("creative commons attribution", "cc-by"),
    ("creative commons attribution sharealike", "cc-by-sa"),
    ("creative commons attribution noncommercial", "cc-by-nc"),
    ("creative commons attribution noderivatives", "cc-by-nd"),
    ("all rights reserved", "all-rights-reserved"),
)
#: Characters of a notice for each edit that it may have.
FOR_EDIT = 12

#: Bytes of a text as they count: A-Z in lower case, what parts words as a space, the rest as it is.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

SPAN = "struct<label:string,notice:string,edits:int,first_word:long,n_words:long,start:long,end:long>"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_BYTES).split()


def allowed(notice: str, for_edit: int = FOR_EDIT) -> int:
    return len(notice) // for_edit


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """Place and text of edits + 1 pieces of nearly equal length."""
    at = [len(notice) * k // (edits + 1) for k in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(at, at[1:])]


class Finder:
    """The automaton of all pieces, and the notices' patterns."""

    def __init__(self, notices: Sequence[tuple[str, str]] = NOTICES, for_edit: int = FOR_EDIT):
        import ahocorasick
        import regex

        self.notices = [(n, label, allowed(n, for_edit)) for n, label in notices]
        if any(words_of(n) != n.encode().split(b" ") or not n for n, _, _ in self.notices):
            raise ValueError("a notice is words in lower case with one space between them")
        self.patterns = [regex.compile(rf"(?b)(?<![^ ])(?:{regex.escape(n, special_only=True, literal_spaces=True)}){{e<={e}}}(?![^ ])") if e else None for n, _, e in self.notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for i, (n, _, e) in enumerate(self.notices):
            for at, piece in pieces(n, e):
                seeds.setdefault(piece, []).append((i, at))
        self.automaton = ahocorasick.Automaton()
        for piece, of in seeds.items():
            self.automaton.add_word(piece, (len(piece), of))
        if seeds:
            self.automaton.make_automaton()
        self.seeds = bool(seeds)

    def places(self, norm: str) -> list[tuple[int, int, int, int]]:
        """notice's number, start, end, edits of the places in a normalised text, in order."""
        tried: set[tuple[int, int]] = set()
        found: list[tuple[int, int, int, int]] = []
        for last, (length, of) in self.automaton.iter(norm) if self.seeds else ():
            for i, at in of:
                start = last - length + 1 - at
                if (i, start) in tried:
                    continue
                tried.add((i, start))
                n, _, e = self.notices[i]
                end = start + len(n)
                if start >= 0 and norm.startswith(n, start) and norm[start - 1 : start] in ("", " ") and norm[end : end + 1] in ("", " "):
                    found.append((i, start, end, 0))
                elif e:
                    lo, hi, more = max(0, start - e), min(len(norm), end + e), "\0" * (e + 1)
                    # A word that the window cuts goes on with more foreign signs than there are edits, so it can't end there.
                    front = more if lo and norm[lo - 1] != " " else ""
                    m = self.patterns[i].search(front + norm[lo:hi] + (more if hi < len(norm) and norm[hi] != " " else ""))
                    if m:
                        found.append((i, m.start() - len(front) + lo, m.end() - len(front) + lo, sum(m.fuzzy_counts)))
        out: list[tuple[int, int, int, int]] = []
        held: dict[int, list[tuple[int, int]]] = {}
        for i, start, end, edits in sorted(found, key=lambda p: (p[3], p[1], p[2])):
            near = held.setdefault(i, [])
            if not _overlaps(near, start, end):
                out.append((i, start, end, edits))
        return sorted(out, key=lambda p: (p[1], p[2], p[0]))


def _overlaps(held: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether a span meets one of ``held`` (sorted, apart from each other); it is added if not."""
    k = bisect.bisect_left(held, (start, end))
    if k and held[k - 1][1] > start or k < len(held) and held[k][0] < end:
        return True
    held.insert(k, (start, end))
    return False


@functools.cache
def finder(notices: tuple = NOTICES, for_edit: int = FOR_EDIT) -> Finder:
    return Finder(notices, for_edit)


def _starts(norm: bytes, phrase: str) -> Iterator[int]:
    """Word places of a phrase in words that are joined, begun and ended by one space."""
    sought, at, word, counted = b" " + phrase.encode() + b" ", -1, 0, 0
    while (at := norm.find(sought, at + 1)) >= 0:
        word += norm.count(b" ", counted, at)
        counted = at
        yield word


def scanned(text: str | None, notices: tuple = NOTICES, base: tuple = BASE, for_edit: int = FOR_EDIT) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score, spans of one text."""
    text = text or ""
    words = words_of(text)
    norm = b" ".join(words)
    framed = b" " + norm + b" "
    starts, labels = [], set()
    for phrase, label in base:
        if here := list(_starts(framed, phrase)):
            starts += here
            labels.add(label)
    f, plain = finder(notices, for_edit), norm.decode()
    spans, word, counted = [], 0, 0
    for i, start, end, edits in f.places(plain):
        word += plain.count(" ", counted, start)
        counted = start
        spans.append([f.notices[i][1], f.notices[i][0], edits, word, plain.count(" ", start, end) + 1])
    if spans:  # where the words stand in the text itself
        asked = {w for s in spans for w in (s[3], s[3] + s[4] - 1)}
        at = {k: m.span() for k, m in enumerate(_WORD.finditer(text)) if k in asked}
        spans = [(*s, at[s[3]][0], at[s[3] + s[4] - 1][1]) for s in spans]
    score = max([1.0 if starts else 0.0, *(1 - s[2] / len(s[1]) for s in spans)])
    both = labels | {s[0] for s in spans}
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)), ",".join(sorted(both)), score, spans


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text", notices: Sequence[tuple[str, str]] = NOTICES, base: Sequence[tuple[str, str]] = BASE, for_edit: int = FOR_EDIT) -> DataFrame:
    """doc_id, n_words, n_base (places of base phrases), first_word, last_word, base_labels, labels, score (the best
    place's share of characters without an edit) and spans (label, notice, edits, first_word, n_words, and start
    and end in characters of the text)."""
    tune(df.sparkSession)
    kind = dict(df.dtypes)[doc_id]
    notices, base = tuple(map(tuple, notices)), tuple(map(tuple, base))
    fields = ("label", "notice", "edits", "first_word", "n_words", "start", "end")
    span = pa.struct([pa.field(n, pa.string() if n in fields[:2] else pa.int32() if n == "edits" else pa.int64()) for n in fields])

    def run(batches):
        for b in batches:
            got = [scanned(t, notices, base, for_edit) for t in b.column(1).to_pylist()]
            cols = [[g[k] for g in got] for k in range(7)] + [[[dict(zip(fields, s)) for s in g[7]] for g in got]]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), pa.list_(span)]
            names = [b.schema.names[0], "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=names)

    schema = f"`{doc_id}` {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<{SPAN}>"
    return df.select(doc_id, df[text].cast("string").alias("_t")).mapInArrow(run, schema)
