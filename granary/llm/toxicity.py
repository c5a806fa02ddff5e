"""Toxicity with noisy-channel deobfuscation.

A word written to slip past a filter (digits and signs for letters, signs or spaces between letters,
letters repeated, letters starred out) is a path through a lattice: each sign may stand for some
letters or for nothing, and a repeated letter for one or two. A Viterbi search decodes the lattice
under a character language model learned from the corpus, and the restored text is scored.

The score is a logistic regression over the beginnings of words (3 to 6 letters) and whole words
that are much more frequent in toxic texts than in others; which ones is counted over the training
rows. A text counts as a set of these marks, so its length does not matter, and all of it is read.

The language model counts the words of all texts; weights are fitted on at most ``sample`` labelled
rows, chosen by a hash of the id, equal texts once. Scoring is one pass without a shuffle. The search
is exact: a state is the last three letters, and no state is let go.

Defined results: null and empty texts get the score of a text without marks; labels that are null,
or of documents that are not there, are left out; of several labels of a document the highest
counts; with no labels every document has score 0; repeated rows are scored one by one; other
columns are kept by ``select``, whatever they are called, and ignored otherwise.
"""

from __future__ import annotations

import functools
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from granary.llm.util import cut, free_name, tune

SAMPLE = 20_000
ORDER = 4
#: Grams of the character model, the most frequent ones, and letters that it tells apart.
GRAMS, LETTERS = 300_000, 44
#: Distinct tokens from which a task cuts grams at a time, and lists of rare grams that it holds.
CHUNK, OTHERS = 30_000, 40
LEAST = 5  # texts that a mark must stand in
ODDS = 2.0  # log odds from which a mark is kept
#: Tokens, characters in them, and windows that a task remembers; tokens with all their marks, and marks that it counts at a time.
REMEMBERED, REMEMBERED_CHARS, WINDOWS = 150_000, 4_000_000, 30_000
WITH_MARKS, MARKS = 40_000, 40_000
CUTOFF = 0.5

#: What signs may stand for, besides nothing. Fixed values.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "¢": "c", "¥": "y",
}
#: Signs that hide any one letter.
WILD = "*#%"
_SPACED = re.compile(r"(?<!\S)\S(?:[ \t.\-_*·]\S){2,}(?!\S)")
_SEPARATORS = ".-_*·"
_STOPS = ".,;:?\"'()[]{}“”„«»…"
#: What it costs that a space is nothing.
SPACE_COST = 4.0
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")
_PLAIN = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"([^\W\d_])\1\1")
_REPEATED = re.compile(r"(.)\1+")


# Symbols of the dense table: nothing before, the beginning and end of a word, no letter, other letters.
PAD, BEGIN, END_OF_WORD, NONE, OTHER = range(5)


def _unpacked(counts: dict[str, int] | tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of each gram, zeros before short ones, and its count."""
    if isinstance(counts, dict):
        points = [[*[0] * (ORDER - len(g)), *map(ord, g)] for g in counts]
        return np.array(points, dtype=np.uint32).reshape(-1, ORDER), np.fromiter(counts.values(), dtype=np.int64, count=len(counts))
    grams, n = counts
    return np.stack([grams >> np.uint64(16 * k) & np.uint64(0xFFFF) for k in range(ORDER - 1, -1, -1)], axis=1).astype(np.uint32), n


class CharModel:
    """An interpolated character model of words, with an end mark. Letters that are not among the
    ``LETTERS`` most frequent are one symbol that is never counted."""

    def __init__(self, counts: dict[str, int] | tuple[np.ndarray, np.ndarray]):
        """``counts``: of grams, as texts or packed with 16 bits a letter."""
        self.given = counts
        points, n = _unpacked(counts)
        single = np.flatnonzero((points[:, -2] == 0) & (points[:, -1] > 0))
        by_count = sorted(((-c, g) for c, g in zip(n[single].tolist(), map(chr, points[single, -1].tolist())) if g.isalpha()))
        self.letters = sorted(g for _, g in by_count[:LETTERS])
        self.code = {"^": BEGIN, "$": END_OF_WORD} | {c: OTHER + 1 + k for k, c in enumerate(self.letters)}
        self.size = OTHER + 1 + len(self.letters)
        self.memo: dict[tuple[str, str], float] = {}
        #: The symbol of every code point; 0 and 1 stand for nothing before and no letter.
        self.lookup = np.full(0x110000, OTHER, dtype=np.uint8)
        for c, k in self.code.items():
            self.lookup[ord(c)] = k
        self.lookup[:2] = PAD, NONE
        symbols = self.lookup[points]
        known = (symbols != OTHER).all(axis=1)
        self.dense = self._dense(symbols[known], n[known])
        self.flat = memoryview(self.dense)

    @functools.cached_property
    def counts(self) -> dict[str, int]:
        known, (points, n) = {*self.letters, "^", "$"}, _unpacked(self.given)
        grams = ("".join(map(chr, filter(None, p))) for p in points.tolist())
        return {g: c for g, c in zip(grams, n.tolist()) if known.issuperset(g)}

    @functools.cached_property
    def context(self) -> dict[str, int]:
        out: dict[str, int] = {}
        for g, n in self.counts.items():
            out[g[:-1]] = out.get(g[:-1], 0) + n
        return out

    def logp(self, before: str, c: str) -> float:
        key = (before[-(ORDER - 1) :], c)
        v = self.memo.get(key)
        if v is None:
            p = 1e-4
            for k in range(ORDER):
                ctx = key[0][len(key[0]) - k :] if k else ""
                if k > len(key[0]):
                    break
                n = self.context.get(ctx, 0)
                if n:
                    lam = n / (n + 3.0)
                    p = lam * self.counts.get(ctx + c, 0) / n + (1 - lam) * p
            v = math.log(max(p, 1e-12))
            if len(self.memo) < 30_000:
                self.memo[key] = v
        return v

    def _dense(self, symbols: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``logp`` of every fourth symbol after every three, flat; 0 for ``NONE``."""
        s = self.size
        p = np.full((s,) * ORDER, 1e-4, dtype=np.float32)
        for k in range(ORDER):  # contexts of k symbols; what stands further back does not matter
            found = np.zeros((s,) * (k + 1), dtype=np.float32)
            own = (symbols > PAD).sum(axis=1) == k + 1
            found[tuple(symbols[own, ORDER - 1 - k :].T)] = n[own]
            total = found.sum(axis=-1, keepdims=True, dtype=np.float64).astype(np.float32)
            p *= 3 / (total + 3)
            found /= total + 3
            p += found
        np.maximum(p, 1e-12, out=p)
        np.log(p, out=p)
        p[..., NONE] = 0
        return p.ravel()

    def codes(self, text: str) -> list[int]:
        return [self.code.get(c, OTHER) for c in text]


def grams_of(word: str) -> list[str]:
    w = f"^{word}$"
    return [w[max(0, i - k + 1) : i + 1] for i in range(1, len(w)) for k in range(1, ORDER + 1) if i - k + 1 >= 0]


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """For each place the letters it may stand for, with a cost. A run of one letter or sign is a
    place, and so is a run of signs that hide any letter."""
    out: list[list[tuple[str, float]]] = []
    i = 0
    while i < len(token):
        c, j = token[i], i + 1
        while j < len(token) and (token[j] == c or (c in WILD and token[j] in WILD)):
            j += 1
        n = j - i
        if c.isalpha():
            arcs = [(c * n, 0.0)] if n <= 2 else []
            if n > 1:
                arcs += [(c, 0.5 if n == 2 else 0.0)]
            if n > 2:
                arcs += [(c + c, 1.0)]
            out.append(arcs)
        else:
            arcs = [("", 2.0 if c in LEET else 0.2)]
            arcs += [(x, 0.3) for x in LEET.get(c, "")] + [(x + x, 0.6) for x in LEET.get(c, "") if n > 1]
            if c in WILD:
                arcs.append(("?", 0.5))
            out.append(arcs)
        i = j
    return out


#: An arc on which a word ends, and what any letter costs besides its arc.
END_ARC, ANY_COST = " ", 1.5
#: Places of any letter from which a lattice is searched in arrays.
WILD_PLACES = 3


def decode(token: str, model: CharModel) -> str:
    """The most probable word behind a token."""
    return viterbi(lattice(token), model)


def parted(tokens: tuple[str, ...], model: CharModel) -> list[str]:
    """The most probable words behind neighbouring tokens: a space, or a sign in a token, may be
    nothing or the end of a word."""
    places: list[list[tuple[str, float]]] = []
    for t in tokens:
        if places:
            places.append([("", SPACE_COST), (END_ARC, 0.0)])
        places += [arcs if arcs[0][0] else [*arcs, (END_ARC, 1.0)] for arcs in lattice(t)]
    return viterbi(places, model).split()


def viterbi(places: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The most probable path; a state is the last letters. Paths are chains of steps, so the search
    is linear in the number of places."""
    if sum(arcs[-1][0] == "?" or (len(arcs) > 1 and arcs[-2][0] == "?") for arcs in places) >= WILD_PLACES:
        return viterbi_in_arrays(places, model)
    size, cube, flat, codes = model.size, model.size**3, model.flat, model.codes
    begin = (PAD * size + PAD) * size + BEGIN
    states: dict[int, tuple[float, tuple | None]] = {begin: (0.0, None)}
    any_letter = [(x, (model.code[x],)) for x in model.letters]
    for arcs in places:
        nxt: dict[int, tuple[float, tuple | None]] = {}
        steps = []
        for letters, cost in arcs:
            if letters == "?":
                steps += [(x, c, cost + ANY_COST) for x, c in any_letter]
            else:
                steps.append((letters, (END_OF_WORD,) if letters == END_ARC else codes(letters), cost))
        for ctx, (s, path) in states.items():
            for x, word, cost in steps:
                t, c = s - cost, ctx
                if x == END_ARC:
                    if c != begin:
                        t += flat[c * size + END_OF_WORD]
                    c = begin
                else:
                    for k in word:
                        at = c * size + k
                        t += flat[at]
                        c = at % cube
                if c not in nxt or nxt[c][0] < t:
                    nxt[c] = (t, (path, x) if x else path)
        states = nxt

    def spelt(path) -> str:
        out = []
        while path:
            path, x = path
            out.append(x)
        return "".join(reversed(out))

    ends = [(s + (0.0 if c == begin else flat[c * size + END_OF_WORD]), path) for c, (s, path) in states.items()]
    best = max(t for t, _ in ends)
    return max(spelt(path) for t, path in ends if t == best)


def viterbi_in_arrays(places: list[list[tuple[str, float]]], model: CharModel) -> str:
    """The same for lattices with many places of any letter, where states are thousands: all states
    take a step together."""
    s, g = model.size, model.dense
    begin = (PAD * s + PAD) * s + BEGIN
    state, score = np.array([begin]), np.zeros(1)
    any_letter = np.array([model.code[c] for c in model.letters], dtype=np.int64)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    spelling: dict[str, int] = {}
    for arcs in places:
        to, far, came, wrote = [], [], [], []
        for letters, cost in arcs:
            word = spelling.setdefault(letters, len(spelling))
            at = np.arange(len(state))
            if letters == END_ARC:
                new = np.full(len(state), begin)
                t = score - cost + np.where(state == begin, 0.0, g[state * s + END_OF_WORD])
                w = np.full(len(state), word)
            elif letters == "?":
                each = (state[:, None] * s + any_letter).ravel()
                t = (np.repeat(score, len(any_letter)) + g[each]) - cost - ANY_COST
                new, at = each % s**3, np.repeat(at, len(any_letter))
                w = np.tile(np.array([spelling.setdefault(c, len(spelling)) for c in model.letters], dtype=np.int64), len(state))
            else:
                new, t, w = state, score - cost, np.full(len(state), word)
                for code in model.codes(letters):
                    each = new * s + code
                    t, new = t + g[each], each % s**3
            to.append(new), far.append(t), came.append(at), wrote.append(w)
        new, t, at, w = (np.concatenate(x) for x in (to, far, came, wrote))
        order = np.lexsort((-t, new))
        first = order[np.concatenate([[True], new[order][1:] != new[order][:-1]])]
        state, score = new[first], t[first]
        steps.append((at[first].astype(np.int32), w[first].astype(np.int32)))
    k = int(np.argmax(score + np.where(state == begin, 0.0, g[state * s + END_OF_WORD])))
    names, out = list(spelling), []
    for came, wrote in reversed(steps):
        out.append(names[wrote[k]])
        k = int(came[k])
    return "".join(reversed(out))


def marks(word: str) -> list[str]:
    """The word itself and its beginnings."""
    return [f"={word}", *(f"^{word[:k]}" for k in range(3, 7) if k < len(word))]


def collapsed(text: str) -> str:
    return _REPEATED.sub(r"\1", text)


class Tokens(dict):
    """The number of each token, and what is known of it in arrays: whether it has marks, and the
    codes and costs of the end and the beginning of its plain form. New tokens are noted when they are
    met and learned together."""

    def __init__(self, reader: Reader):
        self.reader = reader
        self.forget()

    def forget(self) -> None:
        self.clear()
        self.marks: dict[int, tuple[str, ...]] = {}
        self.held, self.new = 0, []
        self.learned = 0
        self.single, self.marked, self.lone = np.zeros(4096, dtype=bool), np.zeros(4096, dtype=bool), np.zeros(4096, dtype=np.int8)
        self.ends, self.begins = np.zeros(4096), np.zeros(4096)
        self.tail, self.h1, self.h2, self.h3 = (np.zeros(4096, dtype=np.int64) for _ in range(4))

    def __missing__(self, token: str) -> int:
        k = self[token] = len(self)
        self.new.append(token)
        return k

    def learn(self) -> None:
        """Learn what is new."""
        new, reader, first = self.new, self.reader, self.learned
        if not new:
            return
        self.new, self.learned = [], len(self)
        while self.learned > len(self.marked):
            for name in ("marked", "single", "lone", "ends", "begins", "tail", "h1", "h2", "h3"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate([old, np.zeros_like(old)]))
        self.held += sum(map(len, new))
        starts = reader.starts if reader.wanted is not None else None
        for k, token in enumerate(new, first):
            if len(token) == 1 or token[1] in _SEPARATORS:  # lone letters, as ``_SPACED`` has them
                self.lone[k] = min(len(token), 100)
            if starts is not None:
                core = token.strip(_STOPS)
                if core.isalpha() and not _RUN.search(core):  # a plain word
                    if core[:3] in starts and (v := reader.of_word(core)):
                        self.marks[k] = v
                        self.marked[k] = True
                    continue
            v = reader.word(token)
            if v:
                self.marks[k] = v
                self.marked[k] = True
        if not reader.model:
            return
        s, g = reader.model.size, reader.model.dense
        forms = [t if t.isalpha() else self.form(t) for t in new]
        wide = "".join([("\0\0^" + f)[-3:] + (f[:3] + "$\1\1")[:3] for f in forms])
        codes = reader.model.lookup[np.frombuffer(wide.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)].reshape(-1, 6).astype(np.int64)
        tail = (codes[:, 0] * s + codes[:, 1]) * s + codes[:, 2]
        h1, h2, h3 = codes[:, 3], codes[:, 4], codes[:, 5]
        top = (PAD * s + PAD) * s + BEGIN
        begins = -(g[top * s + h1].astype(np.float64) + g[(PAD * s + BEGIN) * s * s + h1 * s + h2] + g[(BEGIN * s + h1) * s * s + h2 * s + h3])
        lengths = np.fromiter(map(len, forms), dtype=np.int64, count=len(forms))
        for name, v in (("single", lengths == 1), ("ends", np.where(lengths > 0, -g[tail * s + END_OF_WORD], -np.inf)), ("begins", np.where(lengths > 0, begins, -np.inf)), ("tail", tail), ("h1", h1), ("h2", h2), ("h3", h3)):
            getattr(self, name)[first : self.learned] = v

    def form(self, token: str) -> str:
        """The letters behind a token that are not all letters themselves; none if there are none."""
        inner = token.strip(_STOPS)
        if inner.isalpha():
            return inner
        form = _EDGE.sub("", token)
        if form.isalpha():
            return form
        if form:
            return decode(inner, self.reader.model) if any(c.isalpha() for c in inner) else ""
        return LEET.get(inner, "")[:1] or ("e" if inner and inner in WILD else "")


class Reader:
    """Turns texts into marks; remembers what each token gave. Without ``spaces``, each token is read
    by itself."""

    def __init__(self, model: CharModel | None, wanted: set[str] | None = None, spaces: bool = True):
        self.model, self.wanted, self.spaces = model, wanted, spaces
        self.windows: dict[tuple[str, ...], tuple[str, ...]] = {}
        if wanted is not None:
            self.starts = {m[1:4] for m in wanted}
            self.whole, self.heads = {m[1:] for m in wanted if m[0] == "="}, {m[1:] for m in wanted if m[0] == "^"}
            self.short = {collapsed(m[1:]) for m in wanted}
            self.beginnings = {m[:k] for m in self.short for k in range(1, len(m) + 1)}
            self.letters = sorted({c for m in self.short for c in m})
        self.tokens = Tokens(self)

    def found(self, words: list[str]) -> tuple[str, ...]:
        if self.wanted is None:
            return tuple(m for w in words for m in marks(w))
        return tuple(m for w in words if w[:3] in self.starts for m in self.of_word(w))

    def of_word(self, word: str) -> tuple[str, ...]:
        """The marks of one word that are wanted."""
        n = len(word)
        if n < 3:
            return ()
        out = [f"={word}"] if word in self.whole else []
        out += [f"^{word[:k]}" for k in range(3, min(7, n)) if word[:k] in self.heads]
        return tuple(out)

    def word(self, token: str) -> tuple[str, ...]:
        return self.found(self.restored(token))

    def restored(self, token: str) -> list[str]:
        """The words in one token of lower-case text, as far as they are or hide words."""
        core = _EDGE.sub("", token) if not token.isalpha() else token
        if not core and not token:
            return []
        plain = _PLAIN.fullmatch(core)
        if plain:
            words = [core]
            if self.model and _RUN.search(core):
                words.append(decode(core, self.model))
        else:
            words = _PLAIN.findall(core)
        # Signs at the ends may be letters too, as in "$cum".
        inner = token.strip(_STOPS)
        if self.model and not plain and any(c.isalpha() for c in inner):
            for hidden in {inner: 0, core: 0}:
                if self.possible((hidden,), False):
                    words += [decode(hidden, self.model), *parted((hidden,), self.model)]
        elif self.model and inner != core and any(c in LEET or c in WILD for c in inner) and core and len({*inner} - {*core}) <= 1 and len(inner) - len(core) <= 2:
            words.append(decode(inner, self.model))
        return list(dict.fromkeys(w for w in words if len(w) > 2))

    def ids(self, text: str | None) -> set[str]:
        """The marks of a text."""
        low = (text or "").lower()
        known = self.tokens
        if len(known) > (REMEMBERED if self.wanted is not None else WITH_MARKS) or known.held > REMEMBERED_CHARS:
            known.forget()
        split = low.split()
        at = np.fromiter(map(known.__getitem__, split), dtype=np.int64, count=len(split))
        known.learn()
        out = {m for k in set(at[known.marked[at]].tolist()) for m in known.marks[k]}
        if self.model:
            lone = known.lone[at]
            for m in _SPACED.finditer(low) if (lone > 2).any() or ((lone[1:] > 0) & (lone[:-1] > 0)).any() else ():
                joined = re.sub(r"[ \t.\-_·]", "", m[0])
                if not joined.isdigit():
                    out.update(self.word(joined))
            if self.spaces and len(split) > 1:
                out.update(self.over_spaces(split, at))
        return out

    def joined(self, at: np.ndarray) -> np.ndarray:
        """Whether the model reads two neighbours rather as one word, as far as it sees over the space."""
        t, s, g = self.tokens, self.model.size, self.model.dense
        a, b = at[:-1], at[1:]
        tail, h1, h2, h3 = t.tail[a], t.h1[b], t.h2[b], t.h3[b]
        second = tail % (s * s) * s + h1
        gain = t.ends[a] + t.begins[b] - SPACE_COST
        gain += g[tail * s + h1]
        gain += g[second * s + h2]
        gain += g[(second % (s * s) * s + h2) * s + h3]
        return (gain > 0) | (t.single[a] & t.single[b])

    def possible(self, window: tuple[str, ...], over: bool = True) -> bool:
        """Whether a word that the window can be parted into may have a mark that is wanted (with
        ``over``, one that goes over a space): the lattice is walked from each place where a word may
        begin, as long as the letters, repeats aside, are the beginning of such a mark. All walks go on together."""
        if self.wanted is None:
            return True
        alive: set[tuple[str, bool]] = set()  # letters so far, and whether they go over a space
        for t in window:
            if over and any(x in self.short for x, _ in alive):
                return True
            alive = {(x, True) for x, _ in alive if x}
            # Of a plain token all letters stand at the beginning of a word that goes over its end.
            begin = not (over and t.isalpha()) or collapsed(t) in self.beginnings
            if not begin and not alive:
                continue
            for arcs in lattice(t):
                if begin:
                    alive.add(("", False))
                nxt = set()
                for letters, _ in arcs:
                    for y in self.letters if letters == "?" else (letters,):
                        for x, crossed in alive:
                            z = x if not y or (x and x[-1] == y[0]) else x + y[0]
                            if not z or z in self.beginnings:
                                nxt.add((z, crossed))
                if any((crossed or not over) and z in self.short for z, crossed in nxt):
                    return True
                alive, begin = nxt, any(not letters for letters, _ in arcs)  # within a token words begin after signs only
                if not alive and t.isalpha():
                    break
        return False

    def over_spaces(self, split: list[str], at: np.ndarray) -> set[str]:
        """The marks of words that spaces or line ends part: where the model would rather join two
        neighbours, the whole stretch of such neighbours is decoded."""
        where = np.flatnonzero(self.joined(at))
        out: set[str] = set()
        if not len(where):
            return out
        breaks = np.flatnonzero(np.diff(where) > 1)
        begins, ends = where[np.concatenate([[0], breaks + 1])].tolist(), where[np.concatenate([breaks, [len(where) - 1]])].tolist()
        for lo, hi in zip(begins, ends):
            key = tuple(split[lo : hi + 2])
            v = self.windows.get(key)
            if v is None:
                window = tuple(t.strip(_STOPS + "-–—_") for t in key)
                v = ()
                if any(c.isalpha() for t in window for c in t) and self.possible(window):
                    v = self.found([w for w in dict.fromkeys(parted(window, self.model)) if len(w) > 2])
                if len(self.windows) > WINDOWS:
                    self.windows.clear()
                if len(key) <= 64:
                    self.windows[key] = v
            out.update(v)
        return out


#: The last model that a worker has made; its table is kept from task to task.
_HELD: dict[str, CharModel] = {}


def held_model(key: str, counts: tuple[np.ndarray, np.ndarray]) -> CharModel:
    if key not in _HELD:
        _HELD.clear()
        _HELD[key] = CharModel(counts)
    return _HELD[key]


class Scorer:
    def __init__(self, counts: tuple[np.ndarray, np.ndarray], weights: dict[str, float], bias: float):
        self.counts, self.weights, self.bias = counts, weights, bias

    def score(self, ids) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.bias + sum(self.weights[i] for i in sorted(ids))))))


def fold_of(key: Column, folds: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds))


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters of at most 16 bits."""
    return np.fromiter((c < 0x10000 and chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


class GramTable:
    """Counts of the grams of ``grams_of`` of all words in tokens. Words are runs of letters; letters
    beyond 16 bits end a word. The first ``ROOM`` symbols that are met are counted in tables with a place
    for every gram, grams of others by sorting them."""

    ROOM = 32

    def __init__(self):
        self.number = np.full(0x10000, self.ROOM, dtype=np.int64)  # of each code point; ROOM: has none
        self.symbols: list[int] = []
        self.tables = [np.zeros(self.ROOM ** (k + 1)) for k in range(ORDER)]
        self.others: list[tuple[np.ndarray, np.ndarray]] = []
        self._name([ord("^"), ord("$")])

    def _name(self, codes: list[int]) -> None:
        for c in codes[: self.ROOM - len(self.symbols)]:
            self.number[c] = len(self.symbols)
            self.symbols.append(c)

    def add(self, tokens: list[str], weights: np.ndarray) -> None:
        raw = np.frombuffer("\n".join(tokens).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letter = _letters()[raw]
        if not letter.any():
            return
        owner = np.repeat(weights, np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1)[: len(raw)]
        # Each run of letters gets a begin and an end mark: in a copy with room for both.
        begins = letter & ~np.concatenate([[False], letter[:-1]])
        ends = letter & ~np.concatenate([letter[1:], [False]])
        at = (np.cumsum(letter.astype(np.int64) + begins + np.concatenate([[False], ends[:-1]])) - 1)[letter]
        size = int(at[-1]) + 2
        code, weight, first = np.full(size, ord("$"), dtype=np.int64), np.zeros(size), np.zeros(size, dtype=bool)
        code[at], weight[at] = raw[letter], owner[letter]
        b, e = at[begins[letter]] - 1, at[ends[letter]] + 1
        code[b], weight[b], first[b] = ord("^"), owner[letter][begins[letter]], True
        weight[e] = owner[letter][ends[letter]]
        if len(self.symbols) < self.ROOM:
            seen = np.flatnonzero(np.bincount(code))
            self._name(seen[self.number[seen] == self.ROOM].tolist())
        small = self.number[code].astype(np.int32)
        strange = small == self.ROOM
        any_strange = bool(strange.any())
        since = np.arange(size, dtype=np.int32)
        since -= np.maximum.accumulate(np.where(first, since, 0))  # places after the begin mark
        index, ok, bad = np.zeros(size, dtype=np.int32), weight > 0, strange.copy()
        gram = np.zeros(size if any_strange else 0, dtype=np.uint64)
        for k in range(ORDER):
            index[k:] += small[: size - k] * np.int32(self.ROOM**k)
            ok &= since >= max(k, 1)
            plain = ok
            if any_strange:
                bad[k:] |= strange[: size - k]
                gram[k:] |= code[: size - k].astype(np.uint64) << np.uint64(16 * k)
                plain, rare = ok & ~bad, ok & bad
                if rare.any():
                    found, inverse = np.unique(gram[rare], return_inverse=True)
                    self.others.append((found, np.bincount(inverse, weights=weight[rare])))
            self.tables[k] += np.bincount(index[plain], weights=weight[plain], minlength=self.ROOM ** (k + 1))

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """The grams, 16 bits a letter, and how often each stands in the words; some may be listed twice."""
        grams, n = [g for g, _ in self.others], [c for _, c in self.others]
        code = np.array(self.symbols + [0] * (self.ROOM - len(self.symbols)), dtype=np.uint64)
        for k, t in enumerate(self.tables):
            at = np.flatnonzero(t)
            n.append(t[at])
            gram = np.zeros(len(at), dtype=np.uint64)
            for j in range(k + 1):
                gram |= code[at // self.ROOM**j % self.ROOM] << np.uint64(16 * j)
            grams.append(gram)
        return np.concatenate(grams), np.concatenate(n).astype(np.int64)


def spelt(gram: int) -> str:
    """The letters of a packed gram."""
    gram %= 2**64
    return "".join(chr(gram >> 16 * k & 0xFFFF) for k in range(ORDER - 1, -1, -1) if gram >> 16 * k)


def _counted(table: GramTable) -> pa.RecordBatch:
    grams, n = table.counts()
    return pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n)], names=["g", "n"])


def gram_counts(docs: DataFrame, text: str, most: int = GRAMS) -> tuple[np.ndarray, np.ndarray]:
    """The character grams of the words of all texts, packed with 16 bits a letter (as texts they would take
    ten times the memory of every worker), each as often as texts hold its token; the ``most`` frequent ones. A task counts tokens and cuts grams from distinct ones, so only grams are shuffled."""
    tune(docs.sparkSession, 256)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, table = Counter(), GramTable()

        def cut_up():
            table.add(list(held), np.fromiter(held.values(), dtype=np.int64, count=len(held)))
            held.clear()

        for b in batches:
            for t in b.column(0):
                held.update(set((t.as_py() or "").lower().split()))
                if len(held) > CHUNK:
                    cut_up()
            if len(table.others) > OTHERS:
                cut_up()
                yield _counted(table)
                table = GramTable()
        if held:
            cut_up()
        yield _counted(table)

    grams = docs.select(docs[text]).mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).where("n >= 4")
    found = grams.orderBy(F.desc("n"), "g").limit(most).toArrow()  # at most ``most`` rows
    return found["g"].to_numpy().astype(np.int64).view(np.uint64), found["n"].to_numpy().astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, train: Column | None = None, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Scorer | None:
    """The scorer learned from the labelled rows for which ``train`` (of column ``_id``) holds."""
    tune(docs.sparkSession, 256)
    rated = labels.where(labels[doc_id].isNotNull() & labels[label].isNotNull()).groupBy(labels[doc_id].alias("_id")).agg(F.max(labels[label]).cast("int").alias("_y"))
    if train is not None:
        rated = rated.where(train)
    n = rated.count()
    if not n:
        return None
    chosen = rated.where(F.pmod(F.xxhash64("_id", F.lit(5)), F.lit(1_000_000)) < min(1.0, sample / n) * 1_000_000)
    rows = docs.select(docs[doc_id].alias("_id"), docs[text].alias("_text")).where("_text is not null").join(chosen, "_id")
    rows = cut(rows.groupBy(F.md5("_text").alias("d")).agg(F.max("_y").alias("y"), F.first("_text").alias("text")).select("y", "text").repartition(12))
    sizes = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not sizes.get(1) or not sizes.get(0):
        return None
    counts = gram_counts(docs, text)
    held = rows.sparkSession.sparkContext.broadcast(counts)
    key = uuid.uuid4().hex

    def count_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, found = Reader(held_model(key, held.value), None, False), {}

        def counted() -> pa.RecordBatch:
            cols = [pa.array(list(found), pa.string()), pa.array([v[1] for v in found.values()], pa.int64()), pa.array([v[0] for v in found.values()], pa.int64())]
            found.clear()
            return pa.RecordBatch.from_arrays(cols, names=["mark", "bad", "good"])

        for b in batches:
            for y, t in zip(b.column(0).to_pylist(), b.column(1)):
                for i in reader.ids(t.as_py()):
                    v = found.get(i)
                    if v is None:
                        v = found[i] = [0, 0]
                    v[1 if y else 0] += 1
                if len(found) > MARKS:
                    yield counted()
        yield counted()

    per_mark = rows.mapInArrow(count_marks, "mark string, bad long, good long").groupBy("mark").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    odds = F.log((F.col("bad") + 0.5) / (sizes[1] + 1)) - F.log((F.col("good") + 0.5) / (sizes[0] + 1))
    kept = sorted(r.mark for r in per_mark.where((F.col("bad") >= LEAST) & (odds >= ODDS)).select("mark").collect())
    if not kept:
        return Scorer(counts, {}, math.log(sizes[1] / sizes[0]))
    wanted = rows.sparkSession.sparkContext.broadcast(set(kept))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(held_model(key, held.value), wanted.value)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([sorted(reader.ids(t.as_py())) for t in b.column(1)], pa.list_(pa.string()))], names=["y", "ids"])

    got = sorted((tuple(r.ids), r.y) for r in rows.mapInArrow(read, "y int, ids array<string>").collect())
    weights, bias = _logistic(got, kept)
    return Scorer(counts, weights, bias)


def _logistic(rows: list, kept: list[str], l2: float = 2e-5, steps: int = 500, rate: float = 0.1) -> tuple[dict[str, float], float]:
    """Adam on all rows at once; rows are sparse."""
    place = {m: k for k, m in enumerate(kept)}
    row = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    col = np.array([place[m] for r in rows for m in r[0]], dtype=np.int64)
    y = np.array([r[1] for r in rows], dtype=float)
    w, b = np.zeros(len(kept)), math.log(max(y.mean(), 1e-6) / max(1 - y.mean(), 1e-6))
    m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    for step in range(1, steps + 1):
        eta = b + np.bincount(row, weights=w[col], minlength=len(rows))
        err = (1 / (1 + np.exp(-np.clip(eta, -40, 40))) - y) / len(rows)
        g = np.append(np.bincount(col, weights=err[row], minlength=len(kept)) + l2 * w, err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return dict(zip(kept, w.tolist())), float(b)


def score(docs: DataFrame, scorer: Scorer | None, doc_id: str = "doc_id", text: str = "text", keep: str | None = None) -> DataFrame:
    """doc_id and score of every row; with ``keep``, all columns of ``docs`` and the score under that name."""
    spark = tune(docs.sparkSession, 256)
    held = spark.sparkContext.broadcast(scorer)
    key = uuid.uuid4().hex
    fields = list(docs.schema.fields) if keep else [StructField("doc_id", docs.schema[doc_id].dataType)]
    schema = StructType([*fields, StructField(keep or "score", DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = held.value
        reader = Reader(held_model(key, s.counts), set(s.weights)) if s else None
        for b in batches:
            values = [s.score(reader.ids(t.as_py())) if s else 0.0 for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(1, b.num_columns)), pa.array(values, pa.float64())], names=schema.names)

    own = [docs[c] for c in docs.columns] if keep else [docs[doc_id].alias("doc_id")]
    return docs.select(docs[text].alias(free_name(docs, "scored")), *own).mapInArrow(run, schema)


def judge(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted; learned from labels outside the held-out fold."""
    scorer = fit(docs, labels, F.coalesce(fold_of(F.col("_id"), folds) != held, F.lit(False)))
    return score(docs, scorer).select(
        "doc_id", F.coalesce(fold_of(F.col("doc_id"), folds) == held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUTOFF).cast("int").alias("predicted")
    )


def select(docs: DataFrame, labels: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The documents whose score is below ``cutoff``, with their columns."""
    name = free_name(docs, "toxicity")
    return score(docs, fit(docs, labels), keep=name).where(F.col(name) < cutoff).drop(name)
