"""Main text of web pages by a recurrent block labeller.

A page is cut into leaf blocks: runs of text between block-level tags, with the path of open
elements. Each block becomes a vector (hashed path elements and their class words, hashed words, a few
measures), and a bidirectional LSTM reads the page's vectors in order and labels every block, so each
label sees the whole page. Blocks labelled as main text are joined in page order.

The network is small and in numpy. It is trained here, on pages that ``synthetic`` makes with known
labels, in several families of layouts (articles as elements, nested divisions, encyclopedias, layout by
tables, bare paragraphs, discussions) under many and invented class names; nothing of the input is
needed for that, and training is the same every time. Pages are labelled in one pass without a shuffle.

Defined results: a null or empty page, or one without text, has an empty text; tags need not be
closed or nested well; scripts, styles, comments and markup are never text; ``<br>`` ends a block;
repeated rows are read one by one; other columns are ignored.
"""

from __future__ import annotations

import functools
import html
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from granary.llm.util import tune

PATH_DIM, LEAF_DIM, WORD_DIM, MEASURES = 256, 64, 32, 8
DIM = PATH_DIM + LEAF_DIM + WORD_DIM + MEASURES
HIDDEN = 16
#: Blocks of a page whose vectors are held at once; a longer page is read part by part, its states run on.
LONG = 2000

_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<(script|style)\b[^>]*>.*?(?:</\1\s*>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|</?[a-zA-Z!?][^>]*>""",
    re.S | re.I,
)
_CLOSED = re.compile(r"</(?:script|style)\s*>\Z", re.I)
_ATTR = re.compile(r"""\b(class|id|role|aria-label|hidden)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_NAME = re.compile(r"[a-z]{2,}")
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCK = set(
    "address article aside blockquote body br button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head "
    "header hr html label legend li main menu nav noscript ol option p pre section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
_ENDS = {"li": {"li"}, "dd": {"dd", "dt"}, "dt": {"dd", "dt"}, "tr": {"tr"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dd": {"dl"}, "dt": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}
_CONTAINER = {"article", "aside", "body", "div", "footer", "form", "header", "main", "nav", "section", "table", "td", "th", "li", "ul", "ol", "blockquote", "figure", "html", "button", "fieldset"}


def blocks(page: str | None) -> list[tuple[str, tuple, int]]:
    """(text, path, characters in links) of every leaf block. A path is a tuple of (tag, class words)."""
    page = page or ""
    out: list[tuple[str, tuple, int]] = []
    stack: list[tuple[str, tuple]] = []
    held: list[str] = []
    linked = links = 0

    def flush():
        nonlocal linked
        if held:
            text = " ".join(html.unescape("".join(held)).split())
            if text:
                out.append((text, tuple(stack), linked))
            held.clear()
        linked = 0

    # What stands after the last '>' closes no tag; looking there for each '<' would take time by the square.
    end, at = page.rfind(">") + 1, 0
    for m in _TAG.finditer(page, 0, end):
        if m.start() > at:
            held.append(page[at : m.start()])
            if links:
                linked += m.start() - at
        at = m.end()
        tag = m[3]
        if not tag:
            if at == end and (m[0].startswith("<!--") and not (len(m[0]) > 6 and m[0].endswith("-->")) or m[1] and not _CLOSED.search(m[0])):
                at = len(page)  # a comment or script that nothing closes goes on to the end of the page
            continue
        tag = tag.lower()
        if m[2]:
            if tag in _BLOCK:
                flush()
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == tag:
                    links -= sum(t == "a" for t, _ in stack[k:])
                    del stack[k:]
                    break
                if tag not in _BLOCK and stack[k][0] in _CONTAINER:
                    break
            continue
        if tag in _BLOCK:
            flush()
            gone = None
            if tag in _ENDS:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] in _ENDS[tag]:
                        gone = k
                        break
                    if stack[k][0] in _SCOPE[tag]:
                        break
            elif tag != "br":
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == "p":
                        gone = k
                        break
                    if stack[k][0] in _CONTAINER:
                        break
            if gone is not None:
                links -= sum(t == "a" for t, _ in stack[gone:])
                del stack[gone:]
        if tag not in _VOID and not m[4].endswith("/"):
            words = ()
            if m[4]:
                words = tuple(dict.fromkeys(w for k, v in _ATTR.findall(m[4]) for w in ([k.lower()] if k.lower() == "hidden" else _NAME.findall(v.lower()))))
            stack.append((tag, words))
            links += tag == "a"
    if at < len(page):
        rest = page[at:]
        held.append(rest[: rest.find("<!--")] if "<!--" in rest else rest)
    flush()
    return out


@functools.lru_cache(maxsize=50_000)
def _bucket(word: str, dim: int) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % dim


@functools.lru_cache(maxsize=20_000)
def _path_places(path: tuple) -> tuple:
    """The places that a path sets: of every element and class word, and again of the innermost block."""
    out = set()
    for tag, words in path:
        out.add(_bucket(tag, PATH_DIM))
        out.update(_bucket(f".{w}", PATH_DIM) for w in words)
    leaf = next(((t, w) for t, w in reversed(path) if t in _BLOCK), ("", ()))
    out.add(PATH_DIM + _bucket(leaf[0], LEAF_DIM))
    out.update(PATH_DIM + _bucket(f".{w}", LEAF_DIM) for w in leaf[1])
    return tuple(out)


_WORD = re.compile(r"\w+")


def vectors(found: list, first: int = 0, total: int | None = None) -> np.ndarray:
    """One row for each block of a page, or of the part of a page that begins at block ``first``."""
    x = np.zeros((len(found), DIM), dtype=np.float32)
    total = max(total or len(found), 1)
    for k, (text, path, linked) in enumerate(found):
        x[k, list(_path_places(path))] = 1
        words = _WORD.findall(text.lower())
        for w in words:
            x[k, PATH_DIM + LEAF_DIM + zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_DIM] += 1
        if words:
            x[k, PATH_DIM + LEAF_DIM : -MEASURES] /= len(words)
        n = len(text)
        x[k, -MEASURES:] = (np.log1p(n) / 7, np.log1p(len(words)) / 5, min(linked / n, 1.0), text.count(".") / n * 10, text[-1] in ".!?…:;\"'", sum(map(str.isdigit, text)) / n, (first + k) / total, min(first + k, 20) / 20)
    return x


# The network. ----------------------------------------------------------------------------------


def _sig(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Lstm:
    """One direction. Batches are (time, pages, features), padded; masked steps carry the state on."""

    def __init__(self, rng: np.random.Generator, dim: int = DIM, hidden: int = HIDDEN):
        self.h = hidden
        self.wx = rng.standard_normal((dim, 4 * hidden)) * 0.1
        self.wh = rng.standard_normal((hidden, 4 * hidden)) * 0.2
        self.b = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)])

    @property
    def params(self):
        return [self.wx, self.wh, self.b]

    def forward(self, x: np.ndarray, mask: np.ndarray, tape: list | None = None) -> np.ndarray:
        t, n, _ = x.shape
        h, c, out = np.zeros((n, self.h)), np.zeros((n, self.h)), np.zeros((t, n, self.h))
        pre = (x.reshape(t * n, -1) @ self.wx + self.b).reshape(t, n, -1)
        for k in range(t):
            z = pre[k] + h @ self.wh
            i, f, o, g = _sig(z[:, : self.h]), _sig(z[:, self.h : 2 * self.h]), _sig(z[:, 2 * self.h : 3 * self.h]), np.tanh(z[:, 3 * self.h :])
            cn = f * c + i * g
            tc = np.tanh(cn)
            m = mask[k][:, None]
            if tape is not None:
                tape.append((h, c, i, f, o, g, tc, m))
            h, c = np.where(m, o * tc, h), np.where(m, cn, c)
            out[k] = h
        return out

    def steps(self, pre: np.ndarray, state: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        """States over what the inputs give, (time, 1, 4 x hidden), from a state on; and the last one."""
        (h, c), out = state, np.zeros((len(pre), 1, self.h))
        for k in range(len(pre)):
            z = pre[k] + h @ self.wh
            i, f, o, g = _sig(z[:, : self.h]), _sig(z[:, self.h : 2 * self.h]), _sig(z[:, 2 * self.h : 3 * self.h]), np.tanh(z[:, 3 * self.h :])
            c = f * c + i * g
            h = o * np.tanh(c)
            out[k] = h
        return out, (h, c)

    def backward(self, x: np.ndarray, tape: list, d_out: np.ndarray) -> list[np.ndarray]:
        t, n, _ = x.shape
        dwh, dz_all = np.zeros_like(self.wh), np.zeros((t, n, 4 * self.h))
        dh, dc = np.zeros((n, self.h)), np.zeros((n, self.h))
        for k in range(t - 1, -1, -1):
            h0, c0, i, f, o, g, tc, m = tape[k]
            dh = dh + d_out[k]
            dhm, dcm = np.where(m, dh, 0), np.where(m, dc, 0)
            dcn = dcm + dhm * o * (1 - tc * tc)
            dz = np.concatenate([dcn * g * i * (1 - i), dcn * c0 * f * (1 - f), dhm * tc * o * (1 - o), dcn * i * (1 - g * g)], axis=1)
            dz_all[k] = dz
            dwh += h0.T @ dz
            dh = dz @ self.wh.T + np.where(m, 0, dh)
            dc = dcn * f + np.where(m, 0, dc)
        flat = dz_all.reshape(t * n, -1)
        return [x.reshape(t * n, -1).T @ flat, dwh, flat.sum(axis=0)]


class Labeller:
    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        self.fwd, self.bwd = Lstm(rng), Lstm(rng)
        self.w, self.b = rng.standard_normal(2 * HIDDEN) * 0.1, np.zeros(1)

    @property
    def params(self):
        return [*self.fwd.params, *self.bwd.params, self.w, self.b]

    @staticmethod
    def batch(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        t = max(map(len, pages))
        x, mask = np.zeros((t, len(pages), DIM), dtype=np.float32), np.zeros((t, len(pages)), dtype=bool)
        for k, p in enumerate(pages):
            x[: len(p), k], mask[: len(p), k] = p, True
        return x, mask

    def run(self, x, mask, tapes=None):
        a = self.fwd.forward(x, mask, tapes and tapes[0])
        b = self.bwd.forward(x[::-1], mask[::-1], tapes and tapes[1])[::-1]
        both = np.concatenate([a, b], axis=2)
        return both, _sig(both @ self.w + self.b[0])

    def label(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """The probability of being main text for every block of every page."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((k for k in range(len(pages)) if len(pages[k])), key=lambda k: len(pages[k]))
        lo = 0
        while lo < len(order):
            hi = lo + 1
            while hi < len(order) and hi - lo < 128 and (hi - lo) * len(pages[order[hi]]) < 4000:
                hi += 1
            part = order[lo:hi]
            x, mask = self.batch([pages[k] for k in part])
            p = self.run(x, mask)[1]
            for j, k in enumerate(part):
                out[k] = p[: len(pages[k]), j]
            lo = hi
        return out

    def label_long(self, found: list) -> np.ndarray:
        """The same for one long page: its vectors are made part by part, and the states run over the
        whole page in both directions."""
        parts = [vectors(found[lo : lo + LONG], lo, len(found)) for lo in range(0, len(found), LONG)]
        h = self.fwd.h
        out = np.zeros((len(found), 2 * h))
        for side, net in enumerate((self.fwd, self.bwd)):
            state, at = (np.zeros((1, h)), np.zeros((1, h))), 0
            for x in parts if not side else reversed(parts):
                x = x if not side else x[::-1]
                got, state = net.steps((x @ net.wx + net.b)[:, None, :], state)
                out[at : at + len(x), side * h : (side + 1) * h] = got[:, 0]
                at += len(x)
        out[:, h:] = out[::-1, h:].copy()
        return _sig(out @ self.w + self.b[0])

    def train(self, pages: list[np.ndarray], labels: list[np.ndarray], epochs: int = 6, rate: float = 0.01, seed: int = 1, size: int = 32) -> Labeller:
        rng = np.random.default_rng(seed)
        m = [np.zeros_like(p) for p in self.params]
        v = [np.zeros_like(p) for p in self.params]
        step = 0
        for _ in range(epochs):
            order = sorted(range(len(pages)), key=lambda k: (len(pages[k]) // 8, rng.random()))
            groups = [order[k : k + size] for k in range(0, len(order), size)]
            for g in (groups[k] for k in rng.permutation(len(groups))):
                x, mask = self.batch([pages[k] for k in g])
                y = np.zeros(mask.shape)
                for j, k in enumerate(g):
                    y[: len(labels[k]), j] = labels[k]
                tapes: list[list] = [[], []]
                a = self.fwd.forward(x, mask, tapes[0])
                b = self.bwd.forward(x[::-1], mask[::-1], tapes[1])[::-1]
                both = np.concatenate([a, b], axis=2)
                err = np.where(mask, _sig(both @ self.w + self.b[0]) - y, 0) / mask.sum()
                d = err[:, :, None] * self.w
                grads = [
                    *self.fwd.backward(x, tapes[0], d[:, :, :HIDDEN]),
                    *self.bwd.backward(x[::-1], tapes[1], d[::-1, :, HIDDEN:]),
                    np.tensordot(err, both, axes=([0, 1], [0, 1])),
                    np.array([err.sum()]),
                ]
                step += 1
                for p, q, mm, vv in zip(self.params, grads, m, v):
                    mm += 0.1 * (q - mm)
                    vv += 0.001 * (q * q - vv)
                    p -= rate * (mm / (1 - 0.9**step)) / (np.sqrt(vv / (1 - 0.999**step)) + 1e-8)
        return self


# Training pages. -------------------------------------------------------------------------------

#: Class words by the part of a page that they name; half of all names are invented instead.
NAMES = {
    "main": "content article post entry story body text main copy prose page article-body entry-content post-body bodycontent mw-content read",
    "menu": "menu nav navbar navigation topnav links tabs breadcrumb breadcrumbs crumbs toolbar sitemap pager pagination",
    "head": "header masthead top banner-top site-header logo brand topbar hero-nav",
    "foot": "footer bottom copyright colophon legal site-footer base imprint",
    "side": "sidebar side related widget recommended popular rail aside more also trending",
    "notice": "cookie cookies consent notice alert newsletter subscribe popup gdpr paywall toast",
    "ad": "ad ads advert advertisement sponsored promo banner sponsor partner adbox",
    "talk": "comments comment replies reply cmt cmts discussion responses thread respond feedback disqus answers guestbook",
    "share": "share social tags meta byline author date follow rating",
    "wrap": "container wrapper wrap row col column page layout inner outer block box grid center panel holder site root section region group area mw-page",
    "form": "search login signup contact form query register",
}
SYLLABLES = "the an er on re he in ed nd ha at en es of or nt ea ti to it st io le is ou ar as de rt ve sch ein ung ción ado que ment eau é è ü ñ ß ка но то 中 の".split()


class Maker:
    """Random words, sentences, class names and page parts; ``main`` gathers the main blocks in order."""

    def __init__(self, seed: int):
        self.rng, self.main = np.random.default_rng(seed), []

    def pick(self, *xs):
        return xs[self.rng.integers(len(xs))]

    def chance(self, p: float) -> bool:
        return self.rng.random() < p

    def word(self) -> str:
        return "".join(self.pick(*SYLLABLES) for _ in range(self.rng.integers(1, 5)))

    def words(self, k: int) -> str:
        return " ".join(self.word() for _ in range(k))

    def sentence(self, lo: int = 3, hi: int = 18) -> str:
        w = self.words(int(self.rng.integers(lo, hi)))
        return w[:1].upper() + w[1:] + self.pick(".", ".", ".", "!", "?", "")

    def text(self, lo: int = 1, hi: int = 6) -> str:
        t = " ".join(self.sentence() for _ in range(self.rng.integers(lo, hi)))
        return self.pick(t, t, t, t, t.upper(), t.replace(" ", " | "), t.replace(" ", "!! "))

    def name(self, part: str, must: bool = False) -> str:
        """An attribute with a name for a part; an invented one or none, unless one is needed to tell it."""
        known, invented = self.pick(*NAMES[part].split()), self.word()[:8].lower() or "x"
        said = self.pick(known, known, f"{known} {invented}", f"{invented}-{known}") if must or self.chance(0.5) else invented
        return "" if not must and self.chance(0.35) else f' {self.pick("class", "class", "id")}="{said}"'

    def inline(self, t: str) -> str:
        w = html.escape(t, quote=self.chance(0.5)).split(" ")
        for _ in range(self.rng.integers(0, 3)):
            k, tag = int(self.rng.integers(len(w))), self.pick("b", "i", "em", "strong", "span", "a", "code")
            w[k] = f'<a href="/{self.word()}">{w[k]}</a>' if tag == "a" else f"<{tag}>{w[k]}</{tag}>"
        return " ".join(w)

    def say(self, t: str) -> str:
        """A main block."""
        self.main.append(" ".join(html.unescape(html.escape(t)).split()))
        return self.inline(t)

    def links(self, lo: int = 2, hi: int = 9) -> str:
        tag = self.pick("li", "li", "li", "div", "span", "a", "td")
        each = [f'<a href="/{self.word()}">{html.escape(self.words(int(self.rng.integers(1, 5))))}</a>' for _ in range(self.rng.integers(lo, hi))]
        if tag == "a":
            return self.pick(" ", " | ", " &middot; ").join(each)
        rows = "".join(f"<{tag}>{x}</{tag}>" for x in each)
        return f"<ul>{rows}</ul>" if tag == "li" else f"<table><tr>{rows}</tr></table>" if tag == "td" else rows

    def wrapped(self, part: str, p: float = 0.35) -> str:
        """A part in elements that say nothing of what it is."""
        while part and self.chance(p):
            part = f"<div{self.name('wrap', self.chance(0.7))}>{part}</div>"
        return part

    # What is not main text.

    def menu(self) -> str:
        return self.pick(f"<nav{self.name('menu')}>{self.links()}</nav>", f"<div{self.name('menu')}>{self.links(3)}</div>", f"<ul{self.name('menu')}>{self.links(3)}</ul>")

    def header(self) -> str:
        inner = self.pick("", f"<h1>{html.escape(self.words(3))}</h1>", f"<div>{html.escape(self.words(2))}</div>", f"<p>{html.escape(self.sentence())}</p>") + (self.menu() if self.chance(0.5) else "")
        return self.pick(f"<header{self.name('head')}>{inner}</header>", f"<div{self.name('head', True)}>{inner}</div>")

    def footer(self) -> str:
        t = html.escape(self.text(1, 4))
        inner = self.pick(f"&copy; {self.word()} {t}", f"<p>&copy; {2000 + int(self.rng.integers(30))} {t}</p>", f"{self.links()}<p>{t}</p>", t)
        return self.pick(f"<footer{self.name('foot')}>{inner}</footer>", f"<footer>{inner}</footer>", f"<div{self.name('foot', True)}>{inner}</div>")

    def advert(self) -> str:
        tag = self.pick("div", "div", "p", "aside", "section")
        return f"<{tag}{self.name('ad', True)}>" + self.pick(html.escape(self.text(1, 4)), f"<a href='/x'>{html.escape(self.sentence())}</a>", f"<p>{html.escape(self.text(1, 3))}</p>" if tag != "p" else html.escape(self.sentence())) + f"</{tag}>"

    def sidebar(self) -> str:
        inner = f"<{(h := self.pick('h3', 'h4', 'b', 'h2'))}>{html.escape(self.words(2))}</{h}>" + self.pick(f"<p>{html.escape(self.text(1, 4))}</p>", self.links())
        return self.pick(f"<aside{self.name('side')}>{inner}</aside>", f"<div{self.name('side', True)}>{inner}</div>")

    def notice(self) -> str:
        tag = self.pick("div", "section", "p", "dialog")
        return f"<{tag}{self.name('notice', True)}>" + (html.escape(self.text(1, 3)) if tag == "p" else self.pick(html.escape(self.text(1, 3)), f"<p>{html.escape(self.text(1, 3))}</p><button>{html.escape(self.words(2))}</button>")) + f"</{tag}>"

    def form(self) -> str:
        return f"<form{self.name('form')}><label>{html.escape(self.words(2))}</label><input name=q>" + self.pick("", f"<p>{html.escape(self.text(1, 2))}</p>", f"<select><option>{self.word()}<option>{html.escape(self.words(2))}</select>", f"<textarea>{html.escape(self.sentence())}</textarea>") + f"<button>{html.escape(self.words(1))}</button></form>"

    def talk(self) -> str:
        tag, box = self.pick("div", "li", "article", "p"), self.pick("section", "div", "ol", "div")
        one = lambda: f"<{tag}{self.name('talk', self.chance(0.6))}>" + self.pick(f"<b>{html.escape(self.words(2))}</b>", f"<cite>{html.escape(self.words(2))}</cite> ", "") + (html.escape(self.text(1, 4)) if tag == "p" or self.chance(0.4) else f"<p>{html.escape(self.text(1, 5))}</p>") + f"</{tag}>"
        return f"<{box}{self.name('talk', True)}>" + self.pick("", f"<h2>{html.escape(self.words(2))}</h2>", f"<h3>{int(self.rng.integers(1, 99))} {html.escape(self.words(1))}</h3>") + "".join(one() for _ in range(self.rng.integers(1, 7))) + f"</{box}>"

    def share(self) -> str:
        tag = self.pick("div", "p", "span")
        return f"<{tag}{self.name('share', True)}>" + self.pick(self.links(2, 5) if tag == "div" else f"<a href='/x'>{self.word()}</a>", html.escape(self.words(3))) + f"</{tag}>"

    # The families: ways to lay out an article.

    def paragraphs(self, how: str, extra: tuple = ()) -> str:
        """The blocks of an article; ``how`` says what a paragraph is marked up with."""
        out = []
        for _ in range(self.rng.integers(1, 14) if self.chance(0.9) else self.rng.integers(14, 40)):
            r, t = self.rng.random(), self.text() if self.chance(0.85) else self.word()
            if r < 0.62:
                out.append({"p": lambda t: f"<p>{self.say(t)}" + self.pick("</p>", "</p>", "</p>", ""), "div": lambda t: f"<div{self.name('main') if self.chance(0.3) else ''}>{self.say(t)}</div>", "br": lambda t: f"{self.say(t)}<br>" + self.pick("<br>", "")}[how](t))
            elif r < 0.7:
                out.append(f"<p><b>{self.say(self.text(1, 3))}<br>" if how == "p" and self.chance(0.5) else f"<{(h := self.pick('h2', 'h3', 'h4'))}>{self.say(self.sentence(1, 7))}</{h}>")
            elif r < 0.77:
                tag = self.pick("ul", "ol")
                out.append(f"<{tag}>" + "".join(f"<li>{self.say(self.text(1, 2))}" + self.pick("", "</li>") for _ in range(self.rng.integers(2, 6))) + f"</{tag}>")
            elif r < 0.82:
                tag = self.pick("blockquote", "pre", "div", "figcaption")
                out.append(f"<{tag}>{self.say(self.text(1, 4))}</{tag}>")
            elif r < 0.86:
                out.append("<table>" + "".join(f"<tr><td>{self.say(self.words(2))}</td><td>{self.say(self.words(int(self.rng.integers(1, 6))))}</td></tr>" for _ in range(self.rng.integers(1, 5))) + "</table>")
            elif r < 0.89:
                out.append("<dl>" + "".join(f"<dt>{self.say(self.words(2))}<dd>{self.say(self.sentence())}" for _ in range(self.rng.integers(1, 4))) + "</dl>")
            elif extra:
                out.append(self.pick(*extra)())
        return "".join(out)

    def title(self, *tags: str) -> str:
        t = self.sentence(2, 10) if self.chance(0.7) else self.text(1, 2)[:60].strip() or self.word()
        tag = self.pick(*tags)
        return f"<{tag}>{self.say(t)}</{tag.split()[0]}>" if self.chance(0.85) else ""

    def semantic(self) -> str:
        """article or main elements, with other things inside."""
        inner = self.title("h1", "h1", "h2") + self.paragraphs("p", (self.advert, self.share, self.notice, self.form, self.sidebar))
        if self.chance(0.2):
            inner += self.talk()
        tag = self.pick("article", "article", "main", "section")
        return self.pick(f"<{tag}{self.name('main', tag == 'section')}>{inner}</{tag}>", f"<main><{tag}>{inner}</{tag}></main>")

    def soup(self) -> str:
        """Nested div elements, text in div or p."""
        inner = self.title("h1", "h2", "div class=title") + self.paragraphs(self.pick("p", "div", "br"), (self.advert, self.share, self.sidebar)) + (self.talk() if self.chance(0.3) else "")
        for _ in range(self.rng.integers(1, 4)):
            inner = f"<div{self.name('main')}>{inner}</div>"
        return inner

    def wiki(self) -> str:
        """A heading outside of the text's own element, lists, tables and contents of links."""
        toc = f"<div{self.name('menu', True)}><h2>{html.escape(self.words(1))}</h2>{self.links()}</div>" if self.chance(0.4) else ""
        return f"<div id=content>{self.title('h1 id=firstHeading', 'h1')}<div{self.name('main')}>{toc}{self.paragraphs('p')}</div></div>" + (f"<div{self.name('side', True)}>{self.links()}</div>" if self.chance(0.5) else "")

    def cells(self) -> str:
        """A table lays out the page: links in one cell, the article in another."""
        cell = f"<td>{self.title('h1', 'h2', 'b')}{self.paragraphs(self.pick('p', 'br', 'p'))}</td>"
        return "<table><tr>" + (f"<td width=150>{self.links(3)}</td>" if self.chance(0.8) else "") + cell + (f"<td>{self.sidebar()}</td>" if self.chance(0.4) else "") + "</tr></table>"

    def bare(self) -> str:
        """Paragraphs right in the body."""
        return self.title("h1", "h2") + self.paragraphs(self.pick("p", "p", "br"))

    def thread(self) -> str:
        """A short article and a long discussion in the same element."""
        inner = self.title("h1", "h2") + self.paragraphs(self.pick("p", "div")) + self.share() + self.talk() + (self.form() if self.chance(0.4) else "")
        tag = self.pick("main", "div", "article", "section")
        return f"<{tag}{self.name('main') if tag != 'main' else ''}>{inner}</{tag}>"

    def page(self, family: str) -> tuple[str, list[str]]:
        self.main = []
        before = [f() for f in (self.menu, self.advert, self.header, self.notice, self.form, self.sidebar, self.share) if self.chance(0.35)]
        made = getattr(self, family)() if self.chance(0.97) else ""
        after = [f() for f in (self.sidebar, self.talk, self.advert, self.share, self.form, self.notice, self.menu) if self.chance(0.25)]
        self.rng.shuffle(before)
        self.rng.shuffle(after)
        if self.chance(0.2):  # columns
            made = f"<div{self.name('wrap', True)}><div{self.name('wrap', True)}>{made}</div><div{self.name('wrap', True)}>{self.sidebar()}</div></div>"
        before, made, after = [self.wrapped(x, 0.2) for x in before], self.wrapped(made), [self.wrapped(x, 0.2) for x in after]
        title = html.escape((self.main[0] if self.main and self.chance(0.8) else self.words(3))[:60])
        head = self.pick("", "<!doctype html>", "<!DOCTYPE html><html lang=en>") + f"<head><title>{title}</title>" + self.pick("", "<meta charset=utf-8>", "<style>.x{color:red}</style>", "<script>if (a < b) go('<p>')</script>") + "</head><body>"
        return (head if self.chance(0.9) else "") + "".join(before) + made + "".join(after) + (self.footer() if self.chance(0.75) else "") + self.pick("</body></html>", ""), self.main


FAMILIES = ("semantic", "soup", "wiki", "cells", "bare", "thread")


def synthetic(n: int, seed: int, families: tuple[str, ...] = FAMILIES) -> list[tuple[str, list[str]]]:
    """(page, its main blocks) of n pages of these families in turn."""
    maker = Maker(seed)
    return [maker.page(families[k % len(families)]) for k in range(n)]


def labelled(pages: list[tuple[str, list[str]]]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Vectors and labels: the main blocks are found in order among the page's blocks."""
    xs, ys = [], []
    for page, main in pages:
        found, y, at = blocks(page), [], 0
        for text, path, _ in found:
            hit = at < len(main) and text == main[at] and not any(t in ("head", "title") for t, _ in path)
            y.append(float(hit))
            at += hit
        if found and at == len(main):
            xs.append(vectors(found))
            ys.append(np.array(y))
    return xs, ys


@functools.cache
def trained(pages: int = 2400, seed: int = 5, families: tuple[str, ...] = FAMILIES) -> Labeller:
    return Labeller().train(*labelled(synthetic(pages, seed, families)))


def main_blocks(pages: list, model: Labeller) -> list[list[str]]:
    found = [blocks(p) for p in pages]
    short = [k for k, f in enumerate(found) if len(f) <= LONG]
    labels = dict(zip(short, model.label([vectors(found[k]) for k in short])))
    return [[t for (t, _, _), p in zip(f, labels[k] if k in labels else model.label_long(f)) if p >= 0.5] for k, f in enumerate(found)]


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    spark = tune(pages.sparkSession, 128)
    held = spark.sparkContext.broadcast(trained())
    id_type = pages.schema[page_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = ["\n".join(x) for x in main_blocks(b.column(2).to_pylist(), held.value)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(pages[page_id].alias("page_id"), pages[url].alias("url"), pages[page].alias("html")).mapInArrow(run, f"page_id {id_type}, url string, text string, n_chars long")
