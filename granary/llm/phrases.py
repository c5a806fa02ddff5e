"""Phrase collocations: sequences of two to four words that stand together far oftener than their parts allow.

1. Words are counted for each language, summed up within a task before they are shuffled.
2. Words that occur often enough get ids of fixed width, the most frequent the smallest; a phrase that occurs
   often enough has no other words, so pieces are broken at them. The dictionary is broadcast if a count finds
   it small; beyond that, texts are dealt into blocks and each block gets the ids of its own words by a join.
3. Each place gives one key of four ids: its word and the three that follow, zeros after the end of its piece.
   A phrase of n words is the first n ids of the keys of its places, so one sort serves all lengths. A task
   sorts its keys (radix sort of 16-bit digits) and sends each with its count, cut at fixed bounds into ranges.
   The bounds follow from the words' counts alone (a frequent first word's range is split by the second, and so
   on), so no text is read for them.
4. A range's keys are sorted again and the runs of equal beginnings are counted. Only runs at a range's ends
   can go on in the next one; they are summed up with the rest.
5. Cuts, scores and what longer phrases hold come from joins of keys, in exact decimals.

A frequent word, phrase, line or text costs a row a task, not a row a place, so no key gathers rows.

Defined results: null texts count as empty, a null language as ``und``; A-Z in lower case and nothing else is
changed; texts without words, and tables without rows or frequent words, give no phrases; repeated documents
count each time; ties go by score, count and bytes of the phrase; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.util import Work, cut, tune

#: Words of the longest phrase; its key holds as many ids.
LONGEST = 4
#: Places of a phrase that make it a candidate.
LEAST = 30
#: A longer phrase with this percentage of a phrase's places hides it.
HIDES = 80
TOP = 2000
SCALE = 2_000_000
#: Distinct words that a task holds before it sends their counts.
HELD = 200_000
#: Words, and bytes of words, up to which the dictionary is broadcast.
WORDS, BYTES = 500_000, 16 << 20
#: Keys that a task sorts at once, keys that a range is planned to hold, keys of one row, bytes of texts in a block.
CHUNK, RANGE, BLOB, BLOCK = 2_000_000, 2_000_000, 50_000, 64 << 20
#: The most frequent words have a bin each when ranges are planned, the others share as many.
BINS = 32_768
#: Parts of a language when its best are sought.
PARTS = 64

_SEPARATORS = b".,;:!?\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Bytes as words see them (everything that parts words is a space), and as pieces do (their ends are a line feed).
_PLAIN = bytes(32 if b == 9 or b in _SEPARATORS else _LOWER[b] for b in range(256))
_PIECES = bytes(32 if b == 9 else 10 if b in _SEPARATORS else _LOWER[b] for b in range(256))


def counted(docs: DataFrame) -> DataFrame:
    """lang, word, n: the places of each word, and of all words where the word is null."""

    def flush(counts: dict[str, Counter], totals: Counter) -> Iterator[pa.RecordBatch]:
        for lang, c in counts.items():
            words, n = list(c), list(c.values())
            for lo in range(0, len(words), 50_000):
                part = words[lo : lo + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()), pa.array(n[lo : lo + 50_000], pa.int64())], names=["lang", "word", "n"])
        if totals:
            yield pa.RecordBatch.from_arrays([pa.array(list(totals), pa.string()), pa.array([None] * len(totals), pa.binary()), pa.array(list(totals.values()), pa.int64())], names=["lang", "word", "n"])

    def run(batches):
        counts, totals, held = {}, Counter(), 0
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = text.as_py().encode().translate(_PLAIN).split()
                c = counts.setdefault(lang, Counter())
                held -= len(c)
                c.update(words)
                held += len(c)
                totals[lang] += len(words)
                if held > HELD:
                    yield from flush(counts, totals)
                    counts, totals, held = {}, Counter(), 0
        yield from flush(counts, totals)

    rows = docs.select("lang", "text").mapInArrow(run, "lang string, word binary, n long")
    return rows.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def numbered(words: DataFrame, work: Work) -> DataFrame:
    """id (from 1), lang, word, n: the most frequent words have the smallest ids."""
    order = [F.desc("n"), F.col("lang"), F.col("word")]
    place = F.monotonically_increasing_id()  # kept with the rows, so it is taken once
    rows = work.written(words.repartitionByRange(*order).sortWithinPartitions(*order).select(place.alias("at"), "lang", "word", "n"), "words")
    of, within = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = sorted((r.p, r.size) for r in rows.groupBy(of.alias("p")).agg(F.count("*").alias("size")).collect())  # one for each partition
    before, offset = 0, []
    for p, size in sizes:
        offset += [F.lit(p), F.lit(before)]
        before += size
    if before >= 1 << 32:
        raise ValueError("more frequent words than ids of four bytes")
    start = F.create_map(*offset)[of.cast("int")] if offset else F.lit(0)
    return rows.select((within + start + 1).alias("id"), "lang", "word", "n")


def bins(words: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First ids and places of the bins by which ranges are planned; at most 2 x BINS rows."""
    wide = max(1, -(-(size - BINS) // BINS))
    first = F.when(F.col("id") <= BINS, F.col("id")).otherwise(F.lit(BINS + 1) + F.floor((F.col("id") - BINS - 1) / wide) * wide)
    rows = sorted((r.lo, r.n) for r in words.groupBy(first.alias("lo")).agg(F.sum("n").alias("n")).collect())
    return np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.float64)


def bounds(starts: np.ndarray, weights: np.ndarray, most: float) -> tuple[np.ndarray, np.ndarray]:
    """Keys (as two halves, in order) at which ranges begin that are planned to hold about ``most`` keys each."""
    total, out = weights.sum(), set()

    def split(prefix: tuple, share: float) -> None:
        w = weights * (share / total)
        heavy = np.flatnonzero((w > most) & (starts <= BINS)) if len(prefix) < LONGEST - 1 else np.zeros(0, np.int64)
        step = np.flatnonzero(np.diff(np.floor(np.cumsum(w) / most), prepend=0) > 0)
        for i in {*step.tolist(), *heavy.tolist(), *(heavy + 1).tolist()}:
            if i < len(starts):
                out.add((*prefix, int(starts[i])) + (0,) * (LONGEST - 1 - len(prefix)))
        for i in heavy.tolist():
            split((*prefix, int(starts[i])), w[i])

    if len(starts) and total > most:
        split((), total)
    keys = np.array(sorted(out), dtype=np.uint64).reshape(-1, LONGEST)
    return keys[:, 0] << np.uint64(32) | keys[:, 1], keys[:, 2] << np.uint64(32) | keys[:, 3]


def radix_order(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """The order of keys by (hi, lo): a stable sort by each digit of 16 bits, the last first."""
    at = np.arange(len(hi))
    for half in (lo, hi):
        for shift in (0, 16, 32, 48):
            digit = (half >> np.uint64(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                at = at[np.argsort(digit[at], kind="stable")]
    return at


def run_lengths(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(hi):
        return hi, lo, n
    at = radix_order(hi, lo)
    hi, lo = hi[at], lo[at]
    first = np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])])
    return hi[first], lo[first], np.add.reduceat(n[at], first)


def keys_of(ids: np.ndarray, own: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the first ``own`` places, those of at least two words; zeros among the ids part the pieces."""
    a, b, c, d = (np.r_[ids, np.zeros(LONGEST, np.uint64)][k : k + own] for k in range(LONGEST))
    keep = (a > 0) & (b > 0)
    a, b, c, d = a[keep], b[keep], c[keep], d[keep]
    return a << np.uint64(32) | b, c << np.uint64(32) | np.where(c > 0, d, np.uint64(0))


def packed(hi: np.ndarray, lo: np.ndarray, width: int) -> np.ndarray:
    """Keys as bytes, ``width`` for each id, so that their order is that of the bytes."""
    raw = np.stack([hi, lo], axis=1).astype(">u8").view(np.uint8).reshape(-1, LONGEST, 4)
    return np.ascontiguousarray(raw[:, :, 4 - width :]).reshape(-1, LONGEST * width)


def unpacked(raw: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    flat = np.zeros((len(raw) // (LONGEST * width), LONGEST, 4), np.uint8)
    flat[:, :, 4 - width :] = np.frombuffer(raw, np.uint8).reshape(-1, LONGEST, width)
    both = flat.reshape(-1, 16).view(">u8").astype(np.uint64)
    return both[:, 0], both[:, 1]


def encoded(text: bytes, ids: dict[bytes, int]) -> np.ndarray:
    """Ids of a text's words, 0 for words without one and between pieces, and at the end."""
    words = filter(None, text.translate(_PIECES).replace(b"\n", b" \n ").split(b" "))
    return np.fromiter((*map(ids.get, words, repeat(0)), 0), np.uint64)


RANGES = "bucket int, keys binary, counts binary"


def _ranges(arrays: Iterator[np.ndarray], first: tuple[np.ndarray, np.ndarray], width: int) -> Iterator[pa.RecordBatch]:
    """Rows (``RANGES``) of the keys of texts as ids, sorted and counted in chunks."""

    def send(held: list[np.ndarray], after: np.ndarray) -> Iterator[pa.RecordBatch]:
        ids = np.concatenate([*held, after])
        hi, lo = keys_of(ids, len(ids) - len(after))
        hi, lo, n = run_lengths(hi, lo, np.ones(len(hi), np.uint32))
        left, right = np.searchsorted(hi, first[0], "left"), np.searchsorted(hi, first[0], "right")
        ends = [0, *(int(a + np.searchsorted(lo[a:b], x)) for a, b, x in zip(left, right, first[1])), len(hi)]
        raw, rows, size = packed(hi, lo, width), [], 0
        for bucket, (a, b) in enumerate(zip(ends, ends[1:])):
            for s in range(a, b, BLOB):
                t = min(b, s + BLOB)
                rows.append((bucket, raw[s:t].tobytes(), n[s:t].astype("<u4").tobytes()))
                size += t - s
                if size > 8 * BLOB:
                    yield _table(rows)
                    rows, size = [], 0
        if rows:
            yield _table(rows)

    held, size, none = [], 0, np.zeros(0, np.uint64)
    for ids in arrays:
        for s in range(0, len(ids), CHUNK):
            held.append(ids[s : s + CHUNK])
            size += len(held[-1])
            if size >= CHUNK:  # where a text goes on, its last places look at the words that follow
                yield from send(held, ids[s + CHUNK : s + CHUNK + LONGEST - 1])
                held, size = [], 0
    if held:
        yield from send(held, none)


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.binary()), pa.array(cols[2], pa.binary())], names=["bucket", "keys", "counts"])


def ranges_of_small(docs: DataFrame, words: DataFrame, first: tuple, width: int) -> DataFrame:
    """Rows (``RANGES``) of all texts, with the whole dictionary in each task: at most WORDS words of BYTES bytes."""
    ids: dict[str, dict[bytes, int]] = {}
    for r in words.select("id", "lang", "word").toArrow().to_pylist():  # the size is checked
        ids.setdefault(r["lang"], {})[r["word"]] = r["id"]
    held = docs.sparkSession.sparkContext.broadcast((ids, first))

    def run(batches):
        ids, first = held.value
        yield from _ranges((encoded(t.as_py().encode(), ids.get(lang, {})) for b in batches for lang, t in zip(b.column(0).to_pylist(), b.column(1))), first, width)

    return docs.select("lang", "text").mapInArrow(run, RANGES)


def ranges_of_large(docs: DataFrame, words: DataFrame, first: tuple, width: int, work: Work) -> DataFrame:
    """The same with a dictionary of any size: blocks of texts are joined with the ids of their own words."""
    held = docs.sparkSession.sparkContext.broadcast(first)
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // BLOCK))
    texts = work.written(docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).alias("block"), "lang", "text"), "texts").repartition("block")

    def own_words(batches):
        seen: dict[tuple[int, str], set[bytes]] = {}

        def flush():
            for (block, lang), found in seen.items():
                listed = list(found)
                for lo in range(0, len(listed), 50_000):
                    part = listed[lo : lo + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array([block] * len(part), pa.int64()), pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary())], names=["block", "lang", "word"])

        for b in batches:
            for block, lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                seen.setdefault((block, lang), set()).update(text.as_py().encode().translate(_PLAIN).split())
            if sum(map(len, seen.values())) > HELD:
                yield from flush()
                seen.clear()
        yield from flush()

    known = texts.mapInArrow(own_words, "block long, lang string, word binary").distinct().join(words.select("lang", "word", "id"), ["lang", "word"])
    both = known.select("block", F.lit(0).alias("kind"), "lang", "word", "id").unionByName(texts.select("block", F.lit(1).alias("kind"), "lang", F.encode("text", "utf-8").alias("word"), F.lit(None).cast("long").alias("id")))

    def arrays(batches):
        now, ids = None, {}
        for b in batches:
            for block, kind, lang, word, number in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3), b.column(4).to_pylist()):
                if block != now:
                    now, ids = block, {}
                if kind == 0:
                    ids.setdefault(lang, {})[word.as_py()] = number
                else:
                    yield encoded(word.as_py(), ids.get(lang, {}))

    return both.repartition("block").sortWithinPartitions("block", "kind").mapInArrow(lambda batches: _ranges(arrays(batches), held.value, width), RANGES)


def frequent(ranges: DataFrame, count: int, least: int, width: int) -> DataFrame:
    """gram (four bytes for each id), a: phrases of two to LONGEST words with at least ``least`` places."""

    def runs(hi: np.ndarray, lo: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        hi, lo, n = run_lengths(hi, lo, n.astype(np.int64))
        raw = packed(hi, lo, 4)
        for words in range(2, LONGEST + 1):
            part = lo >> np.uint64(32) if words == 3 else lo if words == 4 else np.zeros(len(lo), np.uint64)
            start = np.flatnonzero(np.r_[True, (hi[1:] != hi[:-1]) | (part[1:] != part[:-1])])
            sums = np.add.reduceat(n, start)
            keep = sums >= least
            keep[[0, -1]] = True  # these may go on in the ranges beside
            keep &= raw[start, 4 * words - 4 : 4 * words].any(axis=1)
            for at in np.array_split(np.flatnonzero(keep), max(1, keep.sum() // 20_000)):
                yield pa.RecordBatch.from_arrays([pa.array([raw[i, : 4 * words].tobytes() for i in start[at]], pa.binary()), pa.array(sums[at])], names=["gram", "a"])

    def run(batches):
        now, parts = None, []
        for b in batches:
            for bucket, keys, counts in zip(b.column(0).to_pylist(), b.column(1), b.column(2)):
                if bucket != now or len(parts) == 64:
                    if bucket != now and parts:
                        yield from runs(*map(np.concatenate, zip(*parts)))
                    parts = [] if bucket != now else [run_lengths(*map(np.concatenate, zip(*parts)))]  # copies go early
                    now = bucket
                parts.append((*unpacked(keys.as_py(), width), np.frombuffer(counts.as_py(), "<u4").astype(np.int64)))
        if parts:
            yield from runs(*map(np.concatenate, zip(*parts)))

    found = ranges.repartition(count, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "gram binary, a long")
    return found.groupBy("gram").agg(F.sum("a").alias("a")).where(F.col("a") >= least)


def _key(column: str) -> Column:
    """An id as four bytes."""
    return F.unhex(F.lpad(F.hex(column), 8, "0"))


def _part(column: str, first, size) -> Column:
    """``size`` words of a phrase's key, from word ``first`` (0 is the first) on."""
    return F.substring(F.col(column), first * 4 + 1, size * 4)


def scored(grams: DataFrame, words: DataFrame) -> DataFrame:
    """gram, lang, a, l, r, score of phrases, by their lowest-scoring cut."""
    size = F.floor(F.octet_length("gram") / 4).cast("int")
    f = words.select(_key("id").alias("gram"), F.col("n").alias("f"), "lang").unionByName(grams.select("gram", F.col("a").alias("f"), F.lit(None).cast("string").alias("lang")))
    cuts = grams.select("gram", "a", size.alias("size"), F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.select("gram", "a", "k", _part("gram", F.lit(0), F.col("k")).alias("left"), _part("gram", F.col("k"), F.col("size") - F.col("k")).alias("right"))
    cuts = cuts.join(f.select(F.col("gram").alias("left"), F.col("f").alias("l"), "lang"), "left").join(f.select(F.col("gram").alias("right"), F.col("f").alias("r")), "right")
    exact = F.expr(f"(cast({SCALE} as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    best = cuts.withColumn("score", exact).groupBy("gram").agg(F.min_by(F.struct("a", "l", "r", "score"), F.struct("score", "k")).alias("x"), F.max("lang").alias("lang"))  # a cut after one word has the language
    return best.select("gram", "lang", "x.*")


def hidden(grams: DataFrame, hides: int = HIDES) -> DataFrame:
    """gram: phrases that stand inside a longer one which has ``hides`` per cent of their places. One word more
    is enough to look at: what a still longer phrase hides, one of those between hides too."""
    size = F.floor(F.octet_length("gram") / 4).cast("int")
    inside = grams.where(size > 2).select(F.explode(F.array(_part("gram", F.lit(0), size - 1), _part("gram", F.lit(1), size - 1))).alias("gram"), "a")
    most = inside.groupBy("gram").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    return grams.join(most, "gram").where(F.lit(100) * wide("longer") >= F.lit(hides) * wide("a")).select("gram")


def best(found: DataFrame, words: DataFrame, top: int) -> DataFrame:
    """lang, rank, phrase and figures of the first ``top`` of each language. Only what can be among them is
    spelled out; parts of a language are ranked before the whole."""
    order = [F.desc("score"), F.desc("a")]
    near = found.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(PARTS)))
    for by in (["lang", "part"], ["lang"]):
        near = near.withColumn("place", F.rank().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("place") <= top).drop("place")
    near = cut(near.drop("part"))
    ids = F.transform(F.sequence(F.lit(0), F.floor(F.octet_length("gram") / 4).cast("int") - 1), lambda k: F.conv(F.hex(F.substring(F.col("gram"), k * 4 + 1, F.lit(4))), 16, 10).cast("long"))
    spelled = near.select("gram", F.posexplode(ids).alias("at", "id")).join(words.select("id", F.col("word").cast("string").alias("word")), "id")
    names = spelled.groupBy("gram").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda w: w["word"]), " ").alias("phrase"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order, "phrase"))
    return near.join(names, "gram").withColumn("rank", rank.cast("long")).where(F.col("rank") <= top)


def mine(df: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP, hides: int = HIDES, small: int = WORDS) -> DataFrame:
    """lang, rank, phrase, a (places), l and r (places of the parts of its lowest-scoring cut), n (words of the
    language), score; up to ``small`` frequent words the dictionary is broadcast."""
    docs = df.select(F.coalesce(df[lang].cast("string"), F.lit("und")).alias("lang"), F.coalesce(df[text].cast("string"), F.lit("")).alias("text"))
    with Work(tune(df.sparkSession, 64)) as work:
        counts = work.written(counted(docs).where(F.col("word").isNull() | (F.col("n") >= least)), "counts")
        totals = counts.where(F.col("word").isNull()).select("lang", F.col("n").alias("total"))
        words = work.written(numbered(counts.where(F.col("word").isNotNull()), work), "dictionary")
        size = words.agg(F.count("*").alias("words"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
        width = max(1, (size.words.bit_length() + 7) // 8)
        first = bounds(*bins(words, size.words), RANGE)
        fits = size.words <= small and size.bytes <= BYTES
        ranges = ranges_of_small(docs, words, first, width) if fits else ranges_of_large(docs, words, first, width, work)
        grams = work.written(frequent(ranges, len(first[0]) + 1, least, width), "grams")
        shown = work.written(scored(grams, words).join(hidden(grams, hides), "gram", "left_anti"), "scored")
        found = best(shown, words, top).join(totals, "lang")
        return cut(found.select("lang", "rank", "phrase", "a", "l", "r", F.col("total").alias("n"), "score"))
