"""SimHash near-duplicates by anchor-point covering.

A fingerprint has 64 bits, cut into blocks; two are linked if at most ``bits`` differ. Each block
has its own anchors: the words of a covering code, a product of perfect codes (Golay, 23 bits,
covering radius 3; Hamming, 7 or 15 bits, radius 1) and of bits as they are. A block has exactly one
nearest anchor, its home. If two fingerprints differ in at most ``bits`` bits, one of their blocks
differs in at most bits // blocks, which is 1 for the coverings here. So a fingerprint is copied,
for each block, to every anchor that is the home of something within 1 bit (of all anchors within
the covering radius plus the threshold those that matter, about ten), and meets there every
fingerprint at home there that could be linked. Fingerprints are compared at their anchors only.

``near_duplicates`` links by fingerprint alone and collapses copies of a fingerprint first. A large
anchor is dealt in chunks of its home fingerprints, and where one fingerprint is near very many only
links that join two groups are kept, so a crowd does not give all its pairs. Components come from
``components.connected``.

``deduplicate`` is for texts that must be alike: its groups are the components of all pairs whose
five-word shingles have a Jaccard similarity of 0.8 or more, and one document of each stays. Sets of
shingles are linked by their fingerprints, as above; a link counts once the sets have been compared. As
no fingerprint of 64 bits tells such a similarity within few bits, an exact join by the first shingles
of each text follows, which finds the pairs between what fingerprints have not joined.

Defined results: null or blank texts have fingerprint zero and are linked like any other; repeated
rows each get a row; rows with a null id are linked too and get their component's smallest id (null
if it has none), and ``deduplicate`` keeps them; an empty table gives no rows; other columns are
ignored, or kept by ``deduplicate``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.components import connected
from granary.llm.util import Work, cut, free_name, release, tune

SEED = 42
WIDTH = 3
BITS = 3
#: Home fingerprints of an anchor that one task compares at a time.
CHUNK = 4096
#: A guest keeps all of its links at an anchor, if these are no more.
SMALL = 24
#: Anchors with so few home fingerprints are compared many at a time.
FEW = 8
#: Crowded anchors (16 bytes each) up to which their list is broadcast.
BROADCAST_ROWS = 500_000


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """The fingerprint of one text, as an unsigned integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxhash.xxh64_intdigest(joined, SEED)
    gaps = np.flatnonzero(np.frombuffer(joined, dtype=np.uint8) == 32)
    starts = [0, *(gaps[: len(words) - width] + 1).tolist()]
    ends = [*gaps[width - 1 :].tolist(), len(joined)]
    digest = xxhash.xxh64_digest
    ones, n = np.zeros(64, dtype=np.int64), len(starts)
    for k in range(0, n, 32768):  # bounded memory for very long texts
        ones += _ones(b"".join([digest(joined[s:e], SEED) for s, e in zip(starts[k : k + 32768], ends[k : k + 32768])]))
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def _ones(raw: bytes) -> np.ndarray:
    """How many of these hashes have each bit."""
    bits = np.unpackbits(np.frombuffer(raw, dtype=np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduce(bits, axis=0, dtype=np.int64) if len(bits) > 255 else bits.sum(axis=0, dtype=np.uint8)


def set_fingerprint(hashes: np.ndarray) -> int:
    """The fingerprint of a set of shingles, as an unsigned integer; zero if it is empty."""
    ones = sum((_ones(hashes[k : k + 32768].astype(">u8").tobytes()) for k in range(0, len(hashes), 32768)), np.zeros(64, dtype=np.int64))
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, doc_id: str, text: str, of: Callable[[str | None], int] = fingerprint, digest: Column | None = None) -> DataFrame:
    """doc_id, fp (as a signed long) and digest of every row."""
    tune(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((of(t.as_py()) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp.view(np.int64)), b.column(2)], names=["doc_id", "fp", "digest"])

    kept = docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text"), (F.lit(None).cast("string") if digest is None else digest).alias("digest"))
    return kept.mapInArrow(run, f"doc_id {id_type}, fp long, digest string")


# The covering code. ----------------------------------------------------------------------------

GOLAY_POLY = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, generator of the Golay code


def _golay_syndrome(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint32)
    for i in range(22, 10, -1):
        x = np.where(x >> np.uint32(i) & np.uint32(1), x ^ np.uint32(GOLAY_POLY << (i - 11)), x)
    return x


def _golay_leaders() -> np.ndarray:
    """The error of at most 3 bits for each of the 2048 syndromes: a perfect code has exactly one."""
    from itertools import combinations

    errors = np.array([sum(1 << i for i in c) for w in range(4) for c in combinations(range(23), w)], dtype=np.uint32)
    out = np.zeros(2048, dtype=np.uint32)
    out[_golay_syndrome(errors)] = errors
    return out


_GOLAY = _golay_leaders()


def _hamming_decode(x: np.ndarray, n: int) -> np.ndarray:
    """The nearest word of the Hamming code of n = 2^m - 1 bits; the parity check of bit i is i + 1."""
    s = np.zeros_like(x)
    for i in range(n):
        s ^= np.where(x >> np.uint32(i) & np.uint32(1), np.uint32(i + 1), np.uint32(0))
    return np.where(s > 0, x ^ (np.uint32(1) << (np.maximum(s, 1) - np.uint32(1))), x)


#: The parts of a block: "golay" (23 bits), "hamming" (7 or 15) or "plain". A fingerprint has 64 bits.
HALVES = (("golay", 23), ("hamming", 7), ("plain", 2))
QUARTERS = (("hamming", 15), ("plain", 1))


def home(block: np.ndarray, parts: tuple = HALVES) -> np.ndarray:
    """The nearest anchor of each word of a block."""
    block, out, at = block.astype(np.uint32), np.zeros(len(block), dtype=np.uint32), 0
    for kind, n in parts:
        x = block >> np.uint32(at) & np.uint32((1 << n) - 1)
        if kind == "golay":
            x = x ^ _GOLAY[_golay_syndrome(x)]
        elif kind == "hamming":
            x = _hamming_decode(x, n)
        out |= x << np.uint32(at)
        at += n
    return out


def reached(block: np.ndarray, parts: tuple = HALVES) -> tuple[np.ndarray, np.ndarray]:
    """(row, anchor), each pair once: all homes of words within 1 bit of each word."""
    width = sum(n for _, n in parts)
    flips = np.concatenate([np.zeros(1, np.uint32), np.uint32(1) << np.arange(width, dtype=np.uint32)])
    anchors = np.stack([home(block ^ f, parts) for f in flips], axis=1)
    anchors.sort(axis=1)
    first = np.ones(anchors.shape, dtype=bool)
    first[:, 1:] = anchors[:, 1:] != anchors[:, :-1]
    row, col = np.nonzero(first)
    return row, anchors[row, col]


def placed(nodes: DataFrame, parts: tuple = HALVES) -> DataFrame:
    """anchor, guest (0: at home there, 1: copied there), fp, id. An anchor's number holds its block."""
    width = sum(n for _, n in parts)

    def run(batches):
        for b in batches:
            fp, ids = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for lo in range(0, len(fp), 4096):
                f, own = fp[lo : lo + 4096].view(np.uint64), ids[lo : lo + 4096]
                for k in range(64 // width):
                    block = (f >> np.uint64(width * k) & np.uint64((1 << width) - 1)).astype(np.uint32)
                    row, anchor = reached(block, parts)
                    key = np.concatenate([home(block, parts), anchor]).astype(np.int64) + (k << 32)
                    guest = np.concatenate([np.zeros(len(f), np.int32), np.ones(len(row), np.int32)])
                    cols = [key, guest, np.concatenate([f, f[row]]).view(np.int64), np.concatenate([own, own[row]])]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", "guest", "fp", "id"])

    return nodes.select("fp", "id").mapInArrow(run, "anchor long, guest int, fp long, id long")


def _crowd(homes: np.ndarray, home_ids: np.ndarray, guests: np.ndarray, guest_ids: np.ndarray, bits: int) -> tuple[list, list]:
    """Links of one large anchor. A guest that is near at most ``SMALL`` home fingerprints keeps all
    of these links; of others only those are kept that join groups, so that what the anchor connects
    stays connected with fewer links than it has members."""
    label, a, b = np.arange(len(homes)), [], []
    step = max(1, 1_000_000 // len(homes))
    for lo in range(0, len(guests), step):
        g, i = guests[lo : lo + step], guest_ids[lo : lo + step]
        gap = np.bitwise_count(homes[None, :] ^ g[:, None])
        near = (gap <= bits) & (home_ids[None, :] != i[:, None])
        count = near.sum(axis=1)
        row, col = np.nonzero(near & (count <= SMALL)[:, None])
        a.append(i[row])
        b.append(home_ids[col])
        for k in np.flatnonzero(count > SMALL):
            at = np.flatnonzero(near[k])
            labels = np.unique(label[at])
            first = at[np.argmin(gap[k, at])]
            a.append(np.concatenate([i[k : k + 1], np.repeat(home_ids[labels[0]], len(labels) - 1)]))
            b.append(np.concatenate([home_ids[first : first + 1], home_ids[labels[1:]]]))
            for other in labels[1:]:
                label[label == other] = labels[0]
    return a, b


def links(nodes: DataFrame, bits: int = BITS, parts: tuple = HALVES, chunk: int = CHUNK) -> DataFrame:
    """a, b: enough links between ids to connect all nodes (fp, id) that links of at most ``bits``
    bits connect; all links of a fingerprint that is near at most ``SMALL`` others at an anchor."""
    if bits // (64 // sum(n for _, n in parts)) > 1:
        raise ValueError("this covering finds links within 1 bit of a block only")
    rows = cut(placed(nodes, parts))
    crowded = (
        rows.where("guest = 0").groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > chunk).select("anchor", F.ceil(F.col("n") / chunk).cast("int").alias("parts"))
    )
    n_crowded = crowded.count()
    if n_crowded:
        crowded = F.broadcast(crowded) if n_crowded <= BROADCAST_ROWS else crowded
        dealt = rows.join(crowded, "anchor", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
        part = F.when(F.col("guest") == 0, F.array(F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
        dealt = dealt.select("anchor", F.explode(part).alias("part"), "guest", "fp", "id")
    else:
        dealt = rows.select("anchor", F.lit(0).alias("part"), "guest", "fp", "id")

    def run(batches):
        carry = None
        for b in batches:
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
            if carry is not None:
                cols = [np.concatenate(x) for x in zip(carry, cols)]
            new = np.flatnonzero((np.diff(cols[0]) != 0) | (np.diff(cols[1]) != 0)) + 1
            last = new[-1] if len(new) else 0
            if last:
                yield from _compare_groups(*(x[:last] for x in cols), bits)
            # Of an unfinished group whose guests have begun, what has been compared is let go.
            cols = [x[last:] for x in cols]
            n_home = int((cols[2] == 0).sum())
            if len(cols[0]) > 2 * n_home + 20_000 and (cols[2] == 1).any():
                yield from _compare_groups(*cols, bits)
                cols = [x[:n_home] for x in cols]
            carry = cols
        if carry is not None and len(carry[0]):
            yield from _compare_groups(*carry, bits)

    return dealt.repartition("anchor", "part").sortWithinPartitions("anchor", "part", "guest").mapInArrow(run, "a long, b long").distinct()


def _compare_groups(anchor, part, guest, fp, ids, bits) -> Iterator[pa.RecordBatch]:
    """Compare whole groups that stand one after another, each with its homes first."""
    f = fp.view(np.uint64)
    starts = np.concatenate([[0], np.flatnonzero((np.diff(anchor) != 0) | (np.diff(part) != 0)) + 1])
    sizes = np.diff(np.concatenate([starts, [len(f)]]))
    homes = np.add.reduceat(guest == 0, starts, dtype=np.int64)
    out_a, out_b = [], []
    small = (homes > 0) & (homes <= FEW)
    # All small groups at once: each guest against each home of its anchor.
    gid = np.repeat(np.arange(len(starts)), sizes)
    who = np.flatnonzero((guest == 1) & small[gid])
    for lo in range(0, len(who), 50_000):
        w = who[lo : lo + 50_000]
        n = homes[gid[w]]
        left = np.repeat(w, n)
        right = np.repeat(starts[gid[w]], n) + np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n)
        near = (np.bitwise_count(f[left] ^ f[right]) <= bits) & (ids[left] != ids[right])
        out_a.append(ids[left[near]])
        out_b.append(ids[right[near]])
    for k in np.flatnonzero(homes > FEW):
        s, m, e = starts[k], starts[k] + homes[k], starts[k] + sizes[k]
        a, b = _crowd(f[s:m], ids[s:m], f[m:e], ids[m:e], bits)
        out_a += a
        out_b += b
    if out_a:
        a, b = np.concatenate(out_a), np.concatenate(out_b)
        if len(a):
            yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, bits: int = BITS) -> DataFrame:
    """doc_id, fp, component_id of every row: components of fingerprints within ``bits`` bits."""
    prints = cut(fingerprints(docs, doc_id, text, lambda t: fingerprint(t, width)))
    classes = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected(links(classes.select("fp", F.col("fp").alias("id")), bits)).withColumnRenamed("node", "fp")
    grouped = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    low = grouped.groupBy("root").agg(F.min("low").alias("component_id"))
    members = grouped.join(low, "root").select("fp", "component_id")
    return prints.join(members, "fp").select("doc_id", "fp", "component_id")


# Groups of similar texts. ----------------------------------------------------------------------

_WORD = re.compile(r"\w+")
STAGE_WIDTH, SIMILARITY = 5, 0.8
#: Documents whose shingles are counted for the list of common ones, texts that one must stand in
#: and the most that are listed. The list sets the order of shingles only; any order finds all pairs.
COUNTED, COMMON, LISTED = 50_000, 10, 50_000
#: Texts with one shingle up to which their pairs are formed; more are compared in blocks.
PAIRED = 512
#: First shingles that two similar sets share at least; prefixes are so much longer.
SHARED = 3
#: Shingles of a block's side.
BLOCK = 1_000_000


def shingle_hashes(text: str | None, width: int = STAGE_WIDTH) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles (of all its words, if fewer)."""
    w = [x.encode("utf-8", "surrogatepass") for x in _WORD.findall((text or "").lower())]
    if not w:
        return np.zeros(0, dtype=np.uint64)
    grams = zip(*(w[i:] for i in range(width))) if len(w) >= width else [w]
    raw = b"".join([xxhash.xxh64_digest(b" ".join(g), SEED) for g in grams])
    return np.unique(np.frombuffer(raw, dtype=">u8").astype(np.uint64))


def checked(pairs: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """Those pairs (a, b) whose sets of shingles, in ``held`` (id, s), have that similarity."""

    def check(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.frombuffer(v.as_py(), dtype=np.uint64) for v in (x, y))
                keep.append(bool(_alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), similarity)))
            m = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column(0).filter(m), b.column(1).filter(m)], names=["a", "b"])

    both = pairs.join(held.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(held.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(check, "a long, b long")


def _alike(both, m, n, similarity: float):
    return both >= similarity * (m + n - both) - 1e-9


def prefix_length(n: int, similarity: float) -> int:
    """Two sets with that Jaccard similarity share ``SHARED`` of so many first elements, in any one
    order, or all that they share if that is less."""
    return min(n, n - max(1, math.ceil(similarity * n - 1e-6)) + SHARED) if n else 0


def shingled(docs: DataFrame, doc_id: str, text: str, width: int) -> DataFrame:
    """doc_id, id (a hash of the set of shingles), s (the set) of every row."""
    tune(docs.sparkSession)
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            sets = [shingle_hashes(t.as_py(), width).tobytes() for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([set_id(s) for s in sets], pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "id", "s"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {id_type}, id long, s binary")


def set_id(raw: bytes) -> int:
    h = xxhash.xxh64_intdigest(raw, SEED)
    return h - 2**64 if h >= 2**63 else h


def common_shingles(docs: DataFrame, text: str, width: int, similarity: float) -> np.ndarray:
    """Shingles that stand in many of the texts, as far as a sample tells."""
    tune(docs.sparkSession)
    n = docs.count()

    def low(batches):
        for b in batches:
            found = [x[: 2 * prefix_length(len(x), similarity)] for x in (shingle_hashes(t.as_py(), width) for t in b.column(0))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64))], names=["tok"])

    some = docs.where(F.pmod(F.xxhash64(docs[text], F.lit(3)), F.lit(1_000_000)) < min(1.0, COUNTED / max(n, 1)) * 1_000_000).select(docs[text])
    counted = some.mapInArrow(low, "tok long").groupBy("tok").agg(F.count("*").alias("n")).where(F.col("n") >= COMMON)
    return np.sort(np.array([r.tok for r in counted.orderBy(F.desc("n"), "tok").limit(LISTED).collect()], dtype=np.int64).view(np.uint64))


def begun(docs: DataFrame, doc_id: str, text: str, width: int, similarity: float) -> DataFrame:
    """doc_id, id, n, fp, first: the size and fingerprint of every row's set of shingles, and its first shingles
    in one order, common ones last. The set itself goes no further; it is made again for the few that need it."""
    listed = docs.sparkSession.sparkContext.broadcast(common_shingles(docs, text, width, similarity))
    id_type = docs.schema[doc_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            ids, sizes, prints, firsts = [], [], [], []
            for t in b.column(1):
                x = shingle_hashes(t.as_py(), width)
                last = np.searchsorted(listed.value, x, "right") > np.searchsorted(listed.value, x, "left")
                ids.append(set_id(x.tobytes()))
                sizes.append(len(x))
                prints.append(set_fingerprint(x))
                firsts.append(np.concatenate([x[~last], x[last]])[: prefix_length(len(x), similarity)].tobytes())
            fp = pa.array(np.array(prints, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.int64()), pa.array(sizes, pa.int32()), fp, pa.array(firsts, pa.binary())], names=["doc_id", "id", "n", "fp", "first"])

    return docs.select(docs[doc_id].alias("doc_id"), docs[text].alias("text")).mapInArrow(run, f"doc_id {id_type}, id long, n int, fp long, first binary")


def prefixes(sets: DataFrame) -> DataFrame:
    """tok, id, n, at: the first shingles of every set (id, n, first) with their places."""

    def run(batches):
        for b in batches:
            firsts = [np.frombuffer(v.as_py(), dtype=np.int64) for v in b.column(2)]
            each = np.array([len(x) for x in firsts], dtype=np.int64)
            if each.sum():
                at = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
                cols = [np.concatenate(firsts), np.repeat(b.column(0).to_numpy(), each), np.repeat(b.column(1).to_numpy(), each), at.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["tok", "id", "n", "at"])

    return sets.select("id", "n", "first").mapInArrow(run, "tok long, id long, n int, at int")


def spanning(ids: np.ndarray, labels: np.ndarray, sets: list[np.ndarray], similarity: float) -> list[tuple[int, int]]:
    """Links that join groups, of pairs that are alike: every pair is compared that has different
    labels and has not been joined by such links before."""
    sizes = np.array([len(s) for s in sets])
    _, place = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    _, label, count = np.unique(labels, return_inverse=True, return_counts=True)
    mark, out = np.zeros(place.max() + 1, dtype=bool), []
    for k in np.flatnonzero(label != count.argmax()):
        if (label == label[0]).all():
            break
        own = place[starts[k] : starts[k] + sizes[k]]
        mark[own] = True
        shared = np.add.reduceat(mark[place], starts, dtype=np.int64)
        mark[own] = False
        near = np.flatnonzero(_alike(shared, sizes, sizes[k], similarity) & (label != label[k]))
        for other, at in zip(*np.unique(label[near], return_index=True)):
            out.append((int(ids[k]), int(ids[near[at]])))
            label[label == other] = label[k]
    return out


def joining(rows: DataFrame, held: DataFrame, similarity: float) -> DataFrame:
    """a, b: verified links. Of the sets that share a ``tok`` in ``rows`` (tok, id, n, label) all pairs
    with different labels are compared, in blocks."""
    many = rows.join(rows.groupBy("tok").agg(F.sum("n").alias("total")), "tok").withColumn("parts", F.ceil(F.col("total") / BLOCK).cast("int"))
    own = F.pmod(F.xxhash64("id", F.lit(9)), F.col("parts")).cast("int")
    sides = many.select("tok", "id", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    blocks = sides.select("tok", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "id", "label").join(held, "id").select("tok", "i", "j", "id", "label", "s")

    def run(batches):
        key, ids, labels, sets = None, [], [], []

        def done():
            found = spanning(np.array(ids), np.array(labels), sets, similarity)
            return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

        for b in batches:
            for *now, i, label, s in zip(*(b.column(k).to_pylist() for k in range(6))):
                if now != key:
                    if key is not None:
                        yield done()
                    key, ids, labels, sets = now, [], [], []
                ids.append(i)
                labels.append(label)
                sets.append(np.frombuffer(s, dtype=np.uint64))
        if key is not None:
            yield done()

    return blocks.repartition("tok", "i", "j").sortWithinPartitions("tok", "i", "j").mapInArrow(run, "a long, b long")


def met_by(sets: DataFrame) -> DataFrame:
    """tok, id, n, at, lo, c: the first shingles that several sets have, the least of these sets, and
    their number."""
    ends = Window.partitionBy("tok")
    met = prefixes(sets).withColumns({"lo": F.min("id").over(ends), "c": F.count("*").over(ends)})
    return met.where("c > 1")


def formed(few: DataFrame, similarity: float) -> DataFrame:
    """a, b: the pairs of sets that share enough of their first shingles in ``few`` (tok, id, n, at,
    label) to be alike, and have different labels. What follows the first shingle that two sets share
    bounds all that they share."""
    x, y = few.alias("x"), few.alias("y")
    fits = F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n") - 1e-6
    due = F.least(F.lit(SHARED), F.ceil(similarity * F.greatest("x.n", "y.n") - 1e-6))
    rest = F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    enough = similarity / (1 + similarity) * (F.col("x.n") + F.col("y.n")) - 1e-6
    both = x.join(y, (F.col("x.tok") == F.col("y.tok")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label")) & fits)
    pairs = both.groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b")).agg(F.count("*").alias("c"), F.max(due).alias("due"), F.max(rest - enough).alias("left"))
    return pairs.where("c >= due and left >= 0").select("a", "b")


def linked(sets: DataFrame, similarity: float, bits: int = BITS) -> DataFrame:
    """a, b: the sets (id, n, fp) that their fingerprints link, of sizes that such a similarity allows. The least of each
    fingerprint stands for it."""
    least = F.struct(F.col("id").alias("id"), F.col("n").alias("n"))
    prints = cut(sets.groupBy("fp").agg(F.min(least).alias("low")))
    near = links(prints.select("fp", F.col("fp").alias("id")), bits)
    side = lambda fp, x: prints.select(F.col("fp").alias(fp), F.col("low").alias(x))
    same = sets.select("fp", least.alias("x")).join(side("fp", "y"), "fp").where("x.id <> y.id").select("x", "y")
    pairs = same.unionByName(near.join(side("a", "x"), "a").join(side("b", "y"), "b").select("x", "y"))
    return pairs.where(F.least("x.n", "y.n") >= similarity * F.greatest("x.n", "y.n") - 1e-6).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def alike(sets: DataFrame, held_of: Callable[[DataFrame], DataFrame], similarity: float) -> DataFrame:
    """node, root: the components of sets (id, n, fp, first) of that Jaccard similarity, of those that are
    linked. ``held_of`` gives the whole sets (id, s) of ids.

    First sets are compared that fingerprints link. Two alike sets share ``SHARED`` of their first shingles;
    every set is also compared with the least that it shares so many with, as few of a crowd of cut or edited
    texts have near fingerprints. That joins most sets before their pairs are looked at. Of sets
    that verified links have not joined yet, pairs are formed where the shingles that they share stand
    in few sets; a shingle in many has its sets compared in blocks, under a sixteenth of these shingles
    first."""
    met = cut(met_by(sets))
    first = met.where("id <> lo").groupBy(F.col("id").alias("a"), F.col("lo").alias("b")).agg(F.count("*").alias("c"), F.max("n").alias("n"))
    first = first.where(F.col("c") >= F.least(F.lit(SHARED), F.ceil(similarity * F.col("n") - 1e-6))).select("a", "b")
    both = linked(sets, similarity).unionByName(first).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    first = cut(both.distinct())

    def compared(pairs: DataFrame) -> DataFrame:
        release(sets.sparkSession)
        ids = cut(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct())
        found = cut(checked(pairs, held_of(ids), similarity))
        release(sets.sparkSession)
        return found

    def labelled(rows: DataFrame, roots: DataFrame) -> DataFrame:
        known = roots.select(F.col("node").alias("id"), "root")
        return rows.join(known, "id", "left").select("tok", "id", "n", "at", F.coalesce("root", "id").alias("label"))

    links_ = compared(first)
    roots = connected(links_)
    pairs = cut(formed(labelled(met.where(F.col("c") <= PAIRED), roots), similarity))
    more = compared(pairs)
    if not more.isEmpty():
        links_ = cut(links_.unionByName(more))
        roots = connected(links_)
    crowd = met.where(F.col("c") > PAIRED)
    if not crowd.isEmpty():
        for some in (F.pmod("tok", F.lit(16)) == 0, F.pmod("tok", F.lit(16)) != 0):
            rows = cut(apart(labelled(crowd.where(some), roots)))
            held = cut(held_of(cut(rows.select("id").distinct())))
            release(sets.sparkSession)
            more = cut(joining(rows, held, similarity))
            release(sets.sparkSession)
            if not more.isEmpty():
                links_ = cut(links_.unionByName(more))
                roots = connected(links_)
    return roots


def apart(rows: DataFrame) -> DataFrame:
    """Those rows (tok, id, n, at, label) whose ``tok`` has different labels."""
    several = rows.groupBy("tok").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi").select("tok")
    return rows.join(several, "tok", "left_semi")


def groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = STAGE_WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """id, group_id of every document with an id that is not the smallest of its group.

    Texts with equal sets of shingles are one node; groups are the components of all pairs of nodes
    whose sets have that Jaccard similarity."""
    docs = docs.where(docs[doc_id].isNotNull())
    with Work(docs.sparkSession) as work:
        rows = work.written(begun(docs, doc_id, text, width, similarity), "first-shingles")
        sets = rows.groupBy("id").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("first").alias("first"))

        def held_of(ids: DataFrame) -> DataFrame:
            ids = F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids
            wanted = cut(rows.select("doc_id", "id").join(ids, "id", "left_semi").groupBy("id").agg(F.min("doc_id").alias("low")))
            few = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
            low = free_name(docs, "low")
            found = shingled(docs.join(few.select(F.col("low").alias(low)), docs[doc_id] == F.col(low), "left_semi"), doc_id, text, width)
            # An id may have several rows with other texts; those sets go again here.
            return found.select("id", "s").join(ids, "id", "left_semi").dropDuplicates(["id"])

        roots = alike(sets, held_of, similarity).withColumnRenamed("node", "id")
        placed_ = work.written(rows.select("doc_id", "id").join(roots, "id", "left").select("doc_id", F.coalesce("root", "id").alias("root")), "placed")
        led = placed_.groupBy("root").agg(F.min("doc_id").alias("group_id"))
        return cut(placed_.join(led, "root").where("doc_id <> group_id").select(F.col("doc_id").alias("id"), "group_id"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The documents, less those that are not the smallest of their group."""
    gone = groups(docs, doc_id, text, **kw).select(F.col("id").alias(doc_id))
    return docs.join(gone, doc_id, "left_anti")


def hexed(fp: str) -> Column:
    """A fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
