"""Hard negatives by one-dimensional distance keys.

Components become integers (the floor of 256 x), so scores, inner products, are exact. Every vector x gets one
more component, sqrt(M^2 - |x|^2) with M the longest length; an anchor gets zero. Then the squared distance of an
anchor q to x is M^2 + |q|^2 - 2 q.x: the highest scores are the nearest points.

Points are stored sorted by (pivot, distance to the pivot): pivots are centres of a bounded sample, each
point belongs to the nearest. By the triangle inequality a point at distance r from a pivot lies between |d - r| and
d + r from an anchor that is d away from it. So an anchor looks at intervals of keys, annuli around pivots; its
radius grows until no interval that is left can hold a score above the worst of its best (or, for negatives,
within its window), which certifies them. The k-th best found so far goes with the anchor, so a later scan sends only
what can still matter.

Intervals are cells of bounded size, planned from counts of 1,024 steps for each pivot; a cell of more rows (points at
one distance) is dealt in parts. Of equal vectors with one label only the smallest ids can be among the first,
so a vector that fills a third of the table has a handful of rows in the index.

First each anchor's positives are sought (the best of its own label), then, for all windows of an anchor at
once, the best of other labels within [low, high] per cent of a positive's score. On data without clusters in
many dimensions distance keys exclude little: then nearly all cells are scanned, in blocks, and the results
are exact all the same.

Defined results: rows with a null id, label or vector, or with a null or non-finite component take no part; of several
rows with one id the one with the smallest label, then vector, counts; a shorter vector counts as filled up with
zeros; vectors whose squared integer length is 2^62 or more take no part, as their scores pass 64 bits; ties go to
smaller ids; anchors without positives, and positives without negatives in their window, give no rows; an empty table
gives none; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.llm.util import Work, cut, tune

SCALE = 256
EVERY = 100
PIVOTS, SAMPLE, STEPS = 64, 20_000, 1024
#: Numbers that a block of a cell holds, and cells that there are at most (besides the pivots').
VALUES, CELLS = 2_000_000, 20_000
#: Rows that an anchor looks at first, and by how much that grows.
FIRST, GROW = 4096, 16
#: Scores without bound; squared lengths up to which scores fit in 64 bits, and up to which doubles hold them.
ANY, FITS, EXACT = 1 << 62, 2.0**62, 2.0**53


def usable(df: DataFrame, vec_id: str, label: str, vector: str) -> DataFrame:
    """id, label, q (whole numbers as doubles) of the rows that take part, one for each id."""
    x = F.transform(df[vector], lambda c: c.cast("double"))
    d = df.where(df[vec_id].isNotNull() & df[label].isNotNull() & df[vector].isNotNull()).select(df[vec_id].cast("long").alias("id"), df[label].cast("long").alias("label"), x.alias("x"))
    d = d.where(~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    whole = F.transform("x", lambda c: F.when(F.abs(c * SCALE) < 2.0**52, F.floor(c * SCALE).cast("double")).otherwise(c * SCALE))
    d = d.select("id", "label", whole.alias("q")).where(norm2("q") < FITS)
    return d.groupBy("id").agg(F.min(F.struct("label", "q")).alias("r")).select("id", "r.label", "r.q")


def norm2(column: str) -> Column:
    return F.aggregate(column, F.lit(0.0), lambda a, c: a + c * c)


def matrix(column, least: int = 0) -> np.ndarray:
    """A list column as rows, filled up with zeros to the longest."""
    flat, size = column.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    wide = max(least, int(size.max(initial=0)))
    if len(flat) == len(size) * wide:
        return flat.reshape(len(size), wide)
    out = np.zeros((len(size), wide))
    out[np.arange(wide) < size[:, None]] = flat
    return out


def widened(x: np.ndarray, wide: int) -> np.ndarray:
    return x if x.shape[1] >= wide else np.pad(x, ((0, 0), (0, wide - x.shape[1])))


class Space:
    """Pivots and the longest length, and the distances that follow from them."""

    def __init__(self, pivots: np.ndarray, m2: float):
        self.own, self.more, self.m2 = pivots[:, :-1], pivots[:, -1], m2
        self.p2 = (pivots**2).sum(axis=1)

    def _to(self, x: np.ndarray, x2: np.ndarray, more: np.ndarray) -> np.ndarray:
        wide = min(x.shape[1], self.own.shape[1])
        dot = x[:, :wide] @ self.own[:, :wide].T + more[:, None] * self.more
        return np.sqrt(np.maximum(0, (x2 + more**2)[:, None] + self.p2 - 2 * dot))

    def of_points(self, x: np.ndarray) -> np.ndarray:
        x2 = (x**2).sum(axis=1)
        return self._to(x, x2, np.sqrt(np.maximum(0, self.m2 - x2)))

    def of_anchors(self, q: np.ndarray) -> np.ndarray:
        return self._to(q, (q**2).sum(axis=1), np.zeros(len(q)))


def learn(points: DataFrame, n: int, m2: float, pivots: int = PIVOTS, sample: int = SAMPLE, rounds: int = 5) -> Space:
    """Centres of a sample of about ``sample`` points, chosen by hash."""
    share = min(1.0, sample / max(n, 1))
    got = points.where(F.pmod(F.xxhash64("id", F.lit(5)), F.lit(1_000_000)) < share * 1_000_000).orderBy("id").select("q").toArrow()
    x = matrix(got.column(0).combine_chunks()) if got.num_rows else np.zeros((1, 1))
    x = np.c_[x, np.sqrt(np.maximum(0, m2 - (x**2).sum(axis=1)))]
    c = x[np.random.default_rng(0).permutation(len(x))[:pivots]]
    for _ in range(rounds):
        near = ((c**2).sum(axis=1) - 2 * x @ c.T).argmin(axis=1)
        held = np.unique(near)
        c = np.array([x[near == k].mean(axis=0) for k in held])
    return Space(c, m2)


def keyed(points: DataFrame, space: Space) -> DataFrame:
    """The points with pivot and distance."""
    held = points.sparkSession.sparkContext.broadcast(space)  # pivots x dimensions

    def run(batches):
        for b in batches:
            if b.num_rows:
                d = held.value.of_points(matrix(b.column(2)))
                near = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(near, pa.int32()), pa.array(d[np.arange(len(d)), near])], names=[*b.schema.names, "pivot", "dist"])

    return points.select("id", "label", "q").mapInArrow(run, "id long, label long, q array<double>, pivot int, dist double")


class Cells:
    """Intervals of keys: pivot, nearest and farthest distance, rows and parts of each."""

    def __init__(self, steps: list[tuple], most: int, block: int):
        """steps: pivot, step, rows, nearest, farthest, in order. A cell takes steps up to ``most`` rows."""
        cells: list[list] = []
        self.of: list[tuple[int, int, int]] = []
        for pivot, step, rows, lo, hi in steps:
            if not cells or cells[-1][0] != pivot or cells[-1][3] + rows > most:
                cells.append([pivot, lo, hi, 0])
            cells[-1][2:] = [hi, cells[-1][3] + rows]
            self.of.append((pivot, step, len(cells) - 1))
        self.pivot, self.rows = np.array([c[0] for c in cells], int), np.array([c[3] for c in cells], int)
        self.lo, self.hi = np.array([c[1] for c in cells], float), np.array([c[2] for c in cells], float)
        self.parts = np.maximum(1, -(-self.rows // block))


def stored(points: DataFrame, space: Space, n: int, wide: int, work: Work) -> tuple[DataFrame, Cells]:
    """The index: points sorted by cell and distance, which is their order by pivot and distance."""
    step = F.least(F.lit(STEPS - 1), F.floor(F.col("dist") / F.lit(max(2 * space.m2**0.5, 1e-300)) * STEPS)).cast("int")
    rows = work.written(keyed(points, space).withColumn("step", step), "keys")
    counts = rows.groupBy("pivot", "step").agg(F.count("*").alias("n"), F.min("dist").alias("lo"), F.max("dist").alias("hi")).collect()  # PIVOTS x STEPS at most
    block = max(64, VALUES // max(wide, 1))
    cells = Cells(sorted(map(tuple, counts)), max(block, n // CELLS), block)
    named = [(p, s, c, int(cells.parts[c])) for p, s, c in cells.of]
    listed = points.sparkSession.createDataFrame(named, "pivot int, step int, cell int, parts int")  # as many
    placed = rows.join(F.broadcast(listed), ["pivot", "step"]).select("cell", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int").alias("part"), "dist", "id", "label", "q")
    return work.written(placed.repartitionByRange("cell", "part").sortWithinPartitions("cell", "part", "dist"), "index"), cells


STATE = "query long, label long, q array<double>, lo array<long>, hi array<long>, need array<long>, radius double"


def planned(state: DataFrame, space: Space, cells: Cells, budget: int) -> DataFrame:
    """The anchors that can still find something, the radius that they look within next, and the cells (with their
    parts) that this adds."""
    held = state.sparkSession.sparkContext.broadcast((space, cells))  # at most CELLS and some

    def run(batches):
        space, cells = held.value
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                b = whole.slice(at, 64)
                q = matrix(b.column(2))
                q2 = (q**2).sum(axis=1)
                d = space.of_anchors(q)[:, cells.pivot]
                near, far = np.maximum(0, np.maximum(d - cells.hi, cells.lo - d)), d + cells.hi
                slack = (1e-6 * (space.m2 + q2) + 1)[:, None]
                best, worst = ((space.m2 + q2)[:, None] - near**2) / 2 + slack, ((space.m2 + q2)[:, None] - far**2) / 2 - slack
                his, needs, radii = b.column(4).to_pylist(), b.column(5).to_pylist(), b.column(6).to_pylist()
                keep, out, radius = [], [], []
                for i in range(b.num_rows):
                    open_ = np.zeros(len(cells.rows), bool)
                    for hi, need in zip(his[i], needs[i]):
                        if need <= hi:
                            open_ |= (best[i] >= need) & (worst[i] <= hi)
                    new = np.flatnonzero(open_ & (near[i] > radii[i]))
                    if len(new):
                        new = new[np.argsort(near[i][new], kind="stable")]
                        last = min(int(np.searchsorted(np.cumsum(cells.rows[new]), budget)), len(new) - 1)
                        reach = float(near[i][new[last]])
                        keep.append(i)
                        radius.append(reach)
                        out.append([{"cell": int(c), "part": p} for c in new[near[i][new] <= reach] for p in range(cells.parts[c])])
                rows = b.take(pa.array(keep, pa.int64()))
                kind = pa.list_(pa.struct([("cell", pa.int32()), ("part", pa.int32())]))
                yield pa.RecordBatch.from_arrays([*rows.columns[:6], pa.array(radius, pa.float64()), pa.array(out, kind)], names=[*b.schema.names[:6], "radius", "at"])

    return state.select([c.split(" ")[0] for c in STATE.split(", ")]).mapInArrow(run, STATE + ", at array<struct<cell:int,part:int>>")


def scanned(index: DataFrame, asks: DataFrame, k: int, same: bool, exact: bool) -> DataFrame:
    """query, slot, id, score: of each part of a cell the k best within each window of each anchor that looks there."""

    def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
        wide = max(q.shape[1], x.shape[1])
        q, x = widened(q, wide), widened(x, wide)
        return np.rint(q @ x.T).astype(np.int64) if exact else q.astype(np.int64) @ x.astype(np.int64).T

    def found(rows, ids, labels, x) -> Iterator[tuple]:
        query, label, q = rows.column(3).to_numpy(), rows.column(4).to_numpy(), matrix(rows.column(5))
        his, needs = rows.column(6).to_pylist(), rows.column(7).to_pylist()
        for at in range(0, len(query), step := max(1, 2_000_000 // len(ids))):
            scores = products(q[at : at + step], x)
            for i, s in enumerate(scores, at):
                cand = np.flatnonzero((s >= min(needs[i])) & (s <= max(his[i])) & ((labels == label[i]) == same) & (ids != query[i]))
                if not len(cand):
                    continue
                if len(his[i]) == 1 and len(cand) > 4 * k:  # no more than ties with the k-th
                    cand = cand[s[cand] >= np.partition(s[cand], len(cand) - k)[len(cand) - k]]
                cand = cand[np.lexsort((ids[cand], -s[cand]))]
                down = -s[cand]
                for slot, (hi, need) in enumerate(zip(his[i], needs[i])):
                    lo = int(np.searchsorted(down, -hi, "left"))
                    for c in cand[lo : min(lo + k, int(np.searchsorted(down, -need, "right")))]:
                        yield int(query[i]), slot, int(ids[c]), int(s[c])

    def run(batches):
        key, parts, block = None, [], None
        for b in batches:
            cell, part, asking = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2).to_numpy(zero_copy_only=False).astype(bool)
            edge = np.flatnonzero((np.diff(cell) != 0) | (np.diff(part) != 0) | (np.diff(asking) != 0)) + 1
            for lo, hi in zip([0, *edge.tolist()], [*edge.tolist(), b.num_rows]):
                if lo == hi:
                    continue
                rows, now = b.slice(lo, hi - lo), (cell[lo], part[lo])
                if now != key:
                    key, parts, block = now, [], None
                if not asking[lo]:
                    parts.append((rows.column(3).to_numpy(), rows.column(4).to_numpy(), matrix(rows.column(5))))
                elif parts:
                    if block is None:
                        wide = max(p[2].shape[1] for p in parts)
                        block = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), np.concatenate([widened(p[2], wide) for p in parts])
                    out = list(found(rows, *block))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["query", "slot", "id", "score"])

    none = F.lit(None).cast("array<long>")
    own = index.select("cell", "part", F.lit(False).alias("asks"), "id", "label", "q", none.alias("hi"), none.alias("need"))
    theirs = asks.select("query", "label", "q", "hi", "need", F.explode("at").alias("at")).select("at.cell", "at.part", F.lit(True).alias("asks"), F.col("query").alias("id"), "label", "q", "hi", "need")
    return own.unionByName(theirs).repartition("cell", "part").sortWithinPartitions("cell", "part", "asks").mapInArrow(run, "query long, slot long, id long, score long")


def nearest(index: DataFrame, state: DataFrame, space: Space, cells: Cells, k: int, same: bool, exact: bool, work: Work) -> DataFrame:
    """query, slot, id, score, nth: the k best of each window of each anchor, of its own label or of the others."""
    rank = F.row_number().over(Window.partitionBy("query", "slot").orderBy(F.desc("score"), "id"))
    best, budget = None, FIRST
    while True:
        asks = work.written(planned(state, space, cells, budget), "asks")
        if asks.isEmpty():
            break
        asked = asks.select(F.explode("at").alias("at")).agg(F.collect_set("at.cell").alias("c")).first().c  # cells, of which there are few
        some = index if len(asked) > 1000 else index.where(F.col("cell").isin(asked))
        hits = scanned(some, asks, k, same, exact)
        hits = hits if best is None else hits.unionByName(best.drop("nth"))
        best = work.written(hits.withColumn("nth", rank).where(F.col("nth") <= k), "best")
        worst = best.where(F.col("nth") == k).groupBy("query").agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
        floor = F.transform(F.sequence(F.lit(0), F.size("lo") - 1), lambda j: F.greatest(F.col("lo")[j], F.coalesce(F.try_element_at("kth", j.cast("long")), F.col("lo")[j])))
        state = asks.join(worst, "query", "left").select("query", "label", "q", "lo", "hi", floor.alias("need"), "radius")
        budget *= GROW
    return best if best is not None else state.sparkSession.createDataFrame([], "query long, slot long, id long, score long, nth int")


def mine(df: DataFrame, vec_id: str = "vec_id", label: str = "label", vector: str = "embedding", every: int = EVERY, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row whose id is divisible by
    ``every`` its best rows of the same label, and for each of these the best rows of other labels whose score is
    between ``low`` and ``high`` per cent of the positive's."""
    spark = tune(df.sparkSession, 4096)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    with Work(spark) as work:
        rows = work.written(usable(df, vec_id, label, vector), "vectors")
        place = F.row_number().over(Window.partitionBy("label", "q").orderBy("id"))
        points = work.written(rows.withColumn("place", place).where(F.col("place") <= max(positives, negatives) + 1).drop("place"), "points")
        size = points.agg(F.count("*").alias("n"), F.max(norm2("q")).alias("m2"), F.max(F.size("q")).alias("wide")).first()
        if not size.n:
            return spark.createDataFrame([], schema)
        exact = size.m2 < EXACT
        space = learn(points, size.n, size.m2)
        index, cells = stored(points, space, size.n, size.wide, work)
        anchors = rows.where(F.col("id") % every == 0).select(F.col("id").alias("query"), "label", "q")
        window = lambda lo, hi: [lo.alias("lo"), hi.alias("hi"), lo.alias("need"), F.lit(-1.0).alias("radius")]
        all_scores = window(F.array(F.lit(-ANY).cast("long")), F.array(F.lit(ANY).cast("long")))
        pos = nearest(index, anchors.select("*", *all_scores), space, cells, positives, True, exact, work)
        # The window's bounds as whole numbers; a negative positive score has none.
        wide = F.col("score").cast("decimal(20,0)")
        pos = pos.where(F.col("score") >= 0).select("query", (F.col("nth") - 1).cast("long").alias("slot"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), F.ceil(wide * low / 100).cast("long").alias("lo"), F.floor(wide * high / 100).cast("long").alias("hi"))
        pos = work.written(pos, "positives")
        slots = pos.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("slot", "lo", "hi"))).alias("s"))
        state = anchors.join(slots, "query").select("query", "label", "q", *window(F.col("s.lo"), F.col("s.hi")))
        neg = nearest(index, state, space, cells, negatives, False, exact, work)
        out = neg.select("query", "slot", "nth", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")).join(pos, ["query", "slot"])
        return cut(out.select(F.col("query").alias("anchor_id"), "positive_id", F.col("nth").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
