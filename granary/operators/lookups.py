"""Look-ups in dimensions: by key, as of an offset, by range, and what is missing."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


#: Rows up to which a dimension is broadcast, and ranges up to which they are written into the plan.
SMALL, RANGES = 100_000, 2_000
#: Numbers of a gap that one row stands for until they are listed.
STRETCH = 100_000


def sized(dim: DataFrame, most: int = SMALL) -> DataFrame:
    """The dimension, to be broadcast if a count finds it small."""
    return F.broadcast(dim) if dim.limit(most + 1).count() <= most else dim


def enrich(df: DataFrame, dim: DataFrame, on: str | Sequence[str], most: int = SMALL) -> DataFrame:
    """A left look-up; the dimension is broadcast if it has at most ``most`` rows."""
    return df.join(sized(dim, most), on, "left")


def guarded(df: DataFrame, path: str, listed: DataFrame, name: str) -> DataFrame:
    """Requests with ``open``, whether the manifest lists what they ask for, and the refusal if not."""
    there = listed.select(F.col(name).alias(path), F.lit(True).alias("_there")).distinct()
    out = enrich(df, there, path).withColumn("open", F.coalesce("_there", F.lit(False)))
    return out.drop("_there").withColumn("refusal", F.when(~F.col("open"), "is not an open file of the manifest"))


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_at: str, right_at: str, take: Sequence[str], strict: bool = False, long: int | None = None) -> DataFrame:
    """The left rows with the columns ``take`` of the last right row at or before them (before them,
    if ``strict``); nulls where there is none.

    Both sides go through one shuffle by ``by`` and one sort, and the last right row is carried on,
    so no pair of rows is formed. The right columns are carried as one struct, so a null inside a
    right row is kept as it is. Keys of more than ``long`` rows are scanned in stretches (``longkeys``), in
    many tasks; without it each key is one task's."""
    rank = 1 if not strict else -1  # where left rows stand among right rows of equal offset
    columns = left.columns
    a = left.select(*[F.col(c) for c in columns], F.col(left_at).alias("_at"), F.lit(rank).alias("_side"), F.lit(None).cast(right.select(F.struct(*take).alias("s")).schema["s"].dataType).alias("_right"))
    b = right.select(*[F.col(c) if c in by else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in columns], F.col(right_at).alias("_at"), F.lit(0).alias("_side"), F.struct(*take).alias("_right"))
    both = a.unionByName(b)
    if long is not None:
        both = _stretches(both, by, "_at", long).last("_right", ["_at", "_side"], "_right").table
    else:
        w = Window.partitionBy(*by).orderBy("_at", "_side").rowsBetween(Window.unboundedPreceding, 0)
        both = both.withColumn("_right", F.last("_right", ignorenulls=True).over(w))
    return both.where("_side <> 0").select(*columns, *[F.col(f"_right.{t}").alias(t) for t in take])


def _stretches(df: DataFrame, by: Sequence[str], at: str, long: int):
    from granary.operators.longkeys import Stretches

    return Stretches(df, by, at, long)


def first_range(df: DataFrame, value: str, ranges: DataFrame, label: str = "label") -> DataFrame:
    """The label of the first range (columns start, end, ord, label) that holds the value, both ends
    included; null where none does. Ranges are looked up in the plan itself, without a join; where there
    are very many, each stands in the bins that it covers and rows meet those of their bin."""
    listed = ranges.orderBy("ord").limit(RANGES + 1).collect()
    if len(listed) <= RANGES:
        if not listed:
            return df.withColumn(label, F.lit(None).cast(ranges.schema[label].dataType))
        known = F.array(*[F.struct(F.lit(r["start"]).alias("start"), F.lit(r["end"]).alias("end"), F.lit(r[label]).alias("label")) for r in listed])
        return df.withColumn(label, F.get(F.filter(known, lambda r: (F.col(value) >= r["start"]) & (F.col(value) <= r["end"])), F.lit(0))["label"])
    lo, hi = ranges.agg(F.min("start"), F.max("end")).first()
    width = max((hi - lo) / 4096, 1e-9)
    bin_of = lambda c: F.floor((c - F.lit(lo)) / F.lit(width))
    held = ranges.select("start", "end", "ord", F.col(label).alias("_label"), F.explode(F.sequence(bin_of(F.col("start")), bin_of(F.col("end")))).alias("_bin"))
    rows = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_bin", bin_of(F.col(value)))
    hit = (rows["_bin"] == held["_bin"]) & (F.col(value) >= F.col("start")) & (F.col(value) <= F.col("end"))
    first = rows.join(held, hit).groupBy("_row").agg(F.min_by("_label", "ord").alias(label))
    return rows.drop("_bin").join(first, "_row", "left").drop("_row")


def previous_plus_one(df: DataFrame, by: Sequence[str], at: str, number: str, most: int, long: int | None = None) -> DataFrame:
    """Rows without a number get the last number before them, plus one, if that is at most ``most``.
    Only numbers that stand in the data count, not those filled in. ``long`` as in ``as_of``."""
    if long is not None:
        df = _stretches(df, by, at, long).last(number, [at], "_known", inclusive=False).table
        known = F.col("_known")
    else:
        known = F.last(number, ignorenulls=True).over(Window.partitionBy(*by).orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("_inferred", F.col(number).isNull()).withColumn(number, F.coalesce(number, F.when(known + 1 <= most, known + 1))).withColumnRenamed("_inferred", "inferred").drop("_known")


def missing(df: DataFrame, other: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(other, on, "left_anti")


def sequence_gaps(df: DataFrame, by: Sequence[str], number: str) -> DataFrame:
    """by, number: what lies between the smallest and the largest number of a group and is not there.
    Each number knows the next, and a gap is listed in stretches, so no row holds a long one."""
    there = df.where(F.col(number).isNotNull()).select(*by, number).distinct()
    nxt = there.withColumn("_next", F.lead(number).over(Window.partitionBy(*by).orderBy(number))).where(F.col("_next") - F.col(number) > 1)
    stretches = nxt.select(*by, F.explode(F.sequence((F.col(number) + 1).cast("long"), (F.col("_next") - 1).cast("long"), F.lit(STRETCH).cast("long"))).alias("_lo"), "_next")
    listed = stretches.select(*by, F.explode(F.sequence("_lo", F.least(F.col("_lo") + F.lit(STRETCH - 1), F.col("_next").cast("long") - 1))).alias(number))
    return listed.withColumn(number, F.col(number).cast(df.schema[number].dataType))


def present_gaps(df: DataFrame, by: Sequence[str], number: str, first: int, last: int) -> DataFrame:
    """The same against a fixed range."""
    groups = df.select(*by).distinct().select(*by, F.explode(F.sequence(F.lit(first), F.lit(last))).alias(number))
    return groups.withColumn(number, F.col(number).cast(df.schema[number].dataType)).join(df.select(*by, number), [*by, number], "left_anti")


def segments(df: DataFrame, by: Sequence[str], at: str, end: Column | None = None, long: int | None = None) -> DataFrame:
    """Each row's end: where the next begins; ``end`` for the last. ``long`` as in ``as_of``."""
    if long is not None:
        out = _stretches(df, by, at, long).neighbour(at, [at], "segment_end", after=True).table
        return out.withColumn("segment_end", F.coalesce("segment_end", end)) if end is not None else out
    nxt = F.lead(at).over(Window.partitionBy(*by).orderBy(at))
    return df.withColumn("segment_end", F.coalesce(nxt, end) if end is not None else nxt)


def gap_clusters(df: DataFrame, by: Sequence[str], at: Column, order: str, gap: float, long: int | None = None) -> DataFrame:
    """A running number that grows where a row lies more than ``gap`` after the one before. ``long`` as in
    ``as_of``."""
    if long is not None:
        rows = _stretches(df.withColumn("_place", at), by, order, long).neighbour("_place", [order], "_before")
        new = F.when(F.col("_place") - F.col("_before") > gap, 1).otherwise(0)
        return rows.adding("_new", new).running_sum("_new", [order], "cluster").table.drop("_place", "_before", "_new")
    w = Window.partitionBy(*by).orderBy(order)
    new = F.when(at - F.lag(at).over(w) > gap, 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("cluster", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def last_title(df: DataFrame, key: str, at: str, title: str) -> DataFrame:
    """key, title: of several headings with one number the last counts, of several at one place the largest title."""
    return df.groupBy(key).agg(F.max_by(title, F.struct(at, title)).alias(title))


def keyed_copy(manifest: DataFrame, names: DataFrame, files: DataFrame) -> DataFrame:
    """manifest (id, file) against the name map (file, source) and the files that are there (source):
    copied, missing_mapping or missing_source."""
    return (
        manifest.join(sized(names), "file", "left")
        .join(files.select("source", F.lit(True).alias("_there")), "source", "left")
        .withColumn("status", F.when(F.col("source").isNull(), "missing_mapping").when(F.col("_there"), "copied").otherwise("missing_source"))
        .drop("_there")
    )


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "n", long: int | None = None) -> DataFrame:
    """A running number of the rows of each group in order. ``long`` as in ``as_of``; the order then begins with a
    column, ascending."""
    if long is not None:
        return _stretches(df, by, order[0], long).running_sum(None, order, name).table
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def as_number(text: str) -> Column:
    """The number that a text is, for sorting; 0 if it is none."""
    return F.coalesce(F.expr(f"try_cast(`{text}` as int)"), F.lit(0))
