"""Roll-ups from sketches that merge, so that a log is read once.

``partials`` turns rows into one row for each group of the finest kind (day and provider, say): counts, sums, extremes, a KLL
sketch of the values, from which any quantile can be asked later, and a theta sketch of the things to be counted once. Partials are
appended day by day. ``rolled_up`` merges them to any coarser groups; ``measured`` asks for figures. What was read is never
read again: a new day costs that day, a new question costs the partials.

Distinct counts are exact up to ``2 ** nominal`` things of a group, quantiles exact up to ``k`` rows; beyond that a KLL sketch of
k = 200 is within 1.33 % of rank with 99 % confidence (k = 800: 0.4 %), a theta sketch of 2^12 entries within 3.2 % (two
deviations). Both are bounded in size whatever they stand for.

Where figures have to be exact beyond that, ``sharpened`` reads the rows once more: a sketch says between which two values a quantile
lies, and only rows between them are ordered; things are counted one by one where a theta sketch has begun to estimate.

Defined results: null values count as rows but in no sketch; a group without values has null quantiles and extremes.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, NOMINAL = 200, 12


def partials(df: DataFrame, by: Sequence[Column | str], value: str, thing: str, k: int = K, nominal: int = NOMINAL) -> DataFrame:
    """by, n, n_values, total, least, most, values (KLL sketch), things (theta sketch)."""
    v = F.col(value).cast("double")
    return df.groupBy(*by).agg(
        F.count("*").alias("n"), F.count(v).alias("n_values"), F.coalesce(F.sum(v), F.lit(0.0)).alias("total"), F.min(v).alias("least"), F.max(v).alias("most"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("values"), F.theta_sketch_agg(F.col(thing), F.lit(nominal)).alias("things"),
    )


def rolled_up(parts: DataFrame, by: Sequence[Column | str], k: int = K, nominal: int = NOMINAL) -> DataFrame:
    """The same columns for coarser groups."""
    return parts.groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("n_values").alias("n_values"), F.sum("total").alias("total"), F.min("least").alias("least"), F.max("most").alias("most"),
        F.kll_merge_agg_double("values", F.lit(k)).alias("values"), F.theta_union_agg("things", F.lit(nominal)).alias("things"),
    )


def measured(parts: DataFrame, quantiles: Sequence[float] = (0.5, 0.95)) -> DataFrame:
    """Figures of partials: mean, distinct things, and ``p50``, ``p95`` ...: the least value that so many rows do not pass."""
    asked = [F.when(F.col("n_values") > 0, F.kll_sketch_get_quantile_double("values", F.lit(float(q)))).alias(_place(q)) for q in quantiles]
    return parts.withColumn("mean", F.col("total") / F.nullif("n_values", F.lit(0))).withColumn("distinct_things", F.theta_sketch_estimate("things")).select("*", *asked).drop("values", "things")


def _place(q: float) -> str:
    return f"p{100 * q:g}".replace(".", "_")


def _between(bounds: DataFrame, rows: DataFrame, by: Sequence[str], value: str) -> DataFrame:
    """by, q, found: the quantile of each group, if it lies from ``lo`` to ``hi`` of ``bounds`` (by, q, rank, lo, hi; null: open)."""
    v = F.col(value).cast("double")
    asked = rows.withColumn("_v", v).where("_v is not null").join(F.broadcast(bounds), list(by))
    below = asked.where("_v < lo").groupBy(*by, "q").agg(F.count("*").alias("_below"))
    counts = asked.where("(lo is null or _v >= lo) and (hi is null or _v <= hi)").groupBy(*by, "q", "rank", "_v").agg(F.count("*").alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy(*by, "q").orderBy("_v")) + F.coalesce("_below", F.lit(0))
    placed = counts.join(F.broadcast(below), [*by, "q"], "left").withColumn("_upto", upto)
    # The rank lies here if it is passed here and not before.
    return placed.where("_upto >= rank and rank > coalesce(_below, 0)").groupBy(*by, "q").agg(F.min("_v").alias("found"))


def sharpened(parts: DataFrame, rows: DataFrame, by: Sequence[str], value: str, thing: str, quantiles: Sequence[float] = (0.5, 0.95), slack: float = 0.002, nominal: int = NOMINAL) -> DataFrame:
    """What ``measured`` gives, exact for any number of rows. ``rows`` are those that ``parts`` (one row for each group) stand for;
    groups are few and have no null key. A quantile outside of its bounds is sought once more among all rows of its group."""
    kll = lambda q: F.kll_sketch_get_quantile_double("values", F.lit(q))
    one = lambda q: F.struct(
        F.lit(_place(q)).alias("q"), F.greatest(F.ceil(F.lit(Decimal(str(q))) * F.col("n_values")), F.lit(1)).cast("long").alias("rank"),
        (kll(q - slack) if q > slack else F.lit(None).cast("double")).alias("lo"), (kll(q + slack) if q + slack < 1 else F.lit(None).cast("double")).alias("hi"),
    )
    spark, figures = parts.sparkSession, measured(parts, quantiles).collect()  # one row for each group
    bounds = parts.where("n_values > 0").select(*by, F.inline(F.array(*[one(q) for q in quantiles])))
    bounds = spark.createDataFrame(bounds.collect(), bounds.schema)
    found = {tuple(r)[:-1]: r.found for r in _between(bounds, rows, by, value).collect()}
    missed = [r for r in bounds.collect() if tuple(r)[: len(by) + 1] not in found]
    if missed:
        every = spark.createDataFrame(missed, bounds.schema).withColumns({"lo": F.lit(None).cast("double"), "hi": F.lit(None).cast("double")})
        found |= {tuple(r)[:-1]: r.found for r in _between(every, rows, by, value).collect()}
    key = lambda r: tuple(r[b] for b in by)
    many = [key(r) for r in figures if r.distinct_things >= 2**nominal]
    counted = {}
    if many:
        asked = F.broadcast(spark.createDataFrame(many, rows.select(*by).schema))
        counted = {key(r): r.n for r in rows.join(asked, list(by)).where(F.col(thing).isNotNull()).select(*by, thing).distinct().groupBy(*by).agg(F.count("*").alias("n")).collect()}
    schema = measured(parts, quantiles).schema
    exact = lambda r: {"distinct_things": counted.get(key(r), r.distinct_things)} | {_place(q): found.get((*key(r), _place(q))) for q in quantiles}
    return spark.createDataFrame([tuple((r.asDict() | exact(r))[c] for c in schema.names) for r in figures], schema)


def appended(parts: DataFrame, path: str, day: str = "day") -> None:
    """Writes partials by day; a day that is written again takes the place of what it was."""
    parts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).parquet(path)
