"""One row per key: most complete, first, or last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def is_filled(df: DataFrame, name: str, empties: Sequence[str] = ("string", "array", "map")) -> Column:
    """Whether a field holds something. ``empties`` names the kinds of value whose empty form counts
    as nothing, besides null."""
    kind, c = dict(df.dtypes)[name], F.col(name)
    if kind == "string" and "string" in empties:
        return c.isNotNull() & (c != "")
    if kind.startswith(("array", "map")) and kind.split("<")[0] in empties:
        return c.isNotNull() & (F.size(c) > 0)
    return c.isNotNull()


def filled_count(df: DataFrame, fields: Sequence[str], empties: Sequence[str] = ("string", "array", "map")) -> Column:
    out = F.lit(0)
    for f in fields:
        out = out + is_filled(df, f, empties).cast("int")
    return out


def pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column], keep_keyless: bool = False) -> DataFrame:
    """The first row of each key in ``order``. Rows with a null key are all kept or all dropped.

    A rank of 1 lets Spark drop rows before the shuffle, so a hot key sends one row from each task."""
    keyed = df
    for k in keys:
        keyed = keyed.where(F.col(k).isNotNull())
    out = keyed.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_rn = 1").drop("_rn")
    if not keep_keyless:
        return out
    missing = F.lit(False)
    for k in keys:
        missing = missing | F.col(k).isNull()
    return out.unionByName(df.where(missing))


def most_complete(df: DataFrame, keys: Sequence[str], fields: Sequence[str], ties: Sequence[Column], empties: Sequence[str] = ("string", "array", "map"), keep_keyless: bool = True) -> DataFrame:
    """The row of each key with the most filled fields (column ``filled``); ties by ``ties``."""
    return pick(df.withColumn("filled", filled_count(df, fields, empties)), keys, [F.desc("filled"), *ties], keep_keyless)


def digest(key: str) -> Column:
    """256 bits in place of a long key, so that texts are neither shuffled nor sorted; null stays null."""
    return F.unhex(F.sha2(F.col(key), 256))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return pick(df, keys, order)


def latest_per_key(df: DataFrame, keys: Sequence[str], at: str, ties: Sequence[Column] = ()) -> DataFrame:
    """Last write wins."""
    return pick(df, keys, [F.desc(at), *ties])


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
