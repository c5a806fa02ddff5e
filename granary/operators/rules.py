"""Checks as data: a table of named rules, and the rows that break them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def breaches(df: DataFrame, keys: Sequence[str], rules: Sequence[tuple[str, Column, str]], gate: Sequence[tuple[str, Column, str]] = ()) -> DataFrame:
    """keys, field, message for every rule (field, condition that is wrong, message) that a row breaks.
    Rules run only on rows that break none of the ``gate``; breaches of the gate are rows too. All
    rules are read in one pass."""
    listed = lambda rs: F.array_compact(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(f).alias("field"), F.lit(m).alias("message"))) for f, c, m in rs]))
    if not gate:
        return df.select(*keys, F.inline(listed(rules)))
    found = df.withColumn("_g", listed(gate)).withColumn("_r", F.when(F.size("_g") > 0, F.col("_g")).otherwise(listed(rules)))
    return found.select(*keys, F.inline("_r"))
