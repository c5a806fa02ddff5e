"""Connected components of a graph that fits no single machine: large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.llm.util import cut


def connected(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, root for every node that has an edge; the root is the smallest node reachable.

    In each round every node links its larger neighbours (large star), then its smaller ones
    (small star), to the smallest it knows. Links are never gathered by node; only minima are.
    Each round is cut with a reliable checkpoint, and rounds end when the links stay the same."""
    e = cut(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct())
    held = _state(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = _state(e)
        if now == held:
            break
        held = now
    leaves = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return leaves.unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _state(e: DataFrame) -> tuple:
    r = e.select(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return (r.n, r.h)
