"""Profiles and roll-ups: statistics, coverage, markup counts, comparisons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import TAMIL, block_text, count_literal, preview, script_count, script_density, strip

HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
TEXT_TAGS = ("ul", "ol", "p", "strong", "em", "br")


def statistics(df: DataFrame, by: str, size: Column, extra: Sequence[Column] = ()) -> DataFrame:
    """Entries and size of each group, and of all (a null group, ``is_total`` 1)."""
    return df.rollup(by).agg(F.count("*").alias("entries"), F.sum(size).cast("long").alias("size"), *extra, F.grouping(by).cast("int").alias("is_total"))


def group_counts(df: DataFrame, by: str, unknown: str = "Unknown") -> DataFrame:
    """Counts of a value, nulls under a name, most frequent first."""
    return df.groupBy(F.coalesce(by, F.lit(unknown)).alias(by)).agg(F.count("*").alias("n")).orderBy(F.desc("n"), by)


def coverage(df: DataFrame, fields: Sequence[str], empty_counts: bool = False) -> DataFrame:
    """One row: how many rows have each field."""
    kinds = dict(df.dtypes)
    has = lambda f: F.col(f).isNotNull() & ((F.col(f) != "") if kinds[f] == "string" and not empty_counts else F.lit(True))
    return df.agg(F.count("*").alias("total"), *[F.count_if(has(f)).alias(f"with_{f}") for f in fields])


def tag_count(html: Column, tag: str) -> Column:
    return F.regexp_count(html, F.lit(rf"(?i)<{tag}\b")).cast("long")


def tag_samples(html: Column, tag: str, most: int = 5, chars: int = 100) -> Column:
    """Texts of the first tags; empty ones among these are left out."""
    inner = F.slice(F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}\b[^>]*>(.*?)(?:</{tag}\s*>|$)"), F.lit(1)), 1, most)
    texts = F.transform(inner, lambda x: strip(F.regexp_replace(block_text(x), r"(?U)\s+", " ")))
    return F.transform(F.filter(texts, lambda t: t != ""), lambda t: preview(t, chars))


def numbered_headings(html: Column) -> Column:
    """Texts of h1 to h3 that begin with a number and a separator."""
    inner = F.regexp_extract_all(html, F.lit(r"(?is)<h[1-3]\b[^>]*>(.*?)</h[1-3]\s*>"), F.lit(1))
    return F.filter(F.transform(inner, lambda x: strip(block_text(x))), lambda t: t.rlike(r"^\d+[.)\-\s]"))


def html_profile(df: DataFrame, html: str, keep: Sequence[str], markers: Sequence[str] = ("திணை", "துறை"), keywords: Sequence[str] = ("padal", "pathigam", "thiruppatikam"), script: str = TAMIL, samples: bool = True) -> DataFrame:
    """Counts of tags, markers and separators of each page, as flat columns."""
    h = F.col(html)
    t = block_text(h)
    lists = F.regexp_extract_all(h, F.lit(r"(?is)<ul\b[^>]*>(.*?)</ul>"), F.lit(1))
    numbers = F.regexp_extract_all(t, F.lit(r"\(\d+\)"), F.lit(0))
    cols = [tag_count(h, x).alias(f"n_{x}") for x in (*HEADINGS, *TEXT_TAGS)]
    cols += [
        F.length(t).cast("long").alias("n_chars"), script_count(t, script).cast("long").alias("n_script"), script_density(t, script).alias("script_pct"),
        F.size(numbers).cast("long").alias("n_numbers"), F.slice(F.array_sort(F.array_distinct(numbers)), 1, 10).alias("number_samples"),
        F.regexp_count(t, F.lit(r"\([Nn]\)")).cast("long").alias("n_end_markers"),
        F.size(F.filter(lists, lambda x: x.rlike(r"\([Nn]\)"))).cast("long").alias("n_lists_with_marker"),
        F.size(numbered_headings(h)).cast("long").alias("n_numbered_headings"),
        F.transform(F.array_distinct(numbered_headings(h)), lambda x: F.substring(x, 1, 80)).alias("numbered_headings"),
        tag_count(h, "hr").alias("n_hr"), F.regexp_count(h, F.lit(r"<br\s*/?>\s*<br")).cast("long").alias("n_br_br"),
        count_literal(t, "—").alias("n_dashes"), count_literal(t, "***").alias("n_asterisks"),
        *[count_literal(t, m).alias(f"marker_{i}") for i, m in enumerate(markers)], *[count_literal(F.lower(t), k).alias(f"keyword_{k}") for k in keywords],
    ]
    if samples:
        cols += [tag_samples(h, x).alias(f"samples_{x}") for x in (*HEADINGS[:3], "p", "ul")]
    return df.select(*keep, *cols)


def compare(profiles: DataFrame, measures: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """measure, counts, avg (one place), min, max over pages or groups of them; rows with fewer than
    two pages have an ``error``."""
    long = profiles.select(*by, F.expr(f"stack({len(measures)}, " + ", ".join(f"'{m}', cast({m} as double)" for m in measures) + ") as (measure, value)"))
    return long.groupBy(*by, "measure").agg(
        F.count("*").alias("pages"), F.round(F.avg("value"), 1).alias("avg"), F.min("value").alias("min"), F.max("value").alias("max")
    ).withColumn("error", F.when(F.col("pages") < 2, "Need at least 2 analyses to compare"))


def stage_summary(results: DataFrame, stage: str = "stage", ok: str = "success") -> DataFrame:
    return results.groupBy(stage).agg(F.count("*").alias("total"), F.count_if(F.col(ok)).alias("succeeded"), F.count_if(~F.coalesce(F.col(ok), F.lit(False))).alias("failed"))


def lexical_anchoring(output: Column, definitions: Column) -> Column:
    """Token F1 of an output against dictionary words, 0 to 100."""
    tp = F.size(F.array_intersect(output, definitions))
    return F.when((F.size(output) == 0) | (F.size(definitions) == 0), F.lit(0.0)).otherwise(200.0 * tp / (F.size(F.array_distinct(output)) + F.size(F.array_distinct(definitions))))


def provider_rollup(log: DataFrame) -> DataFrame:
    """Latency and cost of each provider, endpoint and status."""
    return log.groupBy("provider", "endpoint", "status").agg(
        F.count("*").alias("n"), F.avg("latency_ms").alias("avg_latency_ms"), F.max("latency_ms").alias("max_latency_ms"), F.percentile_approx("latency_ms", 0.95).alias("p95_latency_ms"), F.sum("cost_estimate_usd").alias("cost_usd")
    )
