"""Command lines: ``python -m granary validate|match|export|statistics|annotate|fetch ...``."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="granary", description="Build, check, enrich and publish text corpora.")
    commands = p.add_subparsers(dest="command", required=True)
    for name, told in (("validate", "check the entries of a folder of JSON files"), ("match", "fill entries from a parallel text"), ("export", "write a Markdown document for each text"), ("statistics", "entries and size of each text"), ("annotate", "ask a service for null fields"), ("fetch", "fetch what a manifest lists")):
        c = commands.add_parser(name, help=told)
        c.add_argument("corpus", help="folder of JSON lines of filename and url" if name == "fetch" else "folder of JSON files")
        if name == "match":
            c.add_argument("--reference", required=True, help="JSON lines of idx, classic, description")
            c.add_argument("--threshold", type=float, default=0.8)
        if name == "annotate":
            c.add_argument("--client", required=True, help="module:function that answers a prompt")
            c.add_argument("--limit", type=int)
            c.add_argument("--delay", type=float, default=1.0, help="seconds between batches")
            c.add_argument("--overwrite", action="store_true", help="ask again where nothing is null")
        if name == "fetch":
            c.add_argument("--fetcher", required=True, help="module:function that gives the bytes of a url")
            c.add_argument("--gap", type=float, default=2.0, help="seconds between requests to a host")
        if name in ("match", "export", "annotate", "fetch"):
            c.add_argument("--out", required=True)
            c.add_argument("--dry-run", action="store_true")
    return p


def entries(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    from granary.sources import corpus

    rows, bad = corpus.entries_of(corpus.corpus_files(spark, folder))
    return rows, bad


def named(where: str) -> Callable:
    module, _, name = where.partition(":")
    return getattr(importlib.import_module(module), name)


def fetched(spark: SparkSession, a: argparse.Namespace) -> int:
    """Fetches a manifest, a task for each host; the results go to ``out`` as Parquet. 1 if something failed."""
    from granary.sources import fetch, hub

    hub.register(spark)
    rows = spark.read.format("granary_fetch").options(path=a.corpus, fetcher=a.fetcher, gap=str(a.gap)).load()
    if a.dry_run:
        spark.read.schema("filename string, url string").json(a.corpus).show(50, truncate=False)
        return 0
    rows.write.mode("overwrite").parquet(a.out)
    kept = spark.read.parquet(a.out)
    fetch.status_counts(kept).show()
    return int(not kept.where("status = 'failed'").isEmpty())


def annotated(typed: DataFrame, a: argparse.Namespace) -> int:
    """Asks for null fields; annotated entries and failures go beside each other. 1 if there are failures."""
    from granary.operators import annotate, sinks
    from granary.operators.validate import null_fields

    if a.dry_run:
        some = typed.withColumn("_fields", null_fields(typed)).where(F.size("_fields") > 0)
        some.select(annotate.prompt(some, F.col("_fields")).alias("prompt")).show(a.limit or 20, truncate=False)
        return 0
    good, bad = annotate.annotate(typed, named(a.client), skip_annotated=not a.overwrite, limit=a.limit, delay=a.delay)
    sinks.write_split(good, bad, a.out)
    return int(not bad.isEmpty())


def run(spark: SparkSession, args: Sequence[str]) -> int:
    """The exit status: 0 if all is well, 1 if something does not pass."""
    from granary.operators import match, profile, sinks, validate
    from granary.sources import corpus

    a = parser().parse_args(list(args))
    if a.command == "fetch":
        return fetched(spark, a)
    rows, bad = entries(spark, a.corpus)
    typed = corpus.typed(rows)
    if a.command == "annotate":
        return annotated(typed, a)
    if a.command == "validate":
        validate.totals(rows).show(truncate=False)
        found = validate.errors(rows)
        found.show(50, truncate=False)
        return int(not (found.isEmpty() and bad.isEmpty()))
    if a.command == "statistics":
        profile.statistics(typed, "source_text", F.octet_length("classical_tamil")).show(truncate=False)
    elif a.command == "export":
        if not a.dry_run:
            sinks.export_texts(typed, a.out, "source_text", ["verse_id"])
    elif a.command == "match":
        reference = spark.read.schema("idx long, classic string, description string").json(a.reference)
        best = match.best_matches(typed, reference, "verse_id", "idx", "classical_tamil", "classic", least=min(a.threshold, match.REVIEW))
        match.report(typed, best, "verse_id").show()
        filled = match.fill(typed, best, reference, "verse_id", "idx", "modern_tamil", "description", auto=a.threshold)
        sinks.write_enriched(filled, a.out, a.dry_run)
    return 0


if __name__ == "__main__":
    sys.exit(run(SparkSession.builder.appName("granary").getOrCreate(), sys.argv[1:]))
