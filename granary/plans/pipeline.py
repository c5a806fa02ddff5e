"""Building a corpus: extract, validate, match, annotate, statistics, as one lazy graph of DataFrames.

A text is described by an entry of a registry. Nothing runs until a sink is written; what has to be
known to decide (is the output there, did a part fail) is a row of the results, not an exception, so
good parts of a text are kept and the text is marked failed if any part failed."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import dedup, match, profile, project, schema, sinks, validate
from granary.sources import corpus

STAGES = ("extract", "validate", "integrate", "annotate", "statistics")
STATUS = "stage string, text string, success boolean, message string"


@dataclass
class Text:
    """A text: how to read each of its parts into entries."""

    name: str
    parts: dict[str, Callable[[SparkSession], DataFrame]] = field(default_factory=dict)
    description: str = ""


@dataclass
class Run:
    entries: DataFrame | None = None
    errors: DataFrame | None = None
    best: DataFrame | None = None
    failures: DataFrame | None = None
    statistics: DataFrame | None = None
    results: list[tuple[str, str, bool, str]] = field(default_factory=list)

    def ok(self) -> bool:
        return all(r[2] for r in self.results)


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def selected(stages: Sequence[str] | None, annotate: bool) -> list[str]:
    """The stages to run; annotation only if it is asked for."""
    return [s for s in (stages or STAGES) if s != "annotate" or annotate or (stages and "annotate" in stages)]


def extract(spark: SparkSession, texts: Sequence[Text], out: str | None, run: Run, dry: bool = False) -> None:
    """All parts of all texts in one table, the most complete entry of each id, first part first on
    ties. A text whose output is there is read back and not extracted."""
    made = []
    for text in texts:
        if out and exists(spark, f"{out}/{text.name}"):
            made.append(spark.read.schema(schema.ENTRY).json(f"{out}/{text.name}"))
            run.results.append(("extract", text.name, True, "skipped: output exists"))
            continue
        if dry:
            run.results.append(("extract", text.name, True, "dry run: " + ", ".join(text.parts)))
            continue
        good, bad = [], []
        for k, (part, read) in enumerate(text.parts.items()):
            try:
                good.append(read(spark).withColumn("_part", F.lit(k)))
            except Exception as e:  # a part that cannot be planned (no such file) fails alone
                bad.append(f"{part}: {type(e).__name__}")
        run.results.append(("extract", text.name, not bad and bool(good), "; ".join(bad)))
        if good:
            rows = project.completed(corpus.union_parts(good))
            best = dedup.most_complete(rows, ["verse_id"], schema.NAMES, [F.col("_part"), F.col("verse_number"), F.xxhash64("classical_tamil")])
            made.append(best.drop("_part", "filled"))
            if out:
                sinks.write_entries(made[-1], f"{out}/{text.name}", None)
    run.entries = corpus.union_parts(made) if made else None


def check(run: Run) -> None:
    """Errors as rows; a text with errors makes the run fail."""
    rows = run.entries.select(F.col("source_text").alias("file"), F.coalesce("verse_id", F.lit("?")).alias("label"), F.to_json(F.struct(*schema.NAMES)).alias("json"))
    run.errors = validate.errors(rows)
    for r in validate.totals(rows).collect():  # one row for each text
        run.results.append(("validate", str(r.file), r.errors == 0, f"{r.passed} of {r.entries} passed"))


def integrate(run: Run, reference: DataFrame, licence: str | None = None) -> None:
    """Modern renderings from a parallel text; later stages see them."""
    run.best = match.best_matches(run.entries, reference, "verse_id", "idx", "classical_tamil", "classic")
    run.entries = match.fill(run.entries, run.best, reference, "verse_id", "idx", "modern_tamil", "description", licence=licence)
    run.results.append(("integrate", "all", True, ""))


def summarise(run: Run) -> None:
    run.statistics = profile.statistics(run.entries, "source_text", F.octet_length(F.to_json(F.struct(*[c for c in schema.NAMES]))))
    run.results.append(("statistics", "all", True, ""))


def build(spark: SparkSession, texts: Sequence[Text], reference: DataFrame | None = None, client: Callable[[str], str] | None = None, stages: Sequence[str] | None = None, out: str | None = None, dry: bool = False) -> Run:
    """Runs the chosen stages over the chosen texts."""
    run, chosen = Run(), selected(stages, client is not None)
    extract(spark, texts, out, run, dry)
    if dry or run.entries is None:
        return run
    if "validate" in chosen:
        check(run)
    if "integrate" in chosen and reference is not None:
        integrate(run, reference)
    if "annotate" in chosen and client is not None:
        from granary.operators.annotate import annotate

        run.entries, run.failures = annotate(run.entries, client)
        run.results.append(("annotate", "all", True, ""))
    if "statistics" in chosen:
        summarise(run)
    return run


def results(spark: SparkSession, run: Run) -> DataFrame:
    return spark.createDataFrame(run.results, STATUS)
