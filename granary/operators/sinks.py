"""Publishing: JSON, CSV, Markdown, statistics, splits and logs.

Rows are rendered where they are. Files that hold a whole text in order (``export_texts``, ``write_arrays``) are written
entry by entry out of a sorted partition; ``json_array`` and ``markdown_documents`` give a group as one value, for small ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.text import markdown_block, markdown_value, title_case
from granary.operators import schema as S


def write_entries(df: DataFrame, path: str, partition: str | None = "source_text") -> None:
    """JSON lines, one folder for each text; nulls are kept, since null says "not yet annotated"."""
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(partition) if partition else w).json(path)


def json_array(df: DataFrame, order: Sequence[Column | str], by: Sequence[str] = ()) -> DataFrame:
    """by, json: the rows of each group as one JSON array in order."""
    rows = df.select(*by, F.struct(*[F.col(o).alias(f"_{i}") if isinstance(o, str) else o.alias(f"_{i}") for i, o in enumerate(order)]).alias("_o"), F.struct(*df.columns).alias("_r"))
    packed = F.array_sort(F.collect_list(F.struct("_o", "_r")))
    return rows.groupBy(*by).agg(F.to_json(F.transform(packed, lambda x: x["_r"]), {"ignoreNullFields": "false"}).alias("json"))


def write_report(rows: DataFrame, path: str) -> bool:
    """CSV with a header; nothing is written, and False returned, if there are no rows."""
    if rows.isEmpty():
        return False
    rows.write.mode("overwrite").option("header", True).csv(path)
    return True


def split(df: DataFrame, ok: Column) -> tuple[DataFrame, DataFrame]:
    good = F.coalesce(ok, F.lit(False))
    return df.where(good), df.where(~good)


def write_split(good: DataFrame, bad: DataFrame, path: str) -> None:
    good.write.mode("overwrite").json(f"{path}_annotated")
    bad.write.mode("overwrite").json(f"{path}_failed")


def statistics_json(stats: DataFrame, by: str) -> DataFrame:
    """The roll-up of ``profile.statistics`` as one JSON text: texts by name, and totals."""
    body = F.struct("entries", "size")
    return stats.agg(
        F.to_json(F.struct(F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("is_total") == 0, F.struct(F.coalesce(by, F.lit("Unknown")), body))))).alias("texts"), F.max(F.when(F.col("is_total") == 1, body)).alias("totals"))).alias("json")
    )


def markdown_entry(df: DataFrame) -> Column:
    """One entry as a section: heading, summary, text blocks, and the other fields in groups. Columns
    that the table lacks are left out; null ones show a dash."""
    kinds = dict(df.dtypes)
    there = lambda f: f in kinds
    filled = lambda f: F.coalesce(F.col(f).cast("string"), F.lit("")) != ""
    summary = F.nullif(F.concat_ws(" | ", *[F.when(filled(f), F.concat(F.lit(f"**{title_case(f)}:** "), F.col(f))) for f in ("source_text", "layer", "period", "verse_number") if there(f)]), F.lit(""))
    parts: list[Column] = [F.concat(F.lit("### "), F.coalesce(F.col("verse_id"), F.lit("—")) if there("verse_id") else F.lit("—"), F.lit("\n")), F.when(summary.isNotNull(), F.concat(summary, F.lit("\n")))]
    for f, label in (("classical_tamil", "Classical Tamil"), ("modern_tamil", "Modern Tamil"), ("english", "English")):
        if there(f):
            parts.append(F.when(filled(f), F.concat(F.lit(f"**{label}**\n\n"), markdown_block(F.col(f)), F.lit("\n"))))
    shown = {"verse_id", "source_text", "layer", "period", "verse_number", "classical_tamil", "modern_tamil", "english"}
    for name, fields in S.GROUPS:
        lines = [F.concat(F.lit(f"- **{title_case(f)}:** "), markdown_value(F.col(f), kinds[f])) for f in fields if there(f) and f not in shown]
        if lines:
            parts.append(F.concat(F.lit(f"_{name}_\n\n"), F.concat_ws("\n", *lines), F.lit("\n")))
    return F.concat_ws("\n", *parts)


def markdown_documents(df: DataFrame, by: str, order: Sequence[str], blurb: str = "Missing values are displayed as `—`.") -> DataFrame:
    """by, markdown: one document for each group, its entries in order."""
    rows = df.select(by, F.struct(*order, markdown_entry(df).alias("_md")).alias("_s"))
    body = F.array_join(F.transform(F.array_sort(F.collect_list("_s")), lambda s: F.concat(s["_md"], F.lit("\n---\n"))), "\n")
    head = F.concat(F.lit("# "), F.coalesce(by, F.lit("—")), F.lit("\n\n**Total entries:** "), F.count("*").cast("string"), F.lit(f"\n\n{blurb}\n\n---\n\n"))
    return rows.groupBy(by).agg(F.concat(head, body).alias("markdown"))


def console_rows(profile: DataFrame, name: str, measures: Sequence[str]) -> DataFrame:
    """The aligned lines of a console table."""
    return profile.select(F.concat_ws(" ", F.rpad(F.col(name).cast("string"), 24, " "), *[F.lpad(F.col(m).cast("string"), 10, " ") for m in measures]).alias("line"))


def json_response(df: DataFrame) -> DataFrame:
    return df.select(F.to_json(F.struct(*df.columns)).alias("json"))


def write_enriched(df: DataFrame, path: str, dry: bool = False) -> str | None:
    """The table beside its source, under the source's name with ``_enriched``; nothing in a dry run."""
    if dry:
        return None
    stem = path[: -len(".json")] if path.endswith(".json") else path
    write_entries(df, f"{stem}_enriched", None)
    return f"{stem}_enriched"


def _write_pieces(pieces: DataFrame, path: str, by: str, order: Sequence[str]) -> None:
    """One file for each text, its pieces (columns ``by``, ``_kind``, ``order``, ``value``) in order, each ended by a line
    end. A text's task sorts (and spills) and writes piece by piece, so no text is ever held as a whole."""
    # By a key of its own: Spark 4.1 takes two sides of a union that are dealt by ``by`` for dealt alike, leaves this shuffle
    # out, and may then put them together differently, so a text's ends stood in another file.
    rows = pieces.withColumnRenamed(by, "text").repartition(F.xxhash64("text")).sortWithinPartitions("text", "_kind", *order).select("text", "value")
    rows.write.mode("overwrite").partitionBy("text").text(path, lineSep="\n")


def _ordered(df: DataFrame, order: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The table with copies of its order under names of their own."""
    names = [f"_order{k}" for k in range(len(order))]
    return df.withColumns({n: F.col(c) for n, c in zip(names, order)}), names


def export_texts(df: DataFrame, path: str, by: str, order: Sequence[str], blurb: str = "Missing values are displayed as `—`.") -> None:
    """A Markdown document for each text, in a folder named by the text less ``_All``; the same as ``markdown_documents``
    gives, written entry by entry."""
    named, names = _ordered(df.withColumn(by, F.regexp_replace(by, "_All$", "")), order)
    entries = named.select(by, F.lit(1).alias("_kind"), *names, F.concat(markdown_entry(df), F.lit("\n---\n")).alias("value"))
    head = F.concat(F.lit("# "), F.coalesce(by, F.lit("—")), F.lit("\n\n**Total entries:** "), F.count("*").cast("string"), F.lit(f"\n\n{blurb}\n\n---\n"))
    heads = named.groupBy(by).agg(head.alias("value")).withColumn("_kind", F.lit(0))
    _write_pieces(entries.unionByName(heads, allowMissingColumns=True), path, by, names)


def write_arrays(df: DataFrame, path: str, by: str, order: Sequence[str]) -> None:
    """A JSON array of the entries of each text, in order, an entry a line; nulls are kept."""
    rows, names = _ordered(df, order)
    first = F.row_number().over(Window.partitionBy(by).orderBy(*names)) == 1
    entry = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    entries = rows.select(by, F.lit(0).alias("_kind"), *names, F.concat(F.when(first, "[").otherwise(","), entry).alias("value"))
    ends = df.select(by).distinct().select(by, F.lit(1).alias("_kind"), F.lit("]").alias("value"))
    _write_pieces(entries.unionByName(ends, allowMissingColumns=True), path, by, names)


def analysis_json(profiles: DataFrame, comparison: DataFrame, name: str) -> DataFrame:
    """One JSON text of the profiles of some files and their comparison; both are small."""
    a = profiles.agg(F.array_sort(F.collect_list(F.struct(F.col(name).alias("_k"), F.struct(*profiles.columns).alias("v")))).alias("a"))
    c = comparison.agg(F.array_sort(F.collect_list(F.struct(*comparison.columns))).alias("c"))
    return a.join(F.broadcast(c)).select(F.to_json(F.struct(F.transform("a", lambda x: x["v"]).alias("analyses"), F.col("c").alias("comparison"))).alias("json"))
