"""Reading corpora: JSON files of entries, whole pages, parallel texts, keyed sheets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators.dedup import latest_per_key
from granary.operators.schema import ENTRY

#: Columns of an annotation sheet that hold JSON where their text looks like it.
JSON_COLUMNS = ("karu", "rasa_secondary", "themes", "visual_imagery", "emotional_valence")


def pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """file, name, html of whole files; globs are allowed."""
    return spark.read.text(path if isinstance(path, str) else list(path), wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("value").alias("html"))


def expanded(spark: SparkSession, patterns: Sequence[str]) -> list[str]:
    """The paths that each pattern matches, in order; the pattern itself where nothing does."""
    out: list[str] = []
    for p in patterns:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
        out += sorted(str(f.getPath()) for f in found) if found else [p]
    return out


def documents(spark: SparkSession, patterns: Sequence[str]) -> DataFrame:
    """name, html, error of whole files; a file that is not there is a row with an error."""
    paths = expanded(spark, patterns)
    there = {p: spark._jvm.org.apache.hadoop.fs.Path(p) for p in paths}
    there = {p: path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path) for p, path in there.items()}
    gone = spark.createDataFrame([(p.rsplit("/", 1)[-1], None, "no such file") for p in paths if not there[p]], "name string, html string, error string")
    read = [p for p in paths if there[p]]
    return pages(spark, read).select("name", "html", F.lit(None).cast("string").alias("error")).unionByName(gone) if read else gone


def corpus_files(spark: SparkSession, path: str) -> DataFrame:
    """The JSON files of a folder, less the statistics file and names that begin with ``_``."""
    files = spark.read.option("pathGlobFilter", "*.json").text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("content"))
    return files.where(~F.col("file").startswith("_") & (F.col("file") != "corpus_statistics.json"))


def entries_of(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(file, pos, label, json) of every entry, and (file, message) of files that hold none: an array
    gives its items, an object itself, anything else and what does not parse an error."""
    v = files.withColumn("v", F.try_parse_json("content"))
    kind = F.schema_of_variant("v")
    v = v.withColumn("items", F.when(kind.startswith("ARRAY"), F.try_variant_get("v", "$", "array<variant>")).when(kind.startswith("OBJECT"), F.array("v")))
    bad = v.where(F.col("items").isNull()).select("file", F.when(F.col("v").isNull(), "does not parse as JSON").otherwise("is neither an array nor an object").alias("message"))
    rows = v.where(F.col("items").isNotNull()).select("file", F.posexplode("items").alias("pos", "_v")).select("file", "pos", F.to_json("_v").alias("json"))
    label = F.coalesce(F.get_json_object("json", "$.verse_id"), F.concat(F.lit("entry "), F.col("pos").cast("string")))
    return rows.withColumn("label", label), bad


def typed(entries: DataFrame) -> DataFrame:
    """Entries with typed columns; what does not fit its type is null (see ``validate`` for why)."""
    return entries.withColumn("_e", F.from_json("json", ENTRY)).select(*[c for c in entries.columns if c != "json"], "_e.*")


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """All parts by column name; missing columns are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def any_column_contains(df: DataFrame, text: str) -> DataFrame:
    """Rows in which some value contains the text, whatever its case."""
    return df.where(F.contains(F.lower(F.to_json(F.struct(*df.columns))), F.lit(text.lower())))


def keyed_sheet(rows: DataFrame, key: str, position: str, json_columns: Sequence[str] = JSON_COLUMNS) -> DataFrame:
    """One row a key, the last of equal ones; blanks are null; JSON columns are variants (``name_json``)
    where their text begins as JSON does and parses, and stay text beside."""
    kinds = dict(rows.dtypes)
    out = latest_per_key(rows.where(F.coalesce(F.col(key), F.lit("")) != ""), [key], position)
    out = out.select(*[F.nullif(F.col(c), F.lit("")).alias(c) if kinds[c] == "string" else F.col(c) for c in out.columns])
    for c in json_columns:
        if c in kinds:
            out = out.withColumn(f"{c}_json", F.when(F.ltrim(F.col(c)).rlike(r"^[{\[]"), F.try_parse_json(F.col(c))))
    return out


def dictionary(words: DataFrame, table: DataFrame, form: str = "form") -> DataFrame:
    """Each word with its entries; words that are not there have an empty array."""
    got = table.groupBy(form).agg(F.array_sort(F.collect_list(F.struct("lemma", "definitions", "source"))).alias("entries"))  # one word's entries
    return words.join(got, form, "left").withColumn("entries", F.coalesce("entries", F.array().cast(got.schema["entries"].dataType)))


def size_of(json: Column) -> Column:
    return F.octet_length(json)
