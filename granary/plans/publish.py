"""Queries over what is written and read again, over posts, and over whole runs of the build."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import profile, project, schema, sinks, validate
from granary.plans import checks, pipeline
from granary.plans.registry import query, table
from granary.sources import corpus, fetch, shared
from granary.streaming import ingest

_ID = "'KURU-' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')"


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as entries of one text."""
    n = table(spark, sf_dir, "nation")
    return project.to_entries(n, "Kuruntokai", "n_nationkey", {"classical_tamil": F.col("n_name"), "themes": F.array("n_name", F.lit("x"))})


def files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of JSON files: an array of entries for each region, one object, and files that hold none."""
    root = shared.fresh(spark, "files")
    rows = table(spark, sf_dir, "nation").withColumn("verse_id", F.format_string("KURU-%03d", "n_nationkey")).select("n_regionkey", "n_nationkey", "verse_id", "n_name")
    for r in sinks.json_array(rows, ["n_nationkey"], ["n_regionkey"]).collect():  # five regions
        shared.put(spark, f"{root}/r{r.n_regionkey}.json", r.json)
    for name, text in (("one.json", '{"n_nationkey": 99}'), ("number.json", "3"), ("broken.json", "[{"), ("_draft.json", "[]"), ("corpus_statistics.json", "{}"), ("notes.txt", "[]")):
        shared.put(spark, f"{root}/{name}", text)
    return root


@query(f"""
SELECT 'r' || n_regionkey || '.json' AS file, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) - 1 AS INT) AS pos, {_ID} AS label, n_name FROM nation
UNION ALL SELECT 'one.json', 0, 'entry 0', NULL
""")
def s1_s2_s13_s14_corpus_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = corpus.entries_of(corpus.corpus_files(spark, files(spark, sf_dir)))
    return rows.select("file", "pos", "label", F.get_json_object("json", "$.n_name").alias("n_name"))


@query("SELECT 'broken.json' AS file, 'does not parse as JSON' AS message UNION ALL SELECT 'number.json', 'is neither an array nor an object'")
def s1_file_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.entries_of(corpus.corpus_files(spark, files(spark, sf_dir)))[1]


@query(r"""
SELECT 'region' || r_regionkey || '.html' AS name, '<p>' || r_name || chr(10) || 'x</p>' AS html, NULL AS error FROM region UNION ALL SELECT 'none*.html', NULL, 'no such file'
""")
def s3_s9_s12_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole files by patterns; a pattern that matches nothing is taken as a name."""
    root = shared.fresh(spark, "pages")
    for r in table(spark, sf_dir, "region").collect():  # five rows
        shared.put(spark, f"{root}/region{r.r_regionkey}.html", f"<p>{r.r_name}\nx</p>")
    return corpus.documents(spark, [f"{root}/region*.html", f"{root}/none*.html"])


def served(url: str) -> bytes:
    """What stands behind the urls of the queries: by the nation's number."""
    k = int(url.rsplit("/", 1)[1])
    if k % 5 == 1:
        raise fetch.NotFound
    if k % 5 == 2:
        raise OSError("no connection")
    return (b"<html>" if k % 5 != 3 else b"plain") + b"x" * (2000 if k % 5 != 4 else 10)


_FETCHED = """
SELECT n_name AS filename, CASE WHEN n_nationkey < 5 THEN 'skipped' WHEN n_nationkey % 5 = 1 THEN 'not_found' WHEN n_nationkey % 5 = 2 THEN 'failed' ELSE 'success' END AS status,
       CASE WHEN n_nationkey >= 5 AND n_nationkey % 5 = 3 THEN 'not html' WHEN n_nationkey >= 5 AND n_nationkey % 5 = 4 THEN 'small' ELSE '' END AS warning FROM nation WHERE n_name LIKE 'NATION_1%' OR n_name LIKE 'NATION_2%'
"""


def _fetched(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_name").alias("filename"), F.concat(F.lit("x://h/"), "n_nationkey").alias("url"), "n_nationkey")
    listed = fetch.selected(n, fetch.aliased("some", {"some": ["NATION_1", "NATION_2"]}))
    return fetch.fetch_all(listed, n.where("n_nationkey < 5").select("filename"), served, gap=0, wait=0)


@query(_FETCHED)
def s5_s6_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fetched(spark, sf_dir).select("filename", "status", "warning")


@query(f"SELECT status, count(*) AS n FROM ({_FETCHED}) GROUP BY status")
def s7_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fetch.status_counts(_fetched(spark, sf_dir))


@query("""
SELECT CAST(c_nationkey AS VARCHAR) AS verse_id, c_custkey AS row, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS note, CASE WHEN c_custkey % 2 = 0 THEN '["a",' || c_custkey || ']' ELSE 'a, b' END AS themes,
       CASE WHEN c_custkey % 2 = 0 THEN '["a",' || c_custkey || ']' END AS parsed
FROM customer QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey DESC) = 1
""")
def s10_keyed_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr("cast(c_nationkey as string) AS verse_id", "c_custkey AS row", "if(c_custkey % 3 = 0, '', c_mktsegment) AS note", "if(c_custkey % 2 = 0, concat('[\"a\",', c_custkey, ']'), 'a, b') AS themes")
    sheet = corpus.keyed_sheet(rows, "verse_id", "row")
    return sheet.select("verse_id", "row", "note", "themes", F.to_json("themes_json").alias("parsed"))


@query("SELECT c_custkey, n_nationkey IS NOT NULL AS found, coalesce(n_name, '') AS lemma FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey")
def s11_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("form"))
    entries = table(spark, sf_dir, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").cast("string").alias("form"), F.col("n_name").alias("lemma"), F.array(F.lit("d")).alias("definitions"), F.lit("s").alias("source"))
    got = corpus.dictionary(words, entries)
    return got.select("c_custkey", (F.size("entries") > 0).alias("found"), F.coalesce(F.get("entries", F.lit(0))["lemma"], F.lit("")).alias("lemma"))




@query(f"""
SELECT 'all' AS file, CAST(p_partkey AS VARCHAR) AS label, field, message FROM part JOIN (VALUES {checks._FAULT_ROWS}) f(k, field, message) ON p_partkey % {len(checks._FAULTS)} = k
UNION ALL SELECT 'all', CAST(p_partkey AS VARCHAR), 'period', '''period'' is a required property' FROM part
""")
def s15_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries checked against a schema file, which asks for one field more."""
    fields = tuple(dataclasses.replace(f, required=True) if f.name == "period" else f for f in schema.FIELDS)
    path = shared.put(spark, shared.fresh(spark, "schema") + ".json", schema.document(dataclasses.replace(schema.RULES, fields=fields)))
    return validate.errors(checks.faulty(spark, sf_dir), rules=schema.read(spark, path))


# Sinks. ----------------------------------------------------------------------------------------

@query(f"SELECT {_ID} AS verse_id, 'Kuruntokai' AS source_text, n_name AS classical_tamil, n_name || ',x' AS themes, CAST(NULL AS VARCHAR) AS english FROM nation")
def k1_s13_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries written as JSON, a folder for each text, and read again with their types."""
    path = shared.fresh(spark, "entries")
    sinks.write_entries(nations(spark, sf_dir), path)
    return spark.read.schema(schema.ENTRY).json(path).select("verse_id", "source_text", "classical_tamil", F.array_join("themes", ",").alias("themes"), "english")


@query(f"SELECT {_ID} AS verse_id, n_name || '!' AS modern_tamil FROM nation")
def k3_enriched_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.fresh(spark, "copy") + ".json"
    e = nations(spark, sf_dir).withColumn("modern_tamil", F.concat("classical_tamil", F.lit("!")))
    if sinks.write_enriched(e, path, dry=True) is not None:
        raise AssertionError("a dry run writes nothing")
    return spark.read.schema(schema.ENTRY).json(sinks.write_enriched(e, path)).select("verse_id", "modern_tamil")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation")
def k4_csv_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.fresh(spark, "report")
    if not sinks.write_report(table(spark, sf_dir, "nation"), path):
        raise AssertionError("rows are written")
    return spark.read.option("header", True).csv(path)


@query("SELECT n_nationkey, n_regionkey = 0 AS failed FROM nation")
def k5_split_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared.fresh(spark, "split")
    sinks.write_split(*sinks.split(table(spark, sf_dir, "nation"), F.when(F.col("n_regionkey") != 0, True)), path)
    read = lambda part, failed: spark.read.schema("n_nationkey int").json(f"{path}_{part}").select("n_nationkey", F.lit(failed).alias("failed"))
    return read("annotated", False).unionByName(read("failed", True))


@query("""
SELECT '{"texts":{' || string_agg('"' || source || '":{"entries":' || n || ',"size":' || size || '}', ',' ORDER BY source) || '},"totals":{"entries":' || CAST(sum(n) AS BIGINT) || ',"size":' || CAST(sum(size) AS BIGINT) || '}}' AS json
FROM (SELECT source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS size FROM documents GROUP BY source)
""")
def k6_statistics_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.statistics_json(profile.statistics(table(spark, sf_dir, "documents"), "source", F.col("n_chars")), "source")


@query("""
SELECT '{"analyses":[' || string_agg('{"lang":"' || lang || '","n":' || n || '}', ',' ORDER BY lang) || '],"comparison":[{"measure":"n","pages":' || count(*) || ',"max":' || CAST(max(n) AS DOUBLE) || '}]}' AS json FROM (SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang)
""")
def k9_analysis_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile.group_counts(table(spark, sf_dir, "documents").where("lang is not null"), "lang")
    return sinks.analysis_json(p, profile.compare(p, ["n"]).select("measure", "pages", "max"), "lang")


@query("""
SELECT rpad(n_name, 24, ' ') || ' ' || lpad(CAST(n_nationkey AS VARCHAR), 10, ' ') || ' ' || lpad(CAST(n_regionkey AS VARCHAR), 10, ' ') AS line FROM nation
""")
def k12_console_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.console_rows(table(spark, sf_dir, "nation"), "n_name", ["n_nationkey", "n_regionkey"])


@query("""
SELECT r_name AS text, '# ' || r_name || chr(10) || chr(10) || '**Total entries:** ' || count(*) || chr(10) || chr(10) || 'Missing values are displayed as `—`.' || chr(10) || chr(10) || '---' || chr(10) || chr(10)
  || string_agg('### ' || n_name || chr(10) || chr(10) || '---', chr(10) || chr(10) ORDER BY n_nationkey) AS markdown
FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY r_name
""")
def k7_k13_export_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Markdown document for each text, written as files and read whole."""
    path = shared.fresh(spark, "export")
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    sinks.export_texts(n.select(F.concat("r_name", F.lit("_All")).alias("text_name"), "n_nationkey", F.col("n_name").alias("verse_id")), path, "text_name", ["n_nationkey"])
    read = spark.read.option("basePath", path).text(path, wholetext=True)
    return read.select("text", F.regexp_replace("value", "\n+$", "").alias("markdown"))


@query("""SELECT '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '","n_regionkey":' || n_regionkey || '}' AS json FROM nation""")
def k15_json_response(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.json_response(table(spark, sf_dir, "nation"))


# Posts. ----------------------------------------------------------------------------------------

def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as posts: annotations, log rows, and bodies that do not parse."""
    note = "concat('{\"text\":\"Sheet ', user_id % 3, '!\",\"annotation\":{\"verse_id\":\"V-', user_id, '\",\"english\":\"', event_type, '\",\"themes\":[\"a\",', event_id, '],\"karu\":null}}')"
    log = "concat('{\"action\":\"log\",\"provider\":\"', event_type, '\",\"latency_ms\":', event_id, ',\"other\":\"x', user_id, '\"}')"
    body = f"CASE WHEN event_type IN ('view', 'purchase') THEN {note} WHEN event_type = 'error' THEN '{{broken' ELSE {log} END"
    return table(spark, sf_dir, "events").selectExpr("event_id", "CAST(ts AS TIMESTAMP) AS at", f"{body} AS body")


@query("""
SELECT event_id, CASE WHEN event_type IN ('view', 'purchase', 'error') THEN 'annotation' ELSE 'log' END AS action, CASE WHEN event_type IN ('view', 'purchase') THEN 'sheet_' END AS sheet FROM events
""")
def r1_router(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.routed(posts(spark, sf_dir)).select("event_id", "action", "sheet")


_NOTES = """
SELECT 'V-' || user_id AS verse_id, event_type AS english, '["a",' || event_id || ']' AS themes, '' AS karu, '' AS annotator FROM events WHERE event_type IN ('view', 'purchase')
"""


@query(f"SELECT *, 'sheet_' AS sheet FROM ({_NOTES})")
def r1_annotation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ingest.annotation_rows(ingest.of_action(ingest.routed(posts(spark, sf_dir)), "annotation"))
    return rows.select("sheet", "verse_id", "english", "themes", "karu", "annotator")


_LOG = """
SELECT CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS provider, CASE WHEN event_type = 'error' THEN '' ELSE CAST(event_id AS VARCHAR) END AS latency_ms, '' AS endpoint,
       CASE WHEN event_type = 'error' THEN '' ELSE '{"action":"log","other":"x' || user_id || '"}' END AS extra_json FROM events WHERE event_type NOT IN ('view', 'purchase')
"""


@query(_LOG)
def k11_r3_k14_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log posts as a stream, appended to a table that is made when the first come."""
    source, out = shared.fresh(spark, "posts"), shared.fresh(spark, "log")
    posts(spark, sf_dir).where("body not like '%annotation%'").write.parquet(source)
    stream = spark.readStream.schema("event_id long, at timestamp, body string").parquet(source)
    ingest.stream_log(ingest.telemetry_rows(stream), out, f"{out}-checkpoint").awaitTermination()
    return spark.read.parquet(out).select("provider", "latency_ms", "endpoint", "extra_json")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS b, n_name AS a, CAST(NULL AS VARCHAR) AS c FROM nation")
def r4_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("x"), F.col("n_name").alias("a"), F.col("n_nationkey").cast("string").alias("b"))
    return ingest.repaired(n, ["b", "a", "c"])


@query("""
SELECT verse_id, english FROM (SELECT 'V-' || user_id AS verse_id, event_type AS english, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events WHERE event_type IN ('view', 'purchase')) WHERE rn = 1
""")
def s16_k10_latest_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations upserted in two batches, one of them twice, and what the read end point answers."""
    rows = ingest.annotation_rows(ingest.of_action(ingest.routed(posts(spark, sf_dir)), "annotation"))
    held = ingest.KeyedTable(spark, shared.fresh(spark, "notes"), ["sheet", "verse_id"], "at", ["themes"], buckets=4)
    early = F.col("english") == "view"
    for k, part in enumerate((rows.where(early), rows.where(~early), rows.where(~early))):
        held.merge(part, k)
    return ingest.state_rows(held, "Sheet 1!").select("verse_id", F.get_json_object("json", "$.english").alias("english"))


# Whole runs. -----------------------------------------------------------------------------------

def _broken(spark: SparkSession) -> DataFrame:
    return spark.read.parquet("/no/such/file.parquet")


def _build(spark: SparkSession, sf_dir: str, **kw) -> pipeline.Run:
    part = lambda where: lambda s: project.to_entries(table(s, sf_dir, "nation").where(where), "Kuruntokai", "n_nationkey", {"classical_tamil": F.col("n_name"), "thinai": F.lit("Palai")})
    texts = [pipeline.Text("Kuruntokai", {"a": part("n_regionkey < 2"), "b": part("n_regionkey < 4")}), pipeline.Text("Half", {"a": part("n_regionkey = 4"), "b": _broken})]
    return pipeline.build(spark, texts, **kw)


@query("""
SELECT 'extract' AS stage, 'Kuruntokai' AS text, true AS success, '' AS message UNION ALL SELECT 'extract', 'Half', false, 'b: AnalysisException' UNION ALL SELECT 'statistics', 'all', true, ''
UNION ALL SELECT 'validate', 'Kuruntokai', true, count(*) || ' of ' || count(*) || ' passed' FROM nation
""")
def x3_x5_x7_x12_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over two texts, one of which has a part that cannot be read: its good part is kept."""
    return pipeline.results(spark, _build(spark, sf_dir, stages=["validate", "statistics"]))


@query(f"SELECT {_ID} AS verse_id, n_name AS classical_tamil, 'Sangam' AS layer FROM nation")
def u1_x13_build_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _build(spark, sf_dir, stages=["statistics"]).entries.select("verse_id", "classical_tamil", "layer")


@query("SELECT 'extract' AS stage, 'Kuruntokai' AS text, true AS success, 'skipped: output exists' AS message UNION ALL SELECT 'extract', 'Half', true, 'dry run: a, b'")
def x6_x9_dry_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is there is skipped, also in a dry run, which writes nothing."""
    out = shared.fresh(spark, "out")
    sinks.write_entries(nations(spark, sf_dir), f"{out}/Kuruntokai", None)
    return pipeline.results(spark, _build(spark, sf_dir, out=out, dry=True))
