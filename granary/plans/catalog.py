"""The registered queries over the driver's tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import text as X
from granary.operators import annotate, contain, dedup, lookups, match, profile, project, rules, segment, sinks, validate
from granary.plans.registry import QUERIES, SQL, query, spread, table
from granary.sources import corpus, shared
from granary.streaming import ingest

__all__ = ["QUERIES", "SQL"]


@query("""
SELECT doc_id, lang, source, n_chars, quality, toxic, filled FROM (
  SELECT d.*, l.quality, l.toxic, CAST((l.quality IS NOT NULL) AS INT) + CAST((l.toxic IS NOT NULL) AS INT) AS filled,
         row_number() OVER (PARTITION BY d.text ORDER BY CAST((l.quality IS NOT NULL) AS INT) + CAST((l.toxic IS NOT NULL) AS INT) DESC, d.doc_id) AS rn
  FROM documents d LEFT JOIN labels l USING (doc_id)) WHERE rn = 1
""")
def dedup_argmax_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("text", dedup.digest("text")).join(table(spark, sf_dir, "labels"), "doc_id", "left")
    best = dedup.most_complete(docs, ["text"], ["quality", "toxic"], [F.col("doc_id")], empties=(), keep_keyless=True)
    return best.select("doc_id", "lang", "source", "n_chars", "quality", "toxic", "filled")


# Deduplication. --------------------------------------------------------------------------------


@query("""
SELECT doc_id, first_line, n_chars FROM (
  SELECT doc_id, n_chars, lower(trim(regexp_replace(replace(split_part(text, chr(10), 1), '\\n', ' '), '\\s+', ' ', 'g'))) AS first_line,
         row_number() OVER (PARTITION BY lower(trim(regexp_replace(replace(split_part(text, chr(10), 1), '\\n', ' '), '\\s+', ' ', 'g'))) ORDER BY n_chars DESC, doc_id) AS rn
  FROM documents) WHERE rn = 1
""")
def dedup_argmax_first_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "n_chars", X.first_line(F.col("text")).alias("first_line"))
    return dedup.pick(docs, ["first_line"], [F.desc("n_chars"), F.col("doc_id")])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedup_first_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    first = dedup.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in order])
    return first.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_LATEST = """
SELECT user_id, event_type, event_id, ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1
"""


@query(_LATEST)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = dedup.latest_per_key(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", [F.desc("event_id")])
    return last.select("user_id", "event_type", "event_id", "ts", "value")


@query(_LATEST)
def upsert_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keyed table after two batches of events, the second played twice."""
    e = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "ts", "value")
    early, late = e.where("event_type = 'view'"), e.where("event_type <> 'view'")
    keys, ties = ["user_id", "event_type"], [F.desc("event_id")]
    once = ingest.upserted(ingest.upserted(None, early, keys, "ts", ties), late, keys, "ts", ties)
    return ingest.upserted(once, late, keys, "ts", ties)


# Statistics. -----------------------------------------------------------------------------------


@query("""
SELECT source, count(*) AS entries, CAST(sum(n_chars) AS BIGINT) AS size, avg(n_chars) AS avg_chars, CAST(grouping(source) AS INT) AS is_total
FROM documents GROUP BY ROLLUP (source)
""")
def source_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.statistics(table(spark, sf_dir, "documents"), "source", F.col("n_chars"), [F.avg("n_chars").alias("avg_chars")])


@query("SELECT coalesce(lang, 'Unknown') AS lang, count(*) AS n FROM documents GROUP BY 1")
def group_count_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.group_counts(table(spark, sf_dir, "documents"), "lang")


@query("""
SELECT count(*) AS total, count(*) FILTER (quality IS NOT NULL) AS with_quality, count(*) FILTER (toxic IS NOT NULL) AS with_toxic, count(*) FILTER (lang IS NOT NULL AND lang <> '') AS with_lang
FROM documents LEFT JOIN labels USING (doc_id)
""")
def coverage_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.coverage(table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left"), ["quality", "toxic", "lang"])


@query("SELECT lang, count(DISTINCT source) AS sources, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY lang")
def distinct_and_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").groupBy("lang").agg(F.count_distinct("source").alias("sources"), F.sum("n_chars").alias("chars"))


@query("""
SELECT event_type AS stage, count(*) AS total, count(*) FILTER (value >= 50) AS succeeded, count(*) FILTER (NOT value >= 50) AS failed FROM events GROUP BY event_type
""")
def stage_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.stage_summary(table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"), (F.col("value") >= 50).alias("success")))


@query("""
SELECT event_type, count(*) AS n, avg(CAST(json_extract_string(props, '$.k') AS INT)) AS avg_k, max(CAST(json_extract_string(props, '$.k') AS INT)) AS max_k, count(DISTINCT user_id) AS users
FROM events GROUP BY event_type
""")
def telemetry_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.avg(k).alias("avg_k"), F.max(k).alias("max_k"), F.count_distinct("user_id").alias("users"))


@query("""
WITH m AS (SELECT lang, 'n_chars' AS measure, CAST(n_chars AS DOUBLE) AS v FROM documents UNION ALL SELECT lang, 'n_lines', CAST(len(string_split(text, chr(10))) AS DOUBLE) FROM documents)
SELECT lang, measure, count(*) AS pages, round(avg(v), 1) AS "avg", min(v) AS "min", max(v) AS "max", CASE WHEN count(*) < 2 THEN 'Need at least 2 analyses to compare' END AS error
FROM m GROUP BY lang, measure
""")
def compare_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("lang", "n_chars", F.size(F.split("text", "\n")).alias("n_lines"))
    return profile.compare(docs, ["n_chars", "n_lines"], ["lang"])


@query("""
SELECT CASE WHEN p >= 0.8 THEN 'matched' WHEN p >= 0.5 THEN 'review' ELSE 'unmatched' END AS bucket, count(*) AS n
FROM (SELECT o_totalprice / max(o_totalprice) OVER () AS p FROM orders) GROUP BY 1
""")
def three_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_totalprice")
    top = o.agg(F.max("o_totalprice").alias("top"))  # one row
    return o.join(F.broadcast(top)).groupBy(match.bucket(F.col("o_totalprice") / F.col("top")).alias("bucket")).agg(F.count("*").alias("n"))


# Look-ups. -------------------------------------------------------------------------------------

_RANGES = [(0, 0, 50000, "low"), (1, 40000, 150000, "middle"), (2, 150001, 300000, "high")]


@query("""
SELECT o_orderkey, o_totalprice, CASE WHEN o_totalprice BETWEEN 0 AND 50000 THEN 'low' WHEN o_totalprice BETWEEN 40000 AND 150000 THEN 'middle' WHEN o_totalprice BETWEEN 150001 AND 300000 THEN 'high' END AS label FROM orders
""")
def range_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranges = spark.createDataFrame(_RANGES, "ord int, start int, end int, label string")
    return lookups.first_range(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), "o_totalprice", ranges)


@query("""
WITH p AS (SELECT * FROM events WHERE event_type = 'purchase'), v AS (SELECT * FROM events WHERE event_type = 'view')
SELECT p.user_id, p.event_id, p.ts, v.event_id AS view_id, v.ts AS view_ts FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts
""")
def asof_last_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    views = e.where("event_type = 'view'").select("user_id", F.col("event_id").alias("view_id"), F.col("ts").alias("view_ts"))
    return lookups.as_of(e.where("event_type = 'purchase'").drop("event_type"), views, ["user_id"], "ts", "view_ts", ["view_id", "view_ts"])


@query("""
WITH e AS (SELECT user_id, event_id, ts FROM events)
SELECT a.user_id, a.event_id, a.ts, b.event_id AS before_id FROM e a ASOF LEFT JOIN e b ON a.user_id = b.user_id AND a.ts > b.ts
""")
def asof_strictly_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts")
    other = e.select("user_id", F.col("event_id").alias("before_id"), F.col("ts").alias("_ts"))
    return lookups.as_of(e, other, ["user_id"], "ts", "_ts", ["before_id"], strict=True)


@query("SELECT user_id, event_id, ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS segment_end FROM events")
def lead_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.segments(table(spark, sf_dir, "events").select("user_id", "event_id", "ts"), ["user_id"], "ts")


@query("""
SELECT user_id, event_id, CAST(sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS cluster FROM (
  SELECT user_id, event_id, ts, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 43200000000 THEN 1 ELSE 0 END AS new FROM events)
""")
def gap_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    e = e.select("user_id", "event_id", F.col("ts").cast("timestamp").alias("ts"))
    return lookups.gap_clusters(e, ["user_id"], F.unix_micros("ts"), "ts", 43_200_000_000).select("user_id", "event_id", "cluster")


@query("""
WITH s AS (SELECT l_orderkey, min(l_linenumber) AS lo, max(l_linenumber) AS hi FROM lineitem GROUP BY l_orderkey),
g AS (SELECT l_orderkey, CAST(unnest(range(lo, hi + 1)) AS INT) AS l_linenumber FROM s)
SELECT g.l_orderkey, g.l_linenumber FROM g ANTI JOIN lineitem l ON g.l_orderkey = l.l_orderkey AND g.l_linenumber = l.l_linenumber
""")
def sequence_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.sequence_gaps(table(spark, sf_dir, "lineitem"), ["l_orderkey"], "l_linenumber")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def orders_without_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return lookups.missing(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey")


@query("SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def anti_join_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookups.missing(table(spark, sf_dir, "documents").select("doc_id", "lang"), table(spark, sf_dir, "labels"), "doc_id")


@query("""
WITH n AS (SELECT user_id, event_id, ts, CASE WHEN event_type = 'purchase' THEN CAST(event_id % 31 AS INT) END AS number FROM events),
k AS (SELECT *, last_value(number IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM n)
SELECT user_id, event_id, coalesce(number, CASE WHEN prev + 1 <= 30 THEN prev + 1 END) AS number, number IS NULL AS inferred FROM k
""")
def previous_plus_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.when(F.col("event_type") == "purchase", (F.col("event_id") % 31).cast("int")).alias("number"))
    return lookups.previous_plus_one(e, ["user_id"], "ts", "number", 30).select("user_id", "event_id", "number", "inferred")


@query("""
SELECT c.c_custkey AS id, n.n_name AS source, CASE WHEN n.n_name IS NULL THEN 'missing_mapping' WHEN s.s_nationkey IS NOT NULL THEN 'copied' ELSE 'missing_source' END AS status
FROM customer c LEFT JOIN (SELECT * FROM nation WHERE n_regionkey <> 0) n ON c.c_nationkey = n.n_nationkey
LEFT JOIN (SELECT DISTINCT s_nationkey FROM supplier WHERE s_acctbal > 9000) s ON n.n_nationkey = s.s_nationkey
""")
def manifest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("file"))
    nation = table(spark, sf_dir, "nation").where("n_regionkey <> 0").select(F.col("n_nationkey").alias("file"), F.col("n_name").alias("source"))
    there = table(spark, sf_dir, "supplier").where("s_acctbal > 9000").select(F.col("s_nationkey").alias("file")).distinct().join(nation, "file").select("source")
    return lookups.keyed_copy(manifest, nation, there).select("id", "source", "status")


@query("SELECT l_orderkey, max_by(l_shipdate, l_linenumber * 1000000 + l_partkey) AS title FROM (SELECT DISTINCT l_orderkey, l_shipdate, l_linenumber, l_partkey FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_partkey ORDER BY l_shipdate) = 1) GROUP BY l_orderkey")
def last_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.first_per_key(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber", "l_partkey"], [F.col("l_shipdate")])
    rows = rows.select("l_orderkey", (F.col("l_linenumber") * F.lit(1000000) + F.col("l_partkey")).alias("at"), F.col("l_shipdate").alias("title"))
    return lookups.last_title(rows, "l_orderkey", "at", "title")


# Order and sets. -------------------------------------------------------------------------------


@query("""
SELECT conv_id, turn, role, n, 'CONV-' || CASE WHEN length(CAST(n AS VARCHAR)) < 3 THEN lpad(CAST(n AS VARCHAR), 3, '0') ELSE CAST(n AS VARCHAR) END AS id
FROM (SELECT conv_id, turn, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS INT) AS n FROM conversations)
""")
def running_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql.window import Window

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("n"))
    return rows.withColumn("id", X.padded_id("CONV", F.col("n"), 3))


@query("SELECT conv_id, turn, CAST(floor((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1) / 3) AS BIGINT) AS batch FROM conversations")
def batch_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate.batches(table(spark, sf_dir, "conversations").select("conv_id", "turn"), [F.col("turn")], 3, ["conv_id"])


@query("""
SELECT n_name, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY CAST(n_nationkey AS VARCHAR)) AS INT) AS as_text, CAST(row_number() OVER (PARTITION BY n_regionkey ORDER BY n_nationkey) AS INT) AS as_number FROM nation
""")
def two_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in order as text and as numbers."""
    n = table(spark, sf_dir, "nation").withColumn("key", F.col("n_nationkey").cast("string"))
    text = lookups.numbered(n, ["n_regionkey"], [F.col("key")], "as_text")
    return lookups.numbered(text, ["n_regionkey"], [lookups.as_number("key"), F.col("n_name")], "as_number").select("n_name", "as_text", "as_number")


@query("""
SELECT doc_id, quality, NULL::BIGINT AS n_chars FROM labels UNION ALL SELECT doc_id, NULL, n_chars FROM documents
""")
def union_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.union_parts([table(spark, sf_dir, "labels").select("doc_id", "quality"), table(spark, sf_dir, "documents").select("doc_id", "n_chars")])


@query("SELECT c_custkey, c_name FROM customer WHERE contains(lower(concat_ws(' ', c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment)), 'machin')")
def any_column_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.any_column_contains(table(spark, sf_dir, "customer"), "Machin").select("c_custkey", "c_name")


# Text. -----------------------------------------------------------------------------------------

_ACCENTS = "À-ÿ"


@query("""
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars, CAST(length(regexp_replace(text, '[^À-ÿ]', '', 'g')) AS BIGINT) AS script_chars,
       CASE WHEN length(text) > 0 THEN length(regexp_replace(text, '[^À-ÿ]', '', 'g')) / length(text) * 100 ELSE 0.0 END AS script_pct, regexp_matches(text, '[À-ÿ]') AS has_script,
       CAST(len(string_split(text, chr(10))) AS INT) AS n_lines, CASE WHEN length(text) > 100 THEN substr(text, 1, 100) || '...' ELSE text END AS preview
FROM documents
""")
def text_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(t).cast("long").alias("chars"), X.script_count(t, _ACCENTS).cast("long").alias("script_chars"), X.script_density(t, _ACCENTS).alias("script_pct"),
        X.has_script(t, _ACCENTS).alias("has_script"), F.size(F.split(t, "\n")).alias("n_lines"), X.preview(t).alias("preview"),
    )


@query("""
WITH n AS (SELECT doc_id, lower(trim(regexp_replace(replace(text, '\\n', ' '), '\\s+', ' ', 'g'))) AS t, lower(trim(regexp_replace(replace(split_part(text, chr(10), 1), '\\n', ' '), '\\s+', ' ', 'g'))) AS l FROM documents),
s AS (SELECT doc_id, md5(t) AS text_md5, list_filter(string_split(t, ' '), lambda w: w <> '') AS tok, list_distinct(list_filter(string_split(l, ' '), lambda w: w <> '')) AS ltok,
      CASE WHEN length(t) >= 3 THEN len(list_distinct(list_transform(range(1, CAST(length(t) - 1 AS BIGINT)), lambda i: substr(t, i, 3)))) ELSE 0 END AS grams FROM n)
SELECT doc_id, text_md5, CAST(len(tok) AS INT) AS tokens, CAST(len(list_distinct(tok)) AS INT) AS distinct_tokens, CAST(grams AS INT) AS trigrams, CAST(len(ltok) AS INT) AS line_tokens FROM s
""")
def token_ngram(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", X.normalize(F.col("text")).alias("t"), X.first_line(F.col("text")).alias("l"))
    return n.select(
        "doc_id", F.md5("t").alias("text_md5"), F.size(X.tokens(F.col("t"))).alias("tokens"), F.size(F.array_distinct(X.tokens(F.col("t")))).alias("distinct_tokens"),
        F.size(match.packed_trigrams(F.coalesce("t", F.lit("")))).alias("trigrams"), F.size(F.array_distinct(X.tokens(F.col("l")))).alias("line_tokens"),
    )


@query("""
WITH t AS (SELECT conv_id, turn, list_distinct(list_filter(string_split(lower(trim(regexp_replace(text, '\\s+', ' ', 'g'))), ' '), lambda w: w <> '')) AS w FROM conversations),
p AS (SELECT a.conv_id, a.turn, a.w AS x, b.w AS y FROM t a JOIN t b ON a.conv_id = b.conv_id AND b.turn = a.turn - 1)
SELECT conv_id, turn, CASE WHEN len(x) = 0 AND len(y) = 0 THEN 1.0 ELSE len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) END AS jaccard,
       CASE WHEN len(x) = 0 OR len(y) = 0 THEN 0.0 ELSE 200.0 * len(list_intersect(x, y)) / (len(x) + len(y)) END AS anchoring FROM p
""")
def turn_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much each turn shares with the one before, as sets of words."""
    t = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.array_distinct(X.tokens(X.normalize(F.col("text")))).alias("x"))
    before = t.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("x").alias("y"))
    return t.join(before, ["conv_id", "turn"]).select("conv_id", "turn", X.jaccard(F.col("x"), F.col("y")).alias("jaccard"), profile.lexical_anchoring(F.col("x"), F.col("y")).alias("anchoring"))


@query("""
SELECT c_custkey, regexp_replace(regexp_replace(lower(c_mktsegment || ' ' || c_name), '\\s+', '_', 'g'), '[^a-z_]', '', 'g') AS slug, least(greatest(c_custkey, 60), 3600) AS clamped,
       c_custkey * CAST(0.2 AS DOUBLE) / 1e6 + c_nationkey * CAST(0.8 AS DOUBLE) / 1e6 AS cost, round(c_custkey * 1000 / 1048576, 2) AS mb, replace(c_name, '|', '\\|') AS escaped
FROM customer
""")
def scalar_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", X.slug(F.concat_ws(" ", "c_mktsegment", "c_name")).alias("slug"), X.clamp(F.col("c_custkey"), 60, 3600).alias("clamped"), X.cost(F.col("c_custkey"), F.col("c_nationkey")).alias("cost"),
        X.megabytes(F.col("c_custkey") * 1000).alias("mb"), X.markdown_value(F.col("c_name"), "string").alias("escaped"),
    )


@query("""
SELECT p_partkey, CASE WHEN contains(p_name, 'green') THEN 'G' WHEN contains(p_name, 'a') THEN 'A' WHEN contains(p_name, 'e') THEN 'E' END AS hit, nullif(concat_ws('; ', 'Brand: ' || nullif(p_brand, ''), 'Type: ' || nullif(p_type, '')), '') AS context
FROM part
""")
def ordered_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        "p_partkey", X.first_hit(F.col("p_name"), [("green", "G"), ("a", "A"), ("e", "E")]).alias("hit"), X.labelled([("Brand: ", F.col("p_brand")), ("Type: ", F.col("p_type"))]).alias("context")
    )


# Pages. ----------------------------------------------------------------------------------------


@query("""
WITH t AS (SELECT page_id, html, replace(regexp_replace(regexp_replace(html, '<br\\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g'), '&nbsp;', ' ') AS txt FROM pages)
SELECT page_id, len(regexp_extract_all(html, '(?i)<h1\\b')) AS n_h1, len(regexp_extract_all(html, '(?i)<p\\b')) AS n_p, len(regexp_extract_all(html, '(?i)<br\\b')) AS n_br, len(regexp_extract_all(html, '(?i)<ul\\b')) AS n_ul,
       CAST(length(txt) AS BIGINT) AS n_chars, len(regexp_extract_all(txt, '\\(\\d+\\)')) AS n_numbers, len(regexp_extract_all(html, '(?i)<hr\\b')) AS n_hr,
       CAST((length(txt) - length(replace(txt, '***', ''))) / 3 AS BIGINT) AS n_asterisks FROM t
""")
def html_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile.html_profile(table(spark, sf_dir, "pages"), "html", ["page_id"], samples=False)
    return p.select("page_id", "n_h1", "n_p", "n_br", "n_ul", "n_chars", "n_numbers", "n_hr", "n_asterisks")


@query("""
WITH s AS (SELECT page_id, regexp_extract_all(html, '(?s)<p>(.*?)</p>', 1) AS l FROM pages), r AS (SELECT page_id, unnest(l) AS raw, unnest(range(len(l))) AS pos FROM s)
SELECT page_id, CAST(pos AS INT) AS pos, regexp_replace(regexp_replace(replace(regexp_replace(regexp_replace(raw, '<br\\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g'), '&nbsp;', ' '), '^\\s+', ''), '\\s+$', '') AS text FROM r
""")
def html_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.tagged_segments(table(spark, sf_dir, "pages"), "html", ["page_id"], "p")


@query("""
SELECT page_id, replace(regexp_replace(regexp_replace(html, '<br\\s*/?>', chr(10), 'gi'), '<[^>]+>', '', 'g'), '&nbsp;', ' ') AS text FROM pages
""")
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", X.block_text(F.col("html")).alias("text"))


@query("""
WITH s AS (SELECT page_id, regexp_extract_all(html, '(?s)<h1[^>]*>(.*?)</h1>', 1) AS l FROM pages), r AS (SELECT page_id, l[1] AS t FROM s WHERE len(l) > 0)
SELECT page_id, 'PAGE-' || lpad(CAST(page_id AS VARCHAR), 8, '0') AS id, t AS title FROM r
""")
def page_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "pages").select("page_id", F.get(F.regexp_extract_all("html", F.lit(r"(?s)<h1[^>]*>(.*?)</h1>"), F.lit(1)), F.lit(0)).alias("title")).where("title is not null")
    return rows.select("page_id", X.padded_id("PAGE", F.col("page_id"), 8).alias("id"), "title")


# Checks, matching, merging. --------------------------------------------------------------------


@query("""
WITH d AS (SELECT * FROM documents LEFT JOIN labels USING (doc_id))
SELECT doc_id, 'lang' AS field, 'is not one of the allowed values' AS message FROM d WHERE lang NOT IN ('en', 'de', 'es')
UNION ALL SELECT doc_id, 'text', 'is too short' FROM d WHERE length(text) < 20
UNION ALL SELECT doc_id, 'quality', 'a labelled document should be good' FROM d WHERE lang IN ('en', 'de', 'es') AND length(text) >= 20 AND quality = 0
UNION ALL SELECT doc_id, 'toxic', 'only bad documents should be toxic' FROM d WHERE lang IN ('en', 'de', 'es') AND length(text) >= 20 AND toxic = 1 AND quality = 1
UNION ALL SELECT doc_id, 'source', 'does not begin with the prefix' FROM d WHERE lang IN ('en', 'de', 'es') AND length(text) >= 20 AND NOT starts_with(source, 'src1')
""")
def validate_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    gate = [("lang", ~F.col("lang").isin("en", "de", "es"), "is not one of the allowed values"), ("text", F.length("text") < 20, "is too short")]
    checks = [
        ("quality", F.col("quality") == 0, "a labelled document should be good"),
        ("toxic", (F.col("toxic") == 1) & (F.col("quality") == 1), "only bad documents should be toxic"),
        ("source", ~F.col("source").startswith("src1"), "does not begin with the prefix"),
    ]
    return rules.breaches(d, ["doc_id"], checks, gate)


@query("SELECT doc_id, item_id FROM documents d JOIN benchmark b ON contains(d.text, b.text)")
def containment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contain.contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), "doc_id", "item_id", "text")


@query("""
SELECT d.doc_id, CASE WHEN l.doc_id IS NOT NULL THEN CAST(l.quality AS VARCHAR) ELSE d.lang END AS lang, CASE WHEN l.doc_id IS NOT NULL AND l.toxic = 1 THEN NULL ELSE d.source END AS source
FROM documents d LEFT JOIN labels l USING (doc_id)
""")
def merge_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A patch replaces fields, also by null, where it names them."""
    d, p = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    named = F.when(F.col("toxic") == 1, F.to_json(F.struct(F.col("quality").cast("string").alias("lang"), F.lit(None).cast("string").alias("source")), {"ignoreNullFields": "false"})).otherwise(F.to_json(F.struct(F.col("quality").cast("string").alias("lang"))))
    j = d.select("doc_id", "lang", "source").join(p.select("doc_id", F.try_parse_json(named).alias("patch")), "doc_id", "left")
    return annotate.merged(j, "patch", fields=("lang", "source")).drop("patch")


@query("""
SELECT n_nationkey, '### ' || n_name || chr(10) || chr(10) || '**Source Text:** ' || r_name || chr(10) || chr(10) || '_Provenance_' || chr(10) || chr(10) || '- **Annotator:** ' || replace(r_name, '|', '\\|') || chr(10) AS markdown
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def render_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    e = n.select("n_nationkey", F.col("n_name").alias("verse_id"), F.col("r_name").alias("source_text"), F.col("r_name").alias("annotator"))
    return e.select("n_nationkey", sinks.markdown_entry(e).alias("markdown"))


@query("""
SELECT 'PURN-' || CASE WHEN length(CAST(doc_id AS VARCHAR)) < 3 THEN lpad(CAST(doc_id AS VARCHAR), 3, '0') ELSE CAST(doc_id AS VARCHAR) END AS verse_id, 'Purananuru' AS source_text, 'Sangam' AS layer, CAST(doc_id AS VARCHAR) AS verse_number,
       text AS classical_tamil, 'Puram' AS akam_or_puram, 'bard' AS speaker_role, 'Source: ' || source AS cultural_context FROM documents
""")
def project_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    e = project.to_entries(d, "Purananuru", "doc_id", {"classical_tamil": F.col("text")}, [("Source: ", F.col("source"))])
    return e.select("verse_id", "source_text", "layer", "verse_number", "classical_tamil", "akam_or_puram", "speaker_role", "cultural_context")


@query("""
SELECT 'documents' AS file, count(*) AS entries, count(*) FILTER (length(text) > 0 AND doc_id < 10000) AS passed,
       CAST(sum(CASE WHEN length(text) = 0 THEN 1 ELSE 0 END + CASE WHEN doc_id >= 10000 THEN 1 ELSE 0 END) AS BIGINT) AS errors, CAST(0 AS BIGINT) AS duplicate_ids FROM documents
""")
def validate_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as entries, checked as JSON against the schema and the rules between fields."""
    d = table(spark, sf_dir, "documents")
    e = project.to_entries(d, "Purananuru", "doc_id", {"classical_tamil": F.col("text")})
    rows = e.select(F.lit("documents").alias("file"), F.col("verse_id").alias("label"), F.to_json(F.struct(*e.columns)).alias("json"))
    return validate.totals(rows)


@query("""
SELECT event_id, '{"k":' || json_extract_string(props, '$.k') || '}' AS parsed, '{"k":"' || json_extract_string(props, '$.k') || '"}' AS extra FROM events
""")
def json_in_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON out of a fenced answer, and what a log row keeps under other keys."""
    answer = F.concat(F.lit("Here it is:\n```json\n"), F.col("props"), F.lit("\n```\ndone"))
    m = F.from_json("props", "map<string,string>")
    return table(spark, sf_dir, "events").select("event_id", F.to_json(X.json_in_text(answer)).alias("parsed"), X.extras(m, ["event_id"]).alias("extra"))


@query("""
WITH l AS (SELECT doc_id, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: length(x) >= 5 AND NOT regexp_full_match(x, '[=#\\-\\s]+')) AS x FROM documents),
s AS (SELECT doc_id, text, list_transform(x[1:5], lambda y: CASE WHEN length(y) > 500 THEN trim(substr(y, 1, 280)) || '…' ELSE y END) AS d FROM l)
SELECT doc_id, CASE WHEN len(d) > 0 THEN array_to_string(d, ' / ') ELSE trim(substr(trim(text), 1, 280)) END AS definitions FROM s
""")
def definition_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(X.definition_lines(F.col("text")), " / ").alias("definitions"))


@query("""SELECT n_nationkey, '{"n_nationkey":' || n_nationkey || ',"n_name":"' || n_name || '"}' AS json FROM nation""")
def json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select("n_nationkey", F.to_json(F.struct("n_nationkey", "n_name")).alias("json"))


@query("""
WITH n AS (SELECT s_nationkey, list_sort(list(s_name))[1:3] AS names FROM supplier GROUP BY s_nationkey)
SELECT c_custkey, coalesce(array_to_string(names, ' / '), '') AS definitions FROM customer LEFT JOIN n ON c_nationkey = s_nationkey
""")
def dictionary_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Up to three definitions of each word: here a nation's key, and its suppliers."""
    from pyspark.sql.window import Window

    s = table(spark, sf_dir, "supplier").withColumn("n", F.row_number().over(Window.partitionBy("s_nationkey").orderBy("s_name"))).where("n <= 3")
    dim = s.groupBy(F.col("s_nationkey").cast("string").alias("form")).agg(F.array_sort(F.collect_list("s_name")).alias("definitions"))
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("w"))
    got = annotate.with_definitions(c, F.array("w"), dim, "c_custkey")
    return got.select("c_custkey", F.coalesce(F.array_join(F.col("definitions")[F.col("w")], " / "), F.lit("")).alias("definitions"))


@query(_LATEST)
def stream_upserts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as a stream into a keyed table, and its last version."""
    path = shared.fresh(spark, "stream")
    schema = table(spark, sf_dir, "events").schema
    stream = spark.readStream.schema(schema).parquet(f"{sf_dir}/events.parque[t]").select("user_id", "event_type", "event_id", "ts", "value")
    held = ingest.KeyedTable(spark, f"{path}/table", ["user_id", "event_type"], "ts", ["event_id"])
    ingest.stream_upserts(stream, held, f"{path}/checkpoint").awaitTermination()
    return held.read()


# The other modules register their queries too.
from granary.plans import advanced, checks, editions, publish  # noqa: E402, F401
