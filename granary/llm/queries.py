"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.llm import decontaminate, htmltext, langid, licenses, mih, negatives, packing, phrases, quality, sharding, simhash, toxicity, urlfilter
from granary.llm.util import table

#: The rules of the url query: host, path, verdict.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_mih(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mih.search(table(spark, sf_dir, "embeddings"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hexed("fp").alias("fingerprint"), "component_id")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), added=True)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("selected", F.col("tail") >= quality.CUTOFF)


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed, _ = sharding.shard(table(spark, sf_dir, "documents"), 24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_urlfilter(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), listed)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op10_htmltext(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(table(spark, sf_dir, "pages"))


def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return negatives.mine(e.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))))


def op12_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_mih, op2_simhash, op3_packing, op4_quality, op5_decontaminate, op6_shards, op7_urlfilter, op8_toxicity, op9_langid, op10_htmltext, op11_negatives, op12_licenses, op13_phrases)}

SQL = {
    "op7_urlfilter": r"""
WITH p AS (
  SELECT page_id,
         CASE WHEN contains(url, '://') THEN translate(regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*'),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
         CASE WHEN contains(url, '://') THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages),
r(rhost, rpath, rverdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
m AS (
  SELECT p.page_id, p.host, p.path, r.rhost || r.rpath AS rule, r.rverdict AS verdict,
         row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rhost || r.rpath) DESC NULLS LAST) AS n
  FROM p LEFT JOIN r ON (p.host = r.rhost OR suffix(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM m WHERE n = 1
""",
    "op5_decontaminate": r"""
WITH iw AS (SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM benchmark),
ig AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 4], ' ') AS gram FROM iw, unnest(range(1, len(w) - 3)) AS u(i)),
size AS (SELECT item_id, count(*) AS n FROM ig GROUP BY item_id),
dw AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda w: w <> '') AS w FROM documents),
dg AS (SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS gram FROM dw, unnest(range(1, len(w) - 3)) AS u(i)),
hits AS (SELECT doc_id, item_id, count(DISTINCT gram) AS shared FROM dg JOIN ig USING (gram) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, shared, n AS item_shingles, CAST(shared AS DOUBLE) / n AS containment
FROM hits JOIN size USING (item_id) WHERE shared >= 0.8 * n - 1e-9
""",
    "op11_negatives": r"""
WITH e AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor, b.id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM e AS a JOIN e AS b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (
  SELECT anchor, other, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other) <= 5)
SELECT p.anchor AS anchor_id, p.other AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other) AS INTEGER) AS rank,
       s.other AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
QUALIFY rank <= 10
""",
    "op13_phrases": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM w, unnest(range(1, 5)) AS a(k), unnest(range(1, len(w) - k + 2)) AS b(i)),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY lang, k, phrase),
n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND a >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, 2000000 * CAST(c.a AS HUGEINT) // (CAST(x.a AS HUGEINT) + y.a) AS score, j
  FROM c, unnest(range(1, c.k)) AS u(j)
  JOIN f AS x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f AS y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT c.lang, c.a, array_to_string(c.w[i:i + m - 1], ' ') AS phrase
  FROM c, unnest(range(2, c.k)) AS u(m), unnest(range(1, c.k - m + 2)) AS v(i)),
gone AS (
  SELECT DISTINCT c.lang, c.phrase FROM c JOIN inside AS o ON o.lang = c.lang AND o.phrase = c.phrase AND 100 * CAST(o.a AS HUGEINT) >= 80 * CAST(c.a AS HUGEINT))
SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, b.phrase) AS rank,
       b.phrase, b.a, b.l, b.r, n.n, CAST(b.score AS BIGINT) AS score
FROM best AS b JOIN n ON n.lang = b.lang ANTI JOIN gone ON gone.lang = b.lang AND gone.phrase = b.phrase
QUALIFY rank <= 2000
""",
}
