"""Queries over pages that are made from the tables: every kind of edition, and header lines.

A page holds ten parts of ``part``, each marked up as the edition would; the SQL gives what has to come
out of it, from the table alone."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions import headers as H
from granary.functions import text as X
from granary.operators import profile, scan, segment
from granary.plans.registry import query, spread, table

#: A verse of a part, of 30 to 50 letters of the script; the same in both engines.
VERSE = "concat(p_name, ' ', trim(repeat('தமிழ் ', 6 + p_size % 5)))"
PAGE = "CAST(floor(p_partkey / 10) AS INT)"


def edition(spark: SparkSession, sf_dir: str, row: str, head: str = "''") -> DataFrame:
    """page, html: the rows of ten parts in order after a head (SQL of p_partkey, p_name, p_size, verse; of page)."""
    parts = table(spark, sf_dir, "part").selectExpr("*", f"{PAGE} AS page", f"{VERSE} AS verse").selectExpr("page", "p_partkey AS n", f"concat({row}) AS t")
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n", "t"))), lambda x: x["t"]), "")
    return parts.groupBy("page").agg(body.alias("body")).selectExpr("page", f"concat({head}, body) AS html")


@query(f"SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, 'பாலை' AS tinai, 'வாகை' AS turai, {VERSE} AS text FROM part WHERE p_size % 5 >= 2")
def g1_heading_longest_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = edition(spark, sf_dir, "'<h3>செய்யுள் ', p_partkey, '</h3>', p_partkey, '. பாலை[வாகை.]<ul>தமிழ்</ul><ul>', verse, ' 12</ul>'")
    return segment.heading_longest_list(pages, "html", ["page"])


_FALLBACK = f"""
SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, CASE WHEN p_partkey % 2 = 0 THEN 'பாலை' ELSE 'குறிஞ்சி' END AS tinai, 'துறை' AS turai, {VERSE} AS text FROM part WHERE p_partkey BETWEEN 100 AND 450
"""


@query(_FALLBACK)
def g2_g3_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bold numbers, and plain ones that were not found so; every fourth part stands in both forms."""
    bold, plain = "'<strong>', p_partkey, '. பாலை<br>[துறை.]<ul><strong>', verse, '</strong> 7</ul>'", "chr(10), p_partkey, '. {}<br>[துறை.]<br>', verse, ' 5<br>(உரை)<br>gloss<br>------<br>'"
    pages = edition(spark, sf_dir, f"if(p_partkey % 2 = 0, concat({bold}), ''), if(p_partkey % 4 <> 2, concat({plain}), '')".format("குறிஞ்சி"))
    found = segment.bold_number_list(pages, "html", ["page"]).drop("poet")
    return found.unionByName(scan.named_lines(pages, "html", ["page"], found).drop("pos"))


@query(f"""
SELECT {PAGE} AS page, '2.' || ({PAGE} + 1) AS section, 'Title' AS title, 'இந்தளம்' AS tune, CAST(p_partkey + 1 AS VARCHAR) AS number, CAST(p_partkey + 1470 AS INT) AS global_number, {VERSE} AS text FROM part WHERE p_partkey < 2000 AND {PAGE} < 250
""")
def g4_table_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = "'<tr><td valign=top>', p_partkey + 1, '. <td>', verse, ' 1.2.3<td valign=\"bottom\">2.3.1</tr>'"
    pages = edition(spark, sf_dir, row, "'<h3>3.1 other <</h3><h3><font color=blue>2.', page + 1, '. Title. </font></h3><b>பண் - இந்தளம்</b>'").withColumn("part", F.lit(2))
    return segment.table_rows(pages, "html", ["page"], "part", {1: 0, 2: 1469, 3: 2800})


@query(f"SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, 'Section ' || {PAGE} AS section, {VERSE} AS text FROM part WHERE p_partkey >= 1 AND p_partkey <= 4000 AND (p_partkey >= 100 OR p_partkey <= 473)")
def g5_number_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = edition(spark, sf_dir, "'<br>', p_partkey, ':<br>', verse, ' 12<br><hr>foot'", "'<h3>Section <b>', page, '</b></h3>'")
    pages = pages.withColumn("name", F.when(F.col("page") < 20, "raw/Divya_Prabandham_Mudhal_Ayiram_1.html").otherwise("raw/other.html"))
    return scan.number_lines(pages, "html", ["page"], "name").drop("pos")


@query(f"""
SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, CASE WHEN p_partkey <= 99 THEN 'Tantra 1' WHEN p_partkey BETWEEN 500 AND 999 THEN 'Other' ELSE '' END AS title, 'Sub ' || {PAGE} AS section, {VERSE} AS text FROM part
""")
def g6_dotted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = edition(spark, sf_dir, "chr(10), p_partkey, '.<br>', verse, ' ', p_partkey, '<br>'", "'<h3>முதல் (0-99)</h3><h3>Other (500 - 999)</h3><strong>1.. Sub ', page, '.</strong>'")
    return scan.dotted_lines(pages, "html", ["page"]).drop("pos")


@query(f"SELECT {PAGE} AS page, CAST(p_partkey % 10 + 1 AS VARCHAR) AS number, 'காதை ' || p_name AS title, {VERSE} || ' ' || {VERSE} AS text FROM part")
def g7_chapters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chapters under a heading or a plain line, after a list of contents that names them too."""
    head = "'<br>1. பாடல்<br>2. பாடல்<br>3. பாடல்<br>', repeat('-', 400)"
    title = "if(p_partkey % 2 = 0, concat('<h3>', p_partkey % 10 + 1, '. காதை ', p_name, '.</h3>'), concat('<br>', p_partkey % 10 + 1, '. காதை ', p_name, '<br>'))"
    return scan.chapters(edition(spark, sf_dir, f"{title}, '<ul>', verse, '</ul><ul>', verse, ' ', verse, ' 12</ul>'", head), "html", ["page"]).drop("pos")


@query(f"""
SELECT {PAGE} AS page, lpad(CAST(p_partkey % 10 + 1 AS VARCHAR), 2, '0') AS number, CASE WHEN p_partkey % 2 = 0 THEN 'Chapter ' ELSE 'காதை ' END || p_name AS title, {VERSE} AS text, lpad(CAST(p_size AS VARCHAR), 3, '0') AS line_end FROM part
UNION ALL SELECT DISTINCT {PAGE}, '00', 'பதிகம் (Prologue)', 'தமிழ் தமிழ் தமிழ் தமிழ் தமிழ் தமிழ்', '001' FROM part
""")
def g8_stanzas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second chapter has no number; it takes that of the one before, plus one."""
    k = "lpad(cast(p_partkey % 10 + 1 as string), 2, '0')"
    title = "if(p_partkey % 2 = 0, concat('<h3>', p_partkey % 10 + 1, '. Chapter ', p_name, '.</h3>'), concat('<h3>காதை ', p_name, '</h3>'))"
    cell = f"'<tr><td>', verse, ' ', {k}, '-', lpad(cast(p_size as string), 3, '0'), '<td valign=bottom>', {k}, '-', lpad(cast(p_size as string), 3, '0'), '</tr>'"
    pages = edition(spark, sf_dir, f"{title}, {cell}, '<tr><td>', verse, '<td valign=bottom>77-001</tr>'", "'<tr><td>', trim(repeat('தமிழ் ', 6)), '<td valign=bottom>00-001</tr>'")
    return scan.stanzas(pages, "html", ["page"]).drop("pos", "k")


@query(f"""
SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, 'Title ' || p_name AS title, {VERSE} AS text, 'திணை: பாலை; x' AS header_line, 'A prose introduction ' || p_partkey || '.' AS prose, 'gloss ' || p_partkey || ' more' AS commentary, 'why' AS explanation FROM part
""")
def g9_g13_marked_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    head = "'<center><h3>', p_partkey, '. Title ', p_name, '.</h3></center>A prose introduction ', p_partkey, '.<br>'"
    body = "'<ul>', verse, '     5 (', p_partkey, ')</ul>திணை: பாலை; x<br><strong>உரை</strong>gloss ', p_partkey, '<br>more<strong>விளக்கம்</strong>why<br>------<br>'"
    return scan.marked_lists(edition(spark, sf_dir, f"{head}, {body}"), "html", ["page"])


@query(f"""
SELECT {PAGE} AS page, CAST(p_partkey AS VARCHAR) AS number, 'Title ' || p_name AS title, {VERSE} AS text, 'திணை: பாலை' AS header_line, 'prose ' || p_partkey AS prose, 'gloss ' || p_partkey AS commentary, 'why' AS explanation FROM part
""")
def g10_bold_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = "'<strong>', p_partkey, '. Title ', p_name, '.</strong><br>prose ', p_partkey, '<br>------<br><ul>first</ul><ul>', verse, '</ul>திணை: பாலை<br>உரை: gloss ', p_partkey, '<br>விளக்கம் : why<br>-----<br>gone'"
    return scan.bold_numbers(edition(spark, sf_dir, row), "html", ["page"])


@query(f"""
SELECT {PAGE} AS page, CAST(p_partkey AS INT) AS number, 'கபிலர்' AS poet, 'Kurinji' AS tinai, 'talaivi' AS speaker_role, 'தலைவி சொன்னது' AS dramatic_context, {VERSE} AS classical_tamil, 'A song ' || p_partkey || '.' AS english, 'n' || p_partkey AS notes FROM part
""")
def g11_g12_bilingual(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = "'X ', p_partkey, ', கபிலர், குறிஞ்சித் திணை – தலைவி சொன்னது', chr(10), verse, '  5', chr(10), 'stray English line here', chr(10), 'Kurun ', p_partkey, ', Kapilar', chr(10), 'A song ', p_partkey, '.', chr(10), 'Notes: n', p_partkey, chr(10)"
    pages = edition(spark, sf_dir, row, "'see X 9, nowhere', repeat(' ', 260)")
    return segment.bilingual(segment.real_headers(pages, "html", ["page"], "X"), ["page"], ["Kurun", "Kuru"])


@query("SELECT p_partkey, CASE WHEN contains(p_name, 'ring') THEN 'first' WHEN contains(p_name, 'red') THEN 'second' ELSE 'other' END AS parser FROM part")
def g14_edition_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", segment.edition_of(F.col("p_name"), [("ring", "first"), ("red", "second")], "other").alias("parser"))


_AT = "CAST(coalesce(sum(length(r)) OVER (PARTITION BY page ORDER BY p_partkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT)"


@query(f"SELECT page, {_AT} AS at, 'Sub ' || p_name AS title FROM (SELECT *, {PAGE} AS page, '<strong>' || p_size || '.. Sub ' || p_name || '.</strong>text<br>' AS r FROM part)")
def g16_subsection_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.subsection_titles(edition(spark, sf_dir, "'<strong>', p_size, '.. Sub ', p_name, '.</strong>text<br>'"), "html", ["page"])


@query(f"SELECT page, {_AT} AS at, 'Head ' || p_name AS title FROM (SELECT *, {PAGE} AS page, '<h3>Head  <i>' || p_name || '</i></h3>text<strong></strong>' AS r FROM part)")
def g17_section_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment.section_titles(edition(spark, sf_dir, "'<h3>Head  <i>', p_name, '</i></h3>text<strong></strong>'"), "html", ["page"])


# Lines and headers. ----------------------------------------------------------------------------

_FAMILIES: Sequence[tuple[str, str]] = (
    ("list", "' 12', chr(10), '---', chr(10), verse, chr(10), '- கபிலர்.'"), ("table", "' 1.2.3', chr(10), '----', chr(10), verse"), ("numbered", "' 12.', chr(10), '()', chr(10), verse, ' 1.2'"),
    ("dotted", "' 12', chr(10), chr(10), verse, ' 9 '"), ("stanza", "' 01-020', chr(10), '---', chr(10), verse, ' 12.'"), ("chapter", "' ௧௨', chr(10), '---', chr(10), '௧-௨. ', verse, ' 12'"), ("marked", "'    12', chr(10), verse, ' (5)'"),
)


@query(f"SELECT p_partkey, {', '.join(f'{VERSE} || chr(10) || {VERSE} AS {f}_text' for f, _ in _FAMILIES)} FROM part")
def f2_f3_clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same two lines out of what each family of editions leaves around them."""
    parts = spread(table(spark, sf_dir, "part")).selectExpr("*", f"{VERSE} AS verse").selectExpr("p_partkey", *[f"concat(verse, {t}) AS {f}" for f, t in _FAMILIES])
    return parts.select("p_partkey", *[X.clean_verse(F.col(f), f).alias(f"{f}_text") for f, _ in _FAMILIES])


@query("SELECT c_custkey, trim(c_name || ' ' || c_mktsegment) AS clean, CASE WHEN c_nationkey % 3 = 0 THEN '```' || chr(10) || c_name || chr(10) || c_mktsegment || chr(10) || '```' WHEN c_nationkey % 3 = 1 THEN c_name ELSE '_—_' END AS block, CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS answer FROM customer")
def f4_f26_f32_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    block = F.when(F.col("c_nationkey") % 3 == 0, F.concat_ws("\n", "c_name", "c_mktsegment")).when(F.col("c_nationkey") % 3 == 1, F.col("c_name")).otherwise("")
    answer = F.when(F.col("c_nationkey") % 2 == 0, F.concat(F.lit("<think>a\nb</think> "), "c_name")).otherwise("<think>all of it</think>")
    return c.select("c_custkey", X.clean_text(F.concat(F.lit("  "), "c_name", F.lit(" \n&nbsp;\t"), "c_mktsegment", F.lit(" "))).alias("clean"), X.markdown_block(block).alias("block"), X.without_thinking(answer, F.col("c_mktsegment")).alias("answer"))


@query("""
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'பாலை' WHEN 1 THEN 'முல்லை' WHEN 2 THEN 'மருதம்' ELSE '' END AS tinai, CASE p_partkey % 4 WHEN 0 THEN p_name WHEN 2 THEN p_name ELSE '' END AS turai,
       CASE WHEN p_partkey % 3 = 0 THEN 'கபிலர்' ELSE '' END AS poet, CASE p_partkey % 5 WHEN 0 THEN 'Kurinji' WHEN 1 THEN 'Palai' WHEN 2 THEN 'Neytal' END AS thinai
FROM part
""")
def f14_f16_f18_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, k = table(spark, sf_dir, "part"), F.col("p_partkey")
    raw = F.when(k % 4 == 0, F.concat(k.cast("string"), F.lit(". பாலை["), "p_name", F.lit(".]"))).when(k % 4 == 1, F.concat(k.cast("string"), F.lit(". முல்லை."))).when(k % 4 == 2, F.concat(F.lit("திணை: மருதம்;\nதுறை: "), "p_name", F.lit("."))).otherwise("none")
    end = F.when(k % 3 == 0, F.lit("verse<br>- கபிலர்.")).when(k % 3 == 1, F.lit("verse<br>- Name.")).otherwise("verse")
    spelt = F.when(k % 5 == 0, "குறிஞ்சி​.").when(k % 5 == 1, "இது பாலைத் திணை").when(k % 5 == 2, " நெய்தல், ").when(k % 5 == 3, "ஏதோ")
    named = H.setting_and_genre(raw)
    return p.select("p_partkey", named["tinai"].alias("tinai"), named["turai"].alias("turai"), H.poet_at_end(end).alias("poet"), X.exact_or_hit(spelt, H.SETTING_NAMES).alias("thinai"))


_LINES = [
    ("கபிலர் பாடியது. திணை: வாகை; துறை: அரச வாகை.", "வாகை", "அரச வாகை", "கபிலர்", "", "வாகை"),
    ("**ஒளவையார் பாடியது. திணையும் துறையும் அவை.", H.SAME, H.SAME, "ஒளவையார்", "", None),
    ("பரணர் பாடியது. திணை: அது. துறை: இயன்மொழி.", H.SAME, "இயன்மொழி", "பரணர்", "", None),
    ("nothing here", "", "", "", "", None),
]


@query("SELECT p_partkey, " + ", ".join("CASE p_partkey % 4 " + " ".join(f"WHEN {k} THEN {'NULL' if line[i] is None else chr(39) + line[i] + chr(39)}" for k, line in enumerate(_LINES)) + f" END AS {c}" for i, c in ((1, "tinai"), (2, "turai"), (3, "poet"), (4, "subject"), (5, "resolved"))) + " FROM part")
def f15_w7_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 4
    line = F.coalesce(*[F.when(k == i, F.lit(t[0])) for i, t in enumerate(_LINES)])
    got = H.attribution_line(line)
    return table(spark, sf_dir, "part").select("p_partkey", *[got[c].alias(c) for c in ("tinai", "turai", "poet", "subject")], H.resolved(got["tinai"]).alias("resolved"))


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 6 < 4 THEN p_name END AS poet, CASE p_partkey % 6 WHEN 0 THEN 'Palai' WHEN 1 THEN 'Mullai' WHEN 2 THEN 'Neytal' END AS tinai,
       CASE p_partkey % 6 WHEN 0 THEN 'talaivi' WHEN 1 THEN 'tozi' WHEN 2 THEN 'panan' WHEN 3 THEN 'talaivan' END AS speaker FROM part
""")
def f17_f19_f20_bilingual_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey") % 6
    tail = F.when(k == 0, " பாலைத் திணை – தலைவி சொன்னது").when(k == 1, ", முல்லை, தோழி கூறியது").when(k == 2, ", நெய்தல் – what the hero's friend said").otherwise(", what the hero said")
    header = F.when(k < 4, F.concat(F.lit("X 1, "), "p_name", tail)).otherwise("X")
    return table(spark, sf_dir, "part").select("p_partkey", H.poet_in_header(header).alias("poet"), H.setting_in_header(header).alias("tinai"), H.speaker_in_header(header).alias("speaker"))


@query("SELECT p_partkey, CASE WHEN p_size % 5 + 1 <= 3 THEN 'சம்பந்தர்' ELSE '' END AS attribution FROM part")
def f39_attribution_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", X.attributed(F.col("p_size") % 5 + 1, "சம்பந்தர்", (1, 2, 3)).alias("attribution"))


# Profiles of made pages. -----------------------------------------------------------------------

@query(f"""
SELECT {PAGE} AS page, CAST(count(*) AS BIGINT) AS n_end_markers, CAST(count(*) AS BIGINT) AS n_lists_with_marker, CAST(count(*) AS BIGINT) AS n_numbered_headings, CAST(count(*) AS BIGINT) AS n_numbers,
       CAST(count(*) AS BIGINT) AS keyword_padal, array_to_string(list_sort(list_distinct(list('(' || p_partkey || ')')))[1:10], ' ') AS number_samples, array_to_string(list(CAST(p_partkey AS VARCHAR) || '. Head' ORDER BY p_partkey), '/') AS numbered_headings,
       array_to_string(list('Item ' || p_partkey ORDER BY p_partkey)[1:5], '/') AS samples_ul
FROM part GROUP BY 1
""")
def a14_a17_a20_a21_a22_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = edition(spark, sf_dir, "'<h2>', p_partkey, '. Head</h2>Padal (', p_partkey, ')<ul>Item ', p_partkey, '</ul>'")
    marked = edition(spark, sf_dir, "'<ul>(N)</ul>'").select("page", F.col("html").alias("marked"))
    p = profile.html_profile(pages, "html", ["page"], samples=True).drop("n_end_markers", "n_lists_with_marker")
    m = profile.html_profile(marked.withColumnRenamed("marked", "html"), "html", ["page"], samples=False).select("page", "n_end_markers", "n_lists_with_marker")
    joined = lambda c, s: F.array_join(c, s).alias(c)
    return p.join(m, "page").select("page", "n_end_markers", "n_lists_with_marker", "n_numbered_headings", "n_numbers", "keyword_padal", joined("number_samples", " "), joined("numbered_headings", "/"), joined("samples_ul", "/"))
