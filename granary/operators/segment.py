"""Cutting pages into rows, as expressions: anchors split a page, patterns read each piece.

A lookahead split keeps each anchor at the head of its piece and drops no text. Editions whose
anchors overlap or need state are read by ``granary.operators.scan``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions import headers as H
from granary.functions.text import block_text, clean_verse, script_count, strip

LIST = r"(?is)<ul\b[^>]*>(.*?)</ul>"


def split_at(df: DataFrame, html: str, anchor: str, keep: Sequence[str], flags: str = "(?is)") -> DataFrame:
    """keep, pos, piece for each anchor; the text before the first anchor is left out."""
    pieces = F.split(F.col(html), f"{flags}(?={anchor})")
    return df.select(*keep, F.posexplode(pieces).alias("pos", "piece")).where(F.col("piece").rlike(f"{flags}^{anchor}"))


def anchored(df: DataFrame, html: str, anchor: str, keep: Sequence[str], flags: str = "(?is)") -> DataFrame:
    """The same with the anchor's first group as ``number`` and what follows the anchor as ``body``."""
    head = f"{flags}^{anchor}"
    return split_at(df, html, anchor, keep, flags).select(*keep, "pos", F.regexp_extract("piece", head, 1).alias("number"), F.regexp_replace("piece", head, "").alias("body"))


def longest(texts: Column, measure, least: int) -> Column:
    """The text that measures most, the first of equals; null below ``least``."""
    sized = F.filter(F.transform(texts, lambda t, i: F.struct(measure(t).alias("n"), (-i).alias("at"), t.alias("t"))), lambda s: s.n >= least)
    return F.array_max(sized)["t"]


def heading_longest_list(df: DataFrame, html: str, keep: Sequence[str], word: str = "செய்யுள்", least: int = 40) -> DataFrame:
    """``<h3>word N</h3>`` to the next; the list with most script is the verse, the prose before the
    first list is the header."""
    rows = anchored(df, html, rf"<h3[^>]*>\s*{word}\s*(\d+)\s*</h3>", keep)
    head = block_text(F.regexp_extract("body", r"(?is)^(.*?)(?:<ul\b|$)", 1))
    texts = F.filter(F.transform(F.regexp_extract_all("body", F.lit(LIST), F.lit(1)), lambda x: x), lambda x: script_count(x) >= least)
    chosen = longest(F.filter(texts, lambda x: clean_verse(block_text(x), "list") != ""), script_count, least)
    named = H.setting_and_genre(head)
    return rows.select(*keep, "number", clean_verse(block_text(chosen), "list").alias("text"), named["tinai"].alias("tinai"), named["turai"].alias("turai")).where("text <> ''")


def bold_number_list(df: DataFrame, html: str, keep: Sequence[str], low: int = 100, high: int = 450, least: int = 30) -> DataFrame:
    """``<strong>N.`` to the next such; the first list is the verse."""
    rows = anchored(df, html, r"<strong>\s*(\d+)\.\s*", keep, "(?s)")
    # Numbers out of range are no anchors: their text belongs to the piece before.
    rows = _merged(rows, keep, F.col("number").cast("int").between(low, high), lambda n, b: F.concat(F.lit("<strong>"), n, F.lit(". "), b))
    chunk = F.regexp_replace(F.regexp_extract("body", LIST, 1), r"(?i)</?strong[^>]*>", "")
    bare = lambda c: F.rtrim(strip(c), F.lit("."))
    return rows.select(
        *keep, "number", clean_verse(block_text(chunk), "list").alias("text"), bare(F.regexp_extract("body", r"^\s*([^\[<\n]+)", 1)).alias("tinai"),
        bare(F.regexp_extract(F.substring("body", 1, 800), r"\[([^\]]+)\]", 1)).alias("turai"), H.poet_at_end(chunk).alias("poet"),
    ).where((F.col("text") != "") & (script_count(F.col("text")) >= least))


def _merged(rows: DataFrame, keep: Sequence[str], real: Column, as_text) -> DataFrame:
    """Pieces whose anchor is not real are put back at the end of the last real piece before them."""
    from pyspark.sql.window import Window

    w = Window.partitionBy(*keep).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(real, F.col("pos")), ignorenulls=True).over(w)
    parts = rows.withColumn("owner", owner).withColumn("own", real).where("owner is not null")
    parts = parts.withColumn("part", F.when(F.col("own"), F.col("body")).otherwise(as_text(F.col("number"), F.col("body"))))
    return parts.groupBy(*keep, "owner").agg(F.max(F.when(F.col("own"), F.col("number"))).alias("number"), F.array_sort(F.collect_list(F.struct("pos", "part"))).alias("p")).select(
        *keep, F.col("owner").alias("pos"), "number", F.array_join(F.transform("p", lambda x: x.part), "").alias("body")
    )


def table_rows(df: DataFrame, html: str, keep: Sequence[str], part: str, offsets: dict[int, int], least: int = 30) -> DataFrame:
    """Two levels: ``<h3>P.D title`` pieces (P is the row's ``part``, D up to 250), and in each the
    table rows ``number | lines | reference``."""
    head = r"<h3[^>]*>\s*(?:<font[^>]*>\s*)?\s*(\d+)\.\s*(\d+)[\s.]*([^<\n]+?)\s*<"
    pieces = split_at(df, html, r"<h3[^>]*>\s*(?:<font[^>]*>\s*)?\s*\d+\.\s*\d+[\s.]*[^<\n]+?\s*<", [*keep, part])
    g = lambda k: F.regexp_extract("piece", f"(?s)^{head}", k)
    rows = pieces.select(*keep, part, "pos", g(1).cast("int").alias("p"), g(2).cast("int").alias("d"), F.rtrim(strip(g(3)), F.lit(".")).alias("title"), F.regexp_replace("piece", f"(?s)^{head}", "").alias("body"))
    rows = rows.where((F.col("p") == F.col(part)) & F.col("d").between(1, 250))
    cell = r"""(?is)<td[^>]*valign\s*=\s*["']?top["']?[^>]*>\s*(\d+)\.?\s*<td[^>]*>\s*(.*?)\s*<td[^>]*valign\s*=\s*["']?bottom["']?[^>]*>\s*([0-9.]+)"""
    found = F.arrays_zip(F.regexp_extract_all("body", F.lit(cell), F.lit(1)).alias("n"), F.regexp_extract_all("body", F.lit(cell), F.lit(2)).alias("t"))
    tune = strip(F.regexp_extract(F.substring("body", 1, 1000), r"(?s)<b>\s*பண்\s*[-\s]*\s*([^<\n]+?)\s*</b>", 1))
    out = rows.select(*keep, part, F.concat_ws(".", "p", "d").alias("section"), "title", tune.alias("tune"), F.inline(found)).withColumnsRenamed({"0": "n", "1": "t"})
    offset = F.coalesce(*[F.when(F.col(part) == k, F.lit(v)) for k, v in offsets.items()], F.lit(0))
    out = out.select(*keep, "section", "title", "tune", F.col("n").cast("int").alias("n"), offset.alias("o"), clean_verse(block_text(F.col("t")), "table").alias("text"))
    return out.where(F.col("n").between(1, 2000) & (script_count(F.col("text")) >= least)).select(*keep, "section", "title", "tune", F.col("n").cast("string").alias("number"), (F.col("n") + F.col("o")).alias("global_number"), "text")


def real_headers(df: DataFrame, text: str, keep: Sequence[str], prefix: str, markers: Sequence[str] = ("திணை", "சொன்னது", "கூறியது", "உரைத்தது", "பாடியது"), window: int = 250) -> DataFrame:
    """keep, number, block: ``PREFIX N,`` heads a poem if a marker stands within ``window`` characters
    of it; the first of each number counts, and its block ends where the next poem begins."""
    pieces = split_at(df, text, rf"{prefix}\s+\d+\s*,", keep, "(?s)")
    rows = pieces.withColumn("number", F.regexp_extract("piece", rf"(?s)^{prefix}\s+(\d+)\s*,", 1))
    from pyspark.sql.window import Window

    # What follows a header may belong to the next piece, so the window reaches over it.
    w = Window.partitionBy(*keep).orderBy("pos")
    ahead = F.substring(F.concat(F.col("piece"), F.coalesce(F.lead("piece").over(w), F.lit("")), F.coalesce(F.lead("piece", 2).over(w), F.lit(""))), 1, window)
    marked = F.lit(False)
    for m in markers:
        marked = marked | F.contains(ahead, F.lit(m))
    rows = rows.withColumn("_real", marked)
    first = F.row_number().over(Window.partitionBy(*keep, "number", "_real").orderBy("pos"))
    rows = rows.withColumn("_real", F.col("_real") & (first == 1)).withColumnRenamed("piece", "body")
    return _merged(rows, keep, F.col("_real"), lambda n, b: b).select(*keep, "pos", F.col("number").cast("int").alias("number"), F.col("body").alias("block"))


def bilingual(blocks: DataFrame, keep: Sequence[str], english: Sequence[str]) -> DataFrame:
    """Header, verse, translation and notes of each block of ``real_headers``."""
    b = F.col("block")
    ends = ("சொன்னது", "கூறியது", "உரைத்தது", "பாடியது", "சொல்லியது", "பாடிய பாட்டு", "கூற்று")  # the first in this order
    at = F.instr(b, "திணை")
    end = F.coalesce(*[F.when(F.instr(b, m) > 0, F.instr(b, m) + F.lit(len(m) - 1)) for m in ends], F.when(at > 0, at + 3 + F.least(F.lit(150), F.length(b) - at - 3)), F.least(F.lit(200), F.length(b)))
    rows = blocks.withColumn("_end", end)
    number = F.col("number").cast("string")
    heads = [F.concat(F.lit(rf"(?is)^(.*?){p}\s+"), number, F.lit(r"\s*,")) for p in english]
    hits = [F.when(F.regexp_like(b, h), F.length(F.call_function("regexp_extract", b, h, F.lit(1)))) for h in heads]
    rows = rows.withColumn("_eng", F.coalesce(*hits))
    header = strip(F.substr(b, F.lit(1), F.col("_end")))
    verse = F.when(F.col("_eng").isNotNull(), F.substr(b, F.col("_end") + 1, F.greatest(F.col("_eng") - F.col("_end"), F.lit(0)))).otherwise(F.substr(b, F.col("_end") + 1))
    lines = F.transform(F.split(F.regexp_replace(strip(verse), r"(?Um)\s+(\d{1,2})\s*$", ""), "\n"), strip)
    lines = F.filter(lines, lambda x: (x != "") & (x.rlike(r"[\x{0B80}-\x{0BFF}]") | x.startswith("(") | (F.length(x) < 5)))
    eng = strip(F.substr(b, F.col("_eng") + 1))
    body = F.when(F.instr(eng, "\n") > 1, strip(F.substr(eng, F.instr(eng, "\n")))).otherwise(eng)
    notes = (r"\n\s*Notes?\s*[:–—]\s*", r"\n\s*Notes?\s*\n", r"\n\s*Meanings?\s*[:–—]\s*", r"\n\s*Meanings?\s*\n")
    cut = [F.when(body.rlike(p), F.struct(strip(F.regexp_extract(body, f"(?s)^(.*?){p}", 1)).alias("b"), strip(F.regexp_extract(body, f"(?s){p}(.*)$", 1)).alias("n"))) for p in notes]
    parts = F.coalesce(*cut, F.struct(body.alias("b"), F.lit("").alias("n")))
    context = F.nullif(strip(F.regexp_extract(header, r"[–—]\s*([^\n]+)$", 1)), F.lit(""))
    return rows.select(
        *keep, "number", H.poet_in_header(header).alias("poet"), H.setting_in_header(header).alias("tinai"), H.speaker_in_header(header).alias("speaker_role"), context.alias("dramatic_context"),
        strip(F.array_join(lines, "\n")).alias("classical_tamil"), F.nullif(parts["b"], F.lit("")).alias("english"), F.nullif(parts["n"], F.lit("")).alias("notes"),
    ).where("classical_tamil <> ''")


def section_titles(df: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """keep, at, title of every h3 or bold section heading that is not empty."""
    pattern = r"(?s)<h3[^>]*>.*?</h3>|<strong>[^<]+</strong>"
    return _titles(df, html, keep, pattern, lambda x: strip(F.regexp_replace(F.replace(F.regexp_replace(x, "<[^>]+>", ""), F.lit("\u00a0"), F.lit(" ")), r"(?U)\s+", " ")))


def subsection_titles(df: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """keep, at, title of ``<strong>N.. title</strong>`` headings."""
    pattern = r"<strong>\s*\.?\d+\.+\s*[^<\n]+?\s*</strong>"
    return _titles(df, html, keep, pattern, lambda x: F.rtrim(strip(F.regexp_extract(x, r"<strong>\s*\.?\d+\.+\s*([^<\n]+?)\s*</strong>", 1)), F.lit(".")))


def _titles(df: DataFrame, html: str, keep: Sequence[str], pattern: str, read) -> DataFrame:
    """Matches do not overlap, so their places follow from the lengths of what lies between them."""
    found = F.regexp_extract_all(F.col(html), F.lit(pattern), F.lit(0))
    gaps = F.split(F.col(html), pattern)
    lengths = F.transform(F.arrays_zip(gaps.alias("g"), found.alias("f")), lambda z: F.struct(F.length(z["g"]).alias("g"), F.coalesce(F.length(z["f"]), F.lit(0)).alias("f")))
    rows = df.select(*keep, found.alias("f"), lengths.alias("l")).select(*keep, F.posexplode("f").alias("k", "m"), "l")
    at = F.aggregate(F.slice("l", F.lit(1), F.col("k")), F.lit(0), lambda s, x: s + x.g + x.f) + F.get("l", F.col("k"))["g"]
    return rows.select(*keep, at.alias("at"), read(F.col("m")).alias("title")).where("title <> ''")


def numbered_ranges(df: DataFrame, html: str, keep: Sequence[str], labels: Sequence[tuple[str, str]]) -> DataFrame:
    """keep, ord, start, end, label of ``<h3>name (a-b)</h3>`` headings."""
    from granary.functions.text import first_hit

    found = F.regexp_extract_all(F.col(html), F.lit(r"<h3[^>]*>([^<]+)</h3>"), F.lit(1))
    rows = df.select(*keep, F.posexplode(found).alias("ord", "t")).where(F.col("t").rlike(r"\(\d+[\s\-–—]+\d+\)"))
    n = lambda k: F.regexp_extract("t", r"\((\d+)[\s\-–—]+(\d+)\)", k).cast("int")
    return rows.select(*keep, "ord", n(1).alias("start"), n(2).alias("end"), F.coalesce(first_hit(F.col("t"), labels), strip(F.regexp_replace("t", r"\(.*?\)", ""))).alias("label"))


def edition_of(filename: Column, rules: Sequence[tuple[str, str]], otherwise: str) -> Column:
    """The parser for a file, by what its name contains."""
    return F.coalesce(*[F.when(F.contains(filename, F.lit(k)), F.lit(v)) for k, v in rules], F.lit(otherwise))


def tagged_segments(df: DataFrame, html: str, keep: Sequence[str], tag: str) -> DataFrame:
    """keep, pos, text of every closed element of one kind."""
    inner = F.regexp_extract_all(F.col(html), F.lit(rf"(?s)<{tag}>(.*?)</{tag}>"), F.lit(1))
    return df.select(*keep, F.posexplode(inner).alias("pos", "raw")).select(*keep, "pos", strip(block_text(F.col("raw"))).alias("text"))
