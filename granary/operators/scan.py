"""Editions whose rows need more than one split: slices with a range, look-ups by place, and events.

A page is cut at an anchor into slices (``slices``): each has its number, its place and what follows up
to the next slice; anchors that an edition does not want stay text of the slice before. Headings are
looked up by place (``as_of``), by range or by the number before. Editions whose parts stand beside
each other in any order are read as events (``events``), by windows over them.

All functions give no rows for a null page; ``keep`` names the columns that identify a page.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from granary.functions.text import block_text, clean_verse, script_count, strip
from granary.operators import dedup, lookups, segment

# The numbers that each volume holds.
VOLUME_RANGES = {
    "Divya_Prabandham_Mudhal_Ayiram_1": (1, 473), "Divya_Prabandham_Mudhal_Ayiram_2": (474, 947), "Divya_Prabandham_Periya_Thirumozhi_1": (948, 1447),
    "Divya_Prabandham_Periya_Thirumozhi_2": (1448, 2031), "Divya_Prabandham_Siru_Thirumurai": (2032, 2790), "Divya_Prabandham_Iramanusa_1": (2791, 3342),
    "Divya_Prabandham_Iramanusa_2": (3343, 4000),
}
# Words that name a book in its heading.
BOOK_LABELS = [
    ("பாயிரம்", "Pāyiram"), ("முதல்", "Tantra 1"), ("இரண்டாந்", "Tantra 2"), ("இரண்டாம்", "Tantra 2"), ("மூன்றாந்", "Tantra 3"), ("மூன்றாம்", "Tantra 3"),
    ("நான்காந்", "Tantra 4"), ("நான்காம்", "Tantra 4"), ("ஐந்தாந்", "Tantra 5"), ("ஐந்தாம்", "Tantra 5"), ("ஆறாந்", "Tantra 6"), ("ஆறாம்", "Tantra 6"),
    ("ஏழாந்", "Tantra 7"), ("ஏழாம்", "Tantra 7"), ("எட்டாந்", "Tantra 8"), ("எட்டாம்", "Tantra 8"), ("ஒன்பதாந்", "Tantra 9"), ("ஒன்பதாம்", "Tantra 9"),
]
# Words of chapter titles, of headings that are none, and the name of what stands before chapter 1.
CHAPTER_WORDS = "காதை|வரி|பாடல்|kaathai"
NAMED_CHAPTER = "காதை"
NOT_CHAPTERS = ("அருளிய", "ஆசிரியர்", "cIttalai")
PROLOGUE = "பதிகம் (Prologue)"
SUMMARY = "Summary"
# Labels of commentary and explanation, of setting and genre.
COMMENTARY, EXPLANATION, SETTING, GENRE = "உரை", "விளக்கம்", "திணை", "துறை"

#: A line that is a number, between breaks. Matches do not overlap: of two numbers in a row the first counts.
NUMBER_LINE = r"(?:<br[^>]*>|\n)\s*(\d{1,4})[:.]?\s*<br[^>]*>"
DOTTED_LINE = r"(?i)(?:<br[^>]*>|\n)\s*(\d{1,9})\.\s*<br[^>]*>"
NAMED_LINE = r"(?:<br[^>]*>|\n)\s*(\d{3,4})\.\s+([\x{0B80}-\x{0BFF}][^<\n]*?)<br[^>]*>"
CHAPTER_HEAD = r"<h3[^>]*>\s*(?:<font[^>]*>)?\s*\d+\.\s*[^<\n]+?\s*(?:</font>)?\s*</h3>|(?:<br\s*/?>|<hr[^>]*>|\n)\s*\d+\.\s+[^<\n]{4,80}?\s*<br"
ANY_HEAD = r"<h3[^>]*>\s*(?:<font[^>]*>)?\s*[^<\n]+?(?:</font>)?\s*</h3>"
CONTENTS_LINE = r"(?:<br[^>]*>|\n)\s*\d+\.\s+\S"
STANZA = r"(?is)<tr>?\s*<td[^>]*>\s*(.*?)\s*<td\s+valign=bottom[^>]*>\s*(\d{2})-(\d{3})"
#: Tasks that sort events, for each partition of other shuffles: a row is sorted several times, with its text.
DEALT = 4


def slices(df: DataFrame, html: str | Column, anchor: str, keep: Sequence[str], before: bool = False) -> DataFrame:
    """keep, pos, at, head, body: every match of an anchor with its offset and what follows up to the
    next match; with ``before``, also what stands before the first (pos -1, an empty head)."""
    page = F.col(html) if isinstance(html, str) else html
    found, gaps = F.regexp_extract_all(page, F.lit(anchor), F.lit(0)), F.split(page, anchor)
    pairs = F.transform(gaps, lambda g, i: F.struct((i - 1).alias("pos"), F.when(i > 0, F.get(found, i - 1)).otherwise("").alias("head"), g.alias("body")))
    upto = Window.partitionBy(*keep).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    rows = df.where(page.isNotNull()).select(*keep, F.inline(pairs))
    rows = rows.withColumn("at", F.coalesce(F.sum(F.length("head") + F.length("body")).over(upto), F.lit(0)).cast("int"))
    return rows if before else rows.where("pos >= 0")


def wanted(rows: DataFrame, keep: Sequence[str], real: Column) -> DataFrame:
    """Slices for which ``real`` holds; the others are text of the last such slice before them."""
    order = Window.partitionBy(*keep).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_real", F.coalesce(real, F.lit(False))).withColumn("_owner", F.last(F.when(F.col("_real"), F.col("pos")), ignorenulls=True).over(order))
    part = F.struct("pos", F.when(F.col("_real"), F.col("body")).otherwise(F.concat("head", "body")).alias("t"))
    own = [F.max(F.when(F.col("_real"), F.col(c))).alias(c) for c in rows.columns if c not in (*keep, "pos", "body", "_real", "_owner")]
    # What is collected is one slice's parts.
    out = rows.where("_owner is not null").groupBy(*keep, "_owner").agg(*own, F.array_sort(F.collect_list(part)).alias("_parts"))
    return out.withColumn("body", F.array_join(F.transform("_parts", lambda p: p["t"]), "")).withColumnRenamed("_owner", "pos").drop("_parts")


def upto(body: Column, *stops: str) -> Column:
    """A body up to the first of some patterns."""
    return F.regexp_replace(body, f"(?s)(?:{'|'.join(stops)}).*", "")


def verse(body: Column, family: str) -> Column:
    return clean_verse(block_text(body), family)


def first_of_each(rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    return dedup.pick(rows, [*keep, "number"], [F.col("pos")])


def titled(rows: DataFrame, titles: DataFrame, keep: Sequence[str], name: str) -> DataFrame:
    """Rows with the title that stands at or before them on their page, as ``name``; empty if none does."""
    heads = titles.select(*keep, F.col("at").alias("_there"), F.col("title").alias("_title"))
    found = lookups.as_of(rows, heads, keep, "at", "_there", ["_title"])
    return found.withColumn(name, F.coalesce("_title", F.lit(""))).drop("_title")


def number_lines(df: DataFrame, html: str, keep: Sequence[str], name: str | None = None, least: int = 20) -> DataFrame:
    """keep, pos, number, section, text: numbers alone on a line, within the volume's range."""
    stem = F.regexp_extract(F.col(name) if name else F.lit(""), r"([^/]*?)(?:\.[^./]*)?$", 1)
    bound = lambda k: F.coalesce(*[F.when(F.col("_volume") == v, F.lit(r[k])) for v, r in VOLUME_RANGES.items()], F.lit((1, 4000)[k]))
    pages = df.select(*keep, F.col(html).alias("_html"), stem.alias("_volume"))
    rows = slices(pages, "_html", NUMBER_LINE, [*keep, "_volume"]).withColumn("number", F.regexp_extract("head", NUMBER_LINE, 1).try_cast("int"))
    rows = wanted(rows, [*keep, "_volume"], F.col("number").between(bound(0), bound(1)))
    rows = rows.select(*keep, "pos", "at", "number", verse(upto(F.col("body"), "<h3", "<hr"), "numbered").alias("text")).where(script_count(F.col("text")) >= least)
    return titled(first_of_each(rows, keep), segment.section_titles(df, html, keep), keep, "section").select(*keep, "pos", F.col("number").cast("string").alias("number"), "section", "text")


def dotted_lines(df: DataFrame, html: str, keep: Sequence[str], least: int = 30) -> DataFrame:
    """keep, pos, number, title, section, text: ``N.`` alone on a line; the book by ranges of numbers,
    the section by place."""
    rows = slices(df, html, DOTTED_LINE, keep).withColumn("number", F.regexp_extract("head", DOTTED_LINE, 1))
    own = F.concat(F.lit(r"(?m)[^\S\n]+"), F.col("number"), F.lit(r"[^\S\n]*$"))
    text = clean_verse(F.regexp_replace(block_text(upto(F.col("body"), "<strong>", "<h3", "<hr")), own, F.lit("")), "dotted")
    rows = rows.select(*keep, "pos", "at", F.col("number").cast("int").alias("number"), text.alias("text")).where(script_count(F.col("text")) >= least)
    books = segment.numbered_ranges(df, html, keep, BOOK_LABELS).groupBy(*keep).agg(F.array_sort(F.collect_list(F.struct("ord", "start", "end", "label"))).alias("_books"))  # one page's headings
    rows = first_of_each(rows, keep).join(books, list(keep), "left")
    book = F.get(F.filter("_books", lambda b: (F.col("number") >= b["start"]) & (F.col("number") <= b["end"])), F.lit(0))["label"]
    rows = rows.withColumn("title", F.coalesce(book, F.lit(""))).drop("_books")
    return titled(rows, segment.subsection_titles(df, html, keep), keep, "section").select(*keep, "pos", F.col("number").cast("string").alias("number"), "title", "section", "text")


def contents(df: DataFrame, html: str, keep: Sequence[str], within: int = 8000, gap: int = 300, least: int = 3) -> DataFrame:
    """keep, end: where the list of contents ends, of pages that begin with one: at the break after the
    last of the numbered lines that lie less than ``gap`` apart."""
    lines = slices(df, F.substring(F.col(html), 1, within), CONTENTS_LINE, keep)
    lines = lines.withColumn("_n", F.count("*").over(Window.partitionBy(*keep))).where(F.col("_n") >= least)
    run = lookups.gap_clusters(lines, keep, F.col("at"), "at", gap - 1).where("cluster = 0").groupBy(*keep).agg(F.max(F.col("at") + F.length("head")).alias("_last"))
    stop = F.expr(f"locate('<br', `{html}`, _last + 1)")
    return df.join(run, list(keep)).select(*keep, F.when((stop > 0) & (stop - 1 - F.col("_last") < 200), stop + 3).otherwise(F.col("_last")).alias("end"))


def chapters(df: DataFrame, html: str, keep: Sequence[str], last: int = 12, least: int = 60, plenty: int = 500) -> DataFrame:
    """keep, pos, number, title, text: chapters under headings or numbered lines after the contents, a
    heading rather than a line; the first list with plenty of script, else the one with most."""
    rows = slices(df, html, CHAPTER_HEAD, keep).join(contents(df, html, keep), list(keep), "left")
    named = r"(?s)(\d+)\.\s*([^<\n]+?)\s*(?:<|$)"
    rows = rows.withColumns({"number": F.regexp_extract("head", named, 1).try_cast("int"), "title": F.rtrim(strip(F.regexp_extract("head", named, 2)), F.lit(".")), "_line": (~F.lower("head").startswith("<h3")).cast("int")})
    able = F.col("number").between(1, last) & (F.col("at") > F.coalesce("end", F.lit(0))) & ((F.col("_line") == 0) | F.col("title").rlike(f"(?i){CHAPTER_WORDS}"))
    rows = rows.withColumn("_able", F.coalesce(able, F.lit(False)))
    rank = F.row_number().over(Window.partitionBy(*keep, "_able", "number").orderBy("_line", "at"))
    rows = wanted(rows.withColumn("_rank", rank), keep, F.col("_able") & (F.col("_rank") == 1))
    lists = F.transform(F.regexp_extract_all("body", F.lit(segment.LIST), F.lit(1)), lambda x: verse(x, "chapter"))
    ample = F.get(F.filter(lists, lambda t: script_count(t) >= plenty), F.lit(0))
    return rows.select(*keep, "pos", F.col("number").cast("string").alias("number"), "title", F.coalesce(ample, segment.longest(lists, script_count, least)).alias("text")).where("text is not null")


def stanzas(df: DataFrame, html: str, keep: Sequence[str], name: str | None = None, last: int = 30, least: int = 30) -> DataFrame:
    """keep, pos, number, title, text, line_end: table rows that end in ``CC-LLL``, under the chapter CC.
    A heading without a number has that of the last numbered one before it, plus one; what stands before
    the first heading is chapter 00."""
    pages = df.where(~F.contains(F.coalesce(F.col(name), F.lit("")), F.lit(SUMMARY))) if name else df
    rows = slices(pages, html, ANY_HEAD, keep, before=True)
    said = strip(F.regexp_extract("head", r"<h3[^>]*>\s*(?:<font[^>]*>)?\s*([^<\n]+)", 1))
    numbered = F.regexp_extract(said, r"^(\d{1,2})[.\s]+\S", 1).try_cast("int")
    rows = rows.withColumns({"_said": said, "number": F.when(numbered <= last, numbered)})
    barred = F.lit(False)
    for w in NOT_CHAPTERS:
        barred = barred | F.contains("_said", F.lit(w))
    rows = rows.withColumn("_named", F.col("number").isNull() & F.contains("_said", F.lit(NAMED_CHAPTER)) & ~F.col("_said").rlike(r"^\d") & ~barred)
    rows = lookups.previous_plus_one(rows, keep, "pos", "number", last)
    rows = rows.withColumn("_real", (F.col("pos") >= 0) & F.col("number").isNotNull() & (~F.col("inferred") | F.col("_named")))
    rows = rows.withColumn("_any", F.max(F.col("_real").cast("int")).over(Window.partitionBy(*keep))).where("_any = 1")
    front = F.col("pos") == -1
    rows = rows.withColumns({"number": F.when(front, F.lit(0)).otherwise(F.col("number")), "title": F.when(front, F.lit(PROLOGUE)).otherwise(F.rtrim(strip(F.regexp_replace("_said", r"^\d{1,2}[.\s]+", "")), F.lit(".")))})
    rows = wanted(rows.drop("_any", "_said", "_named", "inferred").withColumnRenamed("_real", "_head"), keep, F.col("_head") | front)
    cells = [F.regexp_extract_all("body", F.lit(STANZA), F.lit(k)).alias(c) for k, c in ((1, "t"), (2, "cc"), (3, "line_end"))]
    found = rows.select(*keep, "pos", "number", "title", F.posexplode(F.arrays_zip(*cells)).alias("k", "c")).where(F.col("c.cc").cast("int") == F.col("number"))
    out = found.select(*keep, "pos", "k", F.lpad(F.col("number").cast("string"), 2, "0").alias("number"), "title", verse(F.col("c.t"), "stanza").alias("text"), F.col("c.line_end").alias("line_end"))
    return out.where(script_count(F.col("text")) >= least)


def named_lines(df: DataFrame, html: str, keep: Sequence[str], found: DataFrame | None = None, low: int = 100, high: int = 450, least: int = 30) -> DataFrame:
    """keep, pos, number, tinai, turai, text: ``N. name`` lines without markup, up to the next such, a
    rule of dashes or a bold number; numbers in ``found`` (keep, number) are left out."""
    rows = slices(df, html, NAMED_LINE, keep).withColumns({"number": F.regexp_extract("head", NAMED_LINE, 1).try_cast("int"), "tinai": F.rtrim(strip(F.regexp_extract("head", NAMED_LINE, 2)), F.lit("."))})
    rows = rows.where(F.col("number").between(low, high))
    if found is not None:
        rows = lookups.missing(rows, found.select(*keep, F.col("number").cast("int").alias("number")), [*keep, "number"])
    body = upto(F.col("body"), r"-{5,}", r"<strong>\s*\d+\.")
    turai = F.rtrim(strip(F.regexp_extract(F.substring(body, 1, 600), r"\[([^\]]+)\]", 1)), F.lit("."))
    inner = F.regexp_replace(F.regexp_replace(body, r"(?s)^(.*?)\[[^\]]+\]\s*<br[^>]*>", "$1"), rf"(?s)\([^)]*?{EXPLANATION}.*?\).*", "")
    lines = F.split(verse(inner, "list"), "\n")
    starts = F.array_position(F.transform("_lines", lambda x: (script_count(x) >= 8) & (F.length(x) < 90)), True).cast("int")
    tail = F.slice("_lines", F.col("_start") + 1, F.greatest(F.size("_lines") - F.col("_start"), F.lit(0)))
    ends = F.array_position(F.transform("_tail", lambda x: x.startswith("(") | F.contains(x, F.lit(EXPLANATION)) | F.contains(x, F.lit(COMMENTARY))), True).cast("int")
    kept = F.concat(F.array(F.get("_lines", F.col("_start") - 1)), F.when(F.col("_end") > 0, F.slice("_tail", F.lit(1), F.col("_end") - 1)).otherwise(F.col("_tail")))
    rows = rows.withColumns({"turai": turai, "_lines": lines}).withColumn("_start", starts).where("_start > 0").withColumn("_tail", tail).withColumn("_end", ends)
    rows = rows.withColumn("text", F.array_join(kept, "\n")).where(script_count(F.col("text")) >= least)
    return first_of_each(rows, keep).select(*keep, "pos", F.col("number").cast("string").alias("number"), "tinai", "turai", "text")


# Events. ---------------------------------------------------------------------------------------

#: Elements that are one event each, whatever they hold.
WHOLE = ("ul", "strong", "center", "h3")


class Events(HTMLParser):
    """A page as a flat list of (kind, text, holds an h3): whole elements, breaks, and text between."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.list: list[tuple[str, str, bool]] = []
        self.kind, self.depth, self.text, self.h3 = "", 0, [], False

    def handle_starttag(self, tag, attrs):
        if self.depth:
            self.depth += tag == self.kind
            self.h3 |= tag == "h3"
        elif tag == "br":
            self.list.append(("br", "", False))
        elif tag in WHOLE:
            self.kind, self.depth, self.text, self.h3 = tag, 1, [], tag == "h3"

    def handle_endtag(self, tag):
        if self.depth and tag == self.kind:
            self.depth -= 1
            if not self.depth:
                self.list.append((self.kind, "".join(self.text), self.h3))

    def handle_data(self, data):
        if self.depth:
            self.text.append(data)
        elif data.strip():
            self.list.append(("#", data, False))

    @classmethod
    def of(cls, page: str) -> list[tuple[str, str, bool]]:
        p = cls()
        p.feed(page)
        p.close()
        return p.list + ([(p.kind, "".join(p.text), p.h3)] if p.depth else [])


def events(df: DataFrame, html: str, keep: Sequence[str]) -> DataFrame:
    """keep, pos, kind, text, h3, line (the text on one line) of every event of every page."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep) + ", pos int, kind string, text string, h3 boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k, page in enumerate(b.column(len(keep))):  # a batch for each page bounds what is held
                found = Events.of(page.as_py() or "")
                own = [b.column(i).take(pa.array([k] * len(found), pa.int64())) for i in range(len(keep))]
                cols = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.string(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(range(len(found)), pa.int32()), *cols], names=[*keep, "pos", "kind", "text", "h3"])

    line = strip(F.regexp_replace(F.replace(F.col("text"), F.lit(" "), F.lit(" ")), r"(?U)\s+", " "))
    return df.select(*keep, html).mapInArrow(run, schema).withColumn("line", line)


def grouped(rows: DataFrame, keep: Sequence[str], begins: Column, ahead: int) -> DataFrame:
    """Events with ``part``, the number of the event before them (or the same) where ``begins`` holds,
    and ``nth``, how far they are from it; those further than ``ahead`` are left out. Pages are dealt to a number of tasks by name:
    events of one text are alike and shrink so much in a shuffle that a few tasks would be made of many, which sort them in full."""
    rows = rows.repartition(DEALT * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keep)
    order = Window.partitionBy(*keep).orderBy("pos")
    rows = rows.withColumn("_begins", F.coalesce(begins, F.lit(False))).withColumn("part", F.sum(F.col("_begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("nth", F.col("pos") - F.coalesce(F.last(F.when(F.col("_begins"), F.col("pos")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(-1)))
    return rows.where((F.col("nth") <= ahead) | (F.col("part") == 0)).drop("_begins")


def told(of: Column, when: Column) -> Column:
    """The texts of some events of a part in order, as one line."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(when, F.struct("pos", of.alias("t"))))), lambda x: x["t"]), " ")


def marked_lists(df: DataFrame, html: str, keep: Sequence[str], ahead: int = 60, back: int = 15) -> DataFrame:
    """keep, number, title, text, header_line, prose, commentary, explanation: lists that end in ``(N)``.
    What follows up to the next list or heading is header line, commentary or explanation; what stands
    before, back to a heading or list, is prose. Of several headings of a number the last has the title."""
    found = events(df, html, keep)
    head = F.regexp_extract("line", r"(\d+)\.\s*(.+)", 1)
    titles = found.where("h3").select(*keep, head.alias("number"), F.rtrim(strip(F.regexp_extract("line", r"(\d+)\.\s*(.+)", 2)), F.lit(".")).alias("title"), "pos").where("number <> ''")
    titles = titles.groupBy(*keep, "number").agg(F.max_by("title", "pos").alias("title"))

    rows = grouped(found, keep, (F.col("kind") == "ul") | F.col("h3"), 1 << 30)
    part = Window.partitionBy(*keep, "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    opener, dashes = (F.col("nth") == 0) & (F.col("part") > 0), (F.col("kind") == "#") & F.col("line").rlike("^-{5,}")
    mode = F.when(F.col("kind") == "strong", F.when(F.contains("line", F.lit(COMMENTARY)), "commentary").when(F.contains("line", F.lit(EXPLANATION)), "explanation"))
    rows = rows.withColumns({"_open": opener, "_dashes": dashes})
    rows = rows.withColumns({"mode": F.last(mode, ignorenulls=True).over(part), "_over": F.max(F.col("_dashes").cast("int")).over(part) == 1, "_end": F.max("pos").over(Window.partitionBy(*keep, "part"))})
    named = (F.col("kind") == "#") & F.contains("line", F.lit(SETTING)) & ~F.col("_open") & ~F.col("_over")
    rows = rows.withColumn("_named", named).withColumn("_line", F.col("_named") & (F.sum(F.col("_named").cast("int")).over(part) == 1))
    after = ~F.col("_open") & ~F.col("_over") & (F.col("nth") <= ahead)
    said = after & ~F.col("_line") & ~F.col("kind").isin("strong", "br") & (F.col("line") != "")
    early = ~F.col("_open") & (F.col("kind") != "br") & (F.length("line") > 10) & ~F.col("_dashes") & (F.col("pos") > F.col("_end") - back)
    parts = rows.groupBy(*keep, "part").agg(
        F.max(F.when(F.col("_open") & (F.col("kind") == "ul"), F.col("text"))).alias("list"), F.max(F.when(after & F.col("_line"), strip(F.col("text")))).alias("header_line"),
        told(F.col("line"), said & (F.col("mode") == "commentary")).alias("commentary"), told(F.col("line"), said & (F.col("mode") == "explanation")).alias("explanation"), told(F.col("line"), early).alias("_prose"),
    )
    prose = parts.select(*keep, (F.col("part") + 1).alias("part"), F.col("_prose").alias("prose"))
    out = parts.where("list is not null").withColumn("number", F.regexp_extract(strip(F.col("list")), r"\((\d+)\)\s*$", 1)).where("number <> ''").join(prose, [*keep, "part"], "left").join(titles, [*keep, "number"], "left")
    empty = lambda c: F.coalesce(c, F.lit("")).alias(c)
    return out.select(*keep, "number", empty("title"), clean_verse(F.col("list"), "marked").alias("text"), empty("header_line"), empty("prose"), "commentary", "explanation").where("text <> ''")


def bold_numbers(df: DataFrame, html: str, keep: Sequence[str], ahead: int = 120) -> DataFrame:
    """keep, number, title, text, header_line, prose, commentary, explanation of ``<strong>N title``: prose
    up to a list, the last list, the line that names setting or genre, then what is labelled commentary
    or explanation. A rule of dashes ends an entry that has had its list."""
    headed = r"^(\d+)\b\s*\.?\s*"
    rows = grouped(events(df, html, keep), keep, (F.col("kind") == "strong") & F.col("line").rlike(headed), ahead).where("part > 0")
    part = Window.partitionBy(*keep, "part").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    raw = F.when(F.col("kind") == "#", strip(F.col("text"))).otherwise(F.col("line"))
    label = lambda w: F.col("raw").rlike(rf"(?U)^{w} ?:")
    rows = rows.withColumns({"raw": raw, "_open": F.col("nth") == 0, "_seen": F.max(((F.col("kind") == "ul") & (F.col("nth") > 0)).cast("int")).over(part) == 1})
    rows = rows.withColumns({"_rule": ~F.col("_open") & F.replace("raw", F.lit(" "), F.lit("")).rlike("^-{5,}$"), "_label": F.when(~F.col("_open") & ~F.col("kind").isin("ul", "br"), F.when(label(COMMENTARY), "commentary").when(label(EXPLANATION), "explanation"))})
    rows = rows.withColumns({"mode": F.coalesce(F.last("_label", ignorenulls=True).over(part), F.lit("prose")), "_over": F.max((F.col("_rule") & F.col("_seen")).cast("int")).over(part) == 1})
    text = ~F.col("_open") & ~F.col("_over") & ~F.col("_rule") & ~F.col("kind").isin("ul", "br") & (F.col("raw") != "")
    named = text & F.col("_seen") & (F.col("mode") == "prose") & (F.contains("raw", F.lit(SETTING)) | F.contains("raw", F.lit(GENRE)))
    rows = rows.withColumn("_named", named).withColumn("_line", F.col("_named") & (F.sum(F.col("_named").cast("int")).over(part) == 1)).withColumn("_text", text)
    bare = F.when(F.col("_label").isNotNull(), F.regexp_replace("raw", rf"(?U)^(?:{COMMENTARY}|{EXPLANATION})\s*:\s*", "")).otherwise(F.col("raw"))
    rows = rows.withColumn("bare", bare).withColumn("_text", F.col("_text") & (F.col("bare") != ""))
    labelled = lambda m: told(F.col("bare"), F.col("_text") & F.col("_seen") & (F.col("mode") == m)).alias(m)
    out = rows.groupBy(*keep, "part").agg(
        F.max(F.when(F.col("_open"), F.col("line"))).alias("_head"), F.max_by(F.when((F.col("kind") == "ul") & ~F.col("_over"), F.col("text")), F.when((F.col("kind") == "ul") & ~F.col("_over"), F.col("pos"))).alias("_list"),
        F.max(F.when(F.col("_line"), F.col("raw"))).alias("header_line"), told(F.col("bare"), F.col("_text") & ~F.col("_seen")).alias("prose"), labelled("commentary"), labelled("explanation"),
    )
    title = F.rtrim(strip(F.regexp_replace("_head", headed, "")), F.lit("."))
    return out.where("_list is not null").select(
        *keep, F.regexp_extract("_head", headed, 1).alias("number"), title.alias("title"), clean_verse(F.col("_list"), "marked").alias("text"), F.coalesce("header_line", F.lit("")).alias("header_line"), "prose", "commentary", "explanation"
    ).where("text <> ''")
