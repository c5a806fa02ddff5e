"""Parser plug-ins as a table function.

``parse`` is a polymorphic table function: it takes a table, the name of a plug-in and the columns that matter, and its
``analyze`` answers with the columns that this plug-in gives. Rows are dealt by ``file`` and come in order, so a plug-in
may carry what it has read (a heading, a running number) from page to page of one file:

    SELECT * FROM parse(TABLE(SELECT file, page, html FROM pages), 'headed')

A plug-in is a class with ``fields`` (a StructType), ``columns`` (what it reads, besides ``file``: the first is the
order) and ``rows``, which gets one row's values and gives tuples; one object serves one file from its first row to its
last. ``plug_in`` registers a class under a name; the function is made known to a session by ``register``.

This leaves code generation: editions whose marks an expression can say are cheaper by ``segment`` and ``scan``. A file is one
task's, page by page; nothing of it is held but what the plug-in carries.

Defined results: a null text gives no rows; a null file is a file; pages of equal place come as they are.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn, SelectedColumn

PLUG_INS: dict[str, type] = {}


def plug_in(name: str):
    """Registers a parser class under a name."""

    def add(cls: type) -> type:
        PLUG_INS[name] = cls
        return cls

    return add


class Parse:
    """The table function; see the module."""

    @staticmethod
    def analyze(pages: AnalyzeArgument, edition: AnalyzeArgument) -> AnalyzeResult:
        if not pages.isTable:
            raise Exception("the first argument of parse is a table")
        if edition.value not in PLUG_INS:
            raise Exception(f"no parser '{edition.value}'; there are {', '.join(sorted(PLUG_INS))}")
        parser = PLUG_INS[edition.value]
        there = [f.name for f in pages.dataType.fields]
        missing = [c for c in ("file", *parser.columns) if c not in there]
        if missing:
            raise Exception(f"parser '{edition.value}' needs the columns {', '.join(missing)}")
        kind = next(f.dataType for f in pages.dataType.fields if f.name == "file")
        schema = T.StructType([T.StructField("file", kind), *parser.fields.fields])
        return AnalyzeResult(schema, partitionBy=[PartitioningColumn("file")], orderBy=[OrderingColumn(parser.columns[0])], select=[SelectedColumn(c) for c in ("file", *parser.columns)])

    def __init__(self) -> None:
        self.parser = None

    def eval(self, row: Row, edition: str) -> Iterator[tuple]:
        if self.parser is None:
            self.parser = PLUG_INS[edition]()
        for found in self.parser.rows(*[row[c] for c in self.parser.columns]):
            yield (row["file"], *found)


def register(spark: SparkSession, name: str = "parse") -> None:
    spark.udtf.register(name, F.udtf(Parse))


def parsed(pages: DataFrame, edition: str) -> DataFrame:
    """The rows of a plug-in over a table of ``file`` and what the plug-in reads."""
    spark = pages.sparkSession
    register(spark)
    return spark.sql("SELECT * FROM parse(TABLE(SELECT * FROM {pages}), {edition})", pages=pages, edition=edition)


def _text(markup: str) -> str:
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", markup)).split())


@plug_in("headed")
class Headed:
    """Blocks of marked-up pages with the heading that they stand under, which goes on over the pages of a file."""

    columns = ("page", "html")
    fields = T.StructType().add("page", "long").add("block", "integer").add("heading", "string").add("text", "string")
    _BLOCK = re.compile(r"<(h[1-6]|p|li)\b[^>]*>(.*?)(?=</\1\s*>|<(?:h[1-6]|p|li)\b|\Z)", re.S | re.I)

    def __init__(self) -> None:
        self.heading: str | None = None

    def rows(self, page: int, markup: str | None) -> Iterator[tuple]:
        block = 0
        for m in self._BLOCK.finditer(markup or ""):
            text = _text(m[2])
            if m[1][0] in "hH":
                self.heading = text
            elif text:
                block += 1
                yield page, block, self.heading, text


@plug_in("numbered")
class Numbered:
    """Lines of plain texts with a number that runs on over the pages of a file; lines of marks only are left out."""

    columns = ("page", "text")
    fields = T.StructType().add("page", "long").add("number", "long").add("line", "string")

    def __init__(self) -> None:
        self.number = 0

    def rows(self, page: int, text: str | None) -> Iterator[tuple]:
        for line in (text or "").split("\n"):
            line = line.strip(" \t\r")
            if line and not re.fullmatch(r"[=#\-\s]+", line):
                self.number += 1
                yield page, self.number, line


@plug_in("spoken")
class Spoken:
    """Turns of a conversation: who speaks, the question that was asked last, and how many turns ago that was."""

    columns = ("turn", "role", "text")
    fields = T.StructType().add("turn", "long").add("role", "string").add("asked", "string").add("ago", "integer")

    def __init__(self) -> None:
        self.asked, self.at = None, None

    def rows(self, turn: int, role: str | None, text: str | None) -> Iterator[tuple]:
        if text is None:
            return
        if role == "user":
            self.asked, self.at = text, turn
        yield turn, role, self.asked, None if self.at is None else turn - self.at
