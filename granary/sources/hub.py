"""Data sources of Spark: the splits of a data set, and files that a manifest lists on hosts.

``register`` makes both known to a session. ``granary_splits`` reads a folder of JSON lines with a folder or a file for each
split (``train/part-0.json``, ``split=train/part-0.json``, ``test.jsonl``): a task for each ``chunk`` of bytes of each file, so
one large split is read by many. The options ``split`` and ``file`` (names with commas between) leave files out before anything is
read; ``contains`` (any column holds the text, in lower case) is tested where lines are read, so other lines never reach Spark.

With the option ``pushdown`` filters of a query do the same: those on ``split`` and ``file`` leave files out, ``json`` containing,
starting with or ending with a text is tested while reading. It is for a table that is loaded for one query: Spark 4.1 keeps a
Python reader with the loaded table, so a second, other filter on the same table would meet what the first has left.

``granary_fetch`` fetches what a manifest (JSON lines of filename and url) lists: a task for each host, which waits ``gap`` seconds
between requests, so no host is asked by two tasks at once. Of a manifest of more than ``LISTED`` rows each task reads all and
takes the rows of its hosts, by a hash of the host, so nothing but file names comes to the driver. The options ``host`` and ``filename``
(with ``pushdown``, filters on them) leave requests out. The option
``fetcher`` names a function (``module:function``) that gives the bytes of a url.

Paths are read by Arrow's file systems (local, HDFS, S3, ...) on executors; the driver lists files and hosts only.
"""

from __future__ import annotations

import importlib
import json
import posixpath
import re
import time
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, In, InputPartition, StringContains, StringEndsWith, StringStartsWith

from granary.sources.fetch import get

CHUNK, READ = 64 << 20, 4 << 20
#: Rows of a manifest that is planned on the driver, and the lanes that the hosts of a longer one are dealt to.
LISTED, LANES = 100_000, 48


def register(spark: SparkSession) -> None:
    """Both sources, and the setting without which Spark refuses readers that take filters."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    for source in (SplitSource, FetchSource):
        spark.dataSource.register(source)


def opened(path: str) -> tuple[fs.FileSystem, str]:
    if re.match(r"\w[\w+.-]+:/", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def files(path: str) -> list[tuple[str, int]]:
    """Path and size of the files below a folder whose names don't begin with '.' or '_'."""
    where, root = opened(path)
    found = where.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda p: any(x[:1] in "._" for x in posixpath.relpath(p, root).split("/"))
    return sorted((f.path, f.size) for f in found if f.type == fs.FileType.File and not hidden(f.path))


def split_of(root: str, path: str) -> str:
    """The first folder below the root, less ``split=``; of a file in the root its name up to the first dot or dash."""
    first, *more = posixpath.relpath(path, opened(root)[1]).split("/")
    return first.removeprefix("split=") if more else re.split(r"[.-]", first)[0]


def _on(options) -> bool:
    return str(options.get("pushdown", "false")).lower() == "true"


def _names(options, name: str) -> set[str] | None:
    return set(options[name].split(",")) if options.get(name) else None


def _kept(wanted: set[str] | None, f: Filter) -> set[str]:
    values = {f.value} if isinstance(f, EqualTo) else set(f.value)
    return values if wanted is None else wanted & values


@dataclass
class Chunk(InputPartition):
    split: str
    path: str
    start: int
    end: int


class SplitSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "granary_splits"

    def schema(self) -> str:
        return "split string, file string, offset long, json string"

    def reader(self, schema) -> DataSourceReader:
        return (PushedSplitReader if _on(self.options) else SplitReader)(self.options)


class SplitReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.chunk = options["path"], int(options.get("chunk", CHUNK))
        self.any = options.get("contains", "").lower()
        self.splits, self.files = _names(options, "split"), _names(options, "file")
        self.tests: list[tuple[str, str]] = []

    def partitions(self) -> Sequence[InputPartition]:
        found = [(split_of(self.path, p), p, size) for p, size in files(self.path)]
        wanted = [x for x in found if (self.splits is None or x[0] in self.splits) and (self.files is None or posixpath.basename(x[1]) in self.files)]
        out = [Chunk(split, p, at, min(size, at + self.chunk)) for split, p, size in wanted for at in range(0, size, self.chunk)]
        return out or [Chunk("", "", 0, 0)]

    def _passes(self, line: str) -> bool:
        how = {"StringContains": str.__contains__, "StringStartsWith": str.startswith, "StringEndsWith": str.endswith}
        return all(how[kind](line, value) for kind, value in self.tests) and (not self.any or self.any in line.lower())

    def read(self, part: Chunk) -> Iterator[pa.RecordBatch]:
        if part.start == part.end:
            return
        at, lines, size = [], [], 0
        for offset, raw in lines_of(self.path, part):
            line = raw.decode("utf-8", "replace").rstrip("\r")
            if line.strip() and self._passes(line):
                at.append(offset)
                lines.append(line)
                size += len(raw)
            if size > READ:
                yield self._batch(part, at, lines)
                at, lines, size = [], [], 0
        if at:
            yield self._batch(part, at, lines)

    def _batch(self, part: Chunk, at: list[int], lines: list[str]) -> pa.RecordBatch:
        n = len(at)
        return pa.RecordBatch.from_arrays([pa.array([part.split] * n), pa.array([posixpath.basename(part.path)] * n), pa.array(at, pa.int64()), pa.array(lines)], names=["split", "file", "offset", "json"])


class PushedSplitReader(SplitReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            if column == ("split",) and isinstance(f, (EqualTo, In)):
                self.splits = _kept(self.splits, f)
            elif column == ("file",) and isinstance(f, (EqualTo, In)):
                self.files = _kept(self.files, f)
            elif column == ("json",) and isinstance(f, (StringContains, StringStartsWith, StringEndsWith)):
                self.tests.append((type(f).__name__, f.value))
            else:
                yield f


def lines_of(root: str, part: Chunk) -> Iterator[tuple[int, bytes]]:
    """Offset and bytes of the lines that begin in a chunk."""
    with opened(root)[0].open_input_file(part.path) as f:
        at = max(0, part.start - 1)  # a line begins in the chunk if the byte before it ends one
        f.seek(at)
        rest, skipping = b"", part.start > 0
        while True:
            block = f.read(READ)
            rest += block
            *whole, rest = rest.split(b"\n")
            if not block and rest:
                whole, rest = [*whole, rest], b""
            for line in whole:
                if at >= part.end:
                    return
                if not skipping:
                    yield at, line
                skipping = False
                at += len(line) + 1
            if not block or at >= part.end:
                return


@dataclass
class Host(InputPartition):
    host: str
    rows: list[tuple[str, str]]


@dataclass
class Lane(InputPartition):
    number: int


class FetchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "granary_fetch"

    def schema(self) -> str:
        return "host string, filename string, url string, status string, warning string, content binary"

    def reader(self, schema) -> DataSourceReader:
        return (PushedFetchReader if _on(self.options) else FetchReader)(self.options)


class FetchReader(DataSourceReader):
    def __init__(self, options):
        self.path, self.fetcher = options["path"], options["fetcher"]
        self.tries, self.gap, self.wait = int(options.get("tries", 3)), float(options.get("gap", 2.0)), float(options.get("wait", 5.0))
        self.hosts, self.names = _names(options, "host"), _names(options, "filename")

    def _listed(self) -> Iterator[tuple[str, str, str]]:
        """host, filename, url of the manifest's rows that are asked for."""
        for path, size in files(self.path):
            for _, raw in lines_of(self.path, Chunk("", path, 0, size)):
                if raw.strip():
                    row = json.loads(raw)
                    host = urlsplit(row["url"]).hostname or ""
                    if (self.hosts is None or host in self.hosts) and (self.names is None or row["filename"] in self.names):
                        yield host, row["filename"], row["url"]

    def partitions(self) -> Sequence[InputPartition]:
        by_host: dict[str, list[tuple[str, str]]] = {}
        for k, (host, filename, url) in enumerate(self._listed()):
            if k == LISTED:
                return [Lane(n) for n in range(LANES)]
            by_host.setdefault(host, []).append((filename, url))
        return [Host(h, rows) for h, rows in sorted(by_host.items())] or [Host("", [])]

    def read(self, part: Host | Lane) -> Iterator[tuple]:
        module, _, name = self.fetcher.partition(":")
        fetch = getattr(importlib.import_module(module), name)
        if isinstance(part, Host):
            rows = ((part.host, *r) for r in part.rows)
        else:
            rows = (r for r in self._listed() if zlib.crc32(r[0].encode()) % LANES == part.number)
        free: dict[str, float] = {}  # when a host may be asked again
        for host, filename, url in rows:
            if self.gap and host in free:
                time.sleep(max(0.0, free[host] - time.monotonic()))
            status, data, warning = get(fetch, url, self.tries, self.wait)
            if self.gap:
                free[host] = time.monotonic() + self.gap
            yield host, filename, url, status, warning, data


class PushedFetchReader(FetchReader):
    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            column = getattr(f, "attribute", ())
            if column == ("host",) and isinstance(f, (EqualTo, In)):
                self.hosts = _kept(self.hosts, f)
            elif column == ("filename",) and isinstance(f, (EqualTo, In)):
                self.names = _kept(self.names, f)
            else:
                yield f
