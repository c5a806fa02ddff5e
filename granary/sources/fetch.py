"""Fetching a manifest of files: which to fetch, with how many tries, and what came of it.

Fetching itself is an injected function, so the rules can be tested without a network."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bytes below which a page is suspect.
SMALL = 1000


class NotFound(Exception):
    pass


def selected(manifest: DataFrame, prefixes: Sequence[str] | None, name: str = "filename") -> DataFrame:
    """The files that begin with one of the prefixes; all, if none are given."""
    if prefixes is None:
        return manifest
    hit = F.lit(False)
    for p in prefixes:
        hit = hit | F.col(name).startswith(p)
    return manifest.where(hit)


def aliased(text: str, aliases: dict[str, Sequence[str]]) -> Sequence[str] | None:
    """The prefixes behind a text's name; the name itself, if it has no alias."""
    return None if text == "all" else aliases.get(text.lower(), [text])


def get(fetch: Callable[[str], bytes], url: str, tries: int = 3, wait: float = 5.0, pause: Callable[[float], None] = time.sleep) -> tuple[str, bytes | None, str]:
    """(status, content, warning). A missing page is final; other failures are tried again, after a
    pause that grows by ``wait`` each time."""
    for k in range(tries):
        try:
            data = fetch(url)
            head = data[:500].lower()
            warning = "small" if len(data) < SMALL else "" if b"<html" in head or b"<!doctype" in head else "not html"
            return "success", data, warning
        except NotFound:
            return "not_found", None, ""
        except Exception:
            if k < tries - 1:
                pause(wait * (k + 1))
    return "failed", None, ""


def fetch_all(manifest: DataFrame, there: DataFrame, fetch: Callable[[str], bytes], tries: int = 3, gap: float = 2.0, wait: float = 5.0) -> DataFrame:
    """filename, status (skipped, success, not_found, failed), warning, content. Files that are there
    are skipped; each task waits ``gap`` seconds between requests."""
    todo = manifest.join(there.select("filename", F.lit(True).alias("_there")), "filename", "left")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for name, url, have in zip(f["filename"], f["url"], f["_there"]):
                if have is True:
                    out.append((name, "skipped", "", None))
                    continue
                status, data, warning = get(fetch, url, tries, wait)
                out.append((name, status, warning, data))
                if gap:
                    time.sleep(gap)
            yield pd.DataFrame(out, columns=["filename", "status", "warning", "content"])

    return todo.select("filename", "url", "_there").mapInPandas(run, "filename string, status string, warning string, content binary")


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n"))
