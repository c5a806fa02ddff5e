"""Which texts contain which items, as literal text.

Items that a count finds to fit in a task are one Aho-Corasick automaton, which goes over each text once, however many items there
are; nothing is shuffled, and repeated places of an item cost a step each. Larger lists are joined by words (``joined``)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from granary.functions.text import ngrams

#: Items, and bytes of their texts, up to which they are one automaton in each task.
ITEMS, BYTES = 200_000, 8 << 20

#: Items of one or two words that are compared with all documents; and by how many characters more are looked up.
FEW, HEAD = 1000, 4


class Automaton:
    """Finds which of some texts stand in another, in one pass."""

    def __init__(self, items: list[tuple]):
        """items: id and text."""
        import ahocorasick

        ids: dict[str, list] = {}
        for item, t in items:
            ids.setdefault(t, []).append(item)
        self.machine = ahocorasick.Automaton()
        for t, of in ids.items():
            self.machine.add_word(t, tuple(of))
        if ids:
            self.machine.make_automaton()
        self.empty = not ids

    def found(self, text: str) -> list:
        if self.empty:
            return []
        return [i for of in {of for _, of in self.machine.iter(text)} for i in of]


_MADE: dict[int, tuple[list, Automaton]] = {}


def _automaton(held) -> Automaton:
    """The automaton of a broadcast list, made once in a Python worker and kept until there is another."""
    items = held.value  # one object for all tasks of a worker
    if id(items) not in _MADE:
        _MADE.clear()
        _MADE[id(items)] = (items, Automaton(items))
    return _MADE[id(items)][1]


def contained(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str, most: int = ITEMS) -> DataFrame:
    """doc_id, item_id of every document that contains an item's text, once for each of its rows. Empty items are in no document's
    result; null ids are kept. Up to ``most`` items are one automaton."""
    listed = items.select(F.col(item_id), F.col(text).alias("t")).where("t <> ''")
    size = listed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).alias("bytes")).first()
    if size.n > most or size.bytes > BYTES:
        return joined(docs, items, doc_id, item_id, text)
    held = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in listed.distinct().collect()])  # the size is checked
    kinds = [to_arrow_type(docs.schema[doc_id].dataType), to_arrow_type(items.schema[item_id].dataType)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(held)
        for b in batches:
            out = [(i, item) for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for item in machine.found(t)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["doc", "item"])

    found = docs.select(F.col(doc_id), F.col(text).alias("d")).where("d is not null").mapInArrow(run, f"doc {docs.schema[doc_id].dataType.simpleString()}, item {items.schema[item_id].dataType.simpleString()}")
    return found.toDF(doc_id, item_id)


def joined(docs: DataFrame, items: DataFrame, doc_id: str, item_id: str, text: str) -> DataFrame:
    """The same by joins, for lists of any size.

    Of an item's words between spaces all but the first and last are whole words of a document that
    contains it, so pairs are formed by the longest of those and then checked. Items with fewer than
    three words are compared with all documents while they are few, else looked up by their first
    characters. Empty items are in no document's result."""
    words = F.filter(F.split(F.col("t"), r"\s+"), lambda w: w != "")
    i = items.select(F.col(item_id), F.col(text).alias("t")).where("t is not null").withColumn("w", words)
    inner = F.slice("w", F.lit(2), F.greatest(F.size("w") - 2, F.lit(0)))
    keyed = i.where(F.size("w") >= 3).select(item_id, "t", F.array_max(F.transform(inner, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))["w"].alias("word"))
    d = docs.select(F.col(doc_id), F.col(text).alias("d")).where("d is not null")
    occurs = d.select(doc_id, "d", F.explode(F.array_distinct(F.split("d", r"\s+"))).alias("word"))
    # The document's text is joined again only for pairs, so it is not copied for each word.
    pairs = occurs.select(doc_id, "word").join(keyed.select(item_id, "word"), "word").select(doc_id, item_id).distinct()
    long = pairs.join(d, doc_id).join(keyed.select(item_id, "t"), item_id).where(F.contains("d", F.col("t"))).select(doc_id, item_id)
    short = i.where(F.size("w") < 3).where("t <> ''").select(item_id, "t")
    n = short.limit(FEW + 1).count()
    if not n:
        return long
    if n <= FEW:
        return long.unionByName(d.join(F.broadcast(short), F.contains("d", F.col("t"))).select(doc_id, item_id))
    # Many short items are looked up by how they begin, among all runs of characters of a document.
    sizes = [r[0] for r in short.select(F.least(F.length("t"), F.lit(HEAD))).distinct().collect()]  # at most ``HEAD`` rows
    runs = F.array_distinct(F.concat(*[ngrams(F.col("d"), k) for k in sizes]))
    met = d.select(doc_id, F.explode(runs).alias("head")).join(short.withColumn("head", F.substring("t", 1, HEAD)), "head").select(doc_id, item_id, "t")
    return long.unionByName(met.join(d, doc_id).where(F.contains("d", F.col("t"))).select(doc_id, item_id).distinct())
