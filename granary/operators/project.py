"""From extracted rows to full entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import labelled, padded_id
from granary.operators import schema as S


def to_entries(df: DataFrame, source_text: str, number: str = "number", values: dict[str, Column] | None = None, context: Sequence[tuple[str, Column]] = ()) -> DataFrame:
    """All fields of an entry: id and number, what ``values`` gives, the text's defaults for the rest,
    and nulls. ``context`` is joined into cultural_context."""
    given = {
        "verse_id": padded_id(S.PREFIXES[source_text], F.col(number), S.ID_WIDTHS.get(source_text, 3)),
        "source_text": F.lit(source_text),
        "verse_number": F.col(number).cast("string"),
        "cultural_context": labelled(context) if context else F.lit(None),
    } | (values or {})
    cols = []
    for f in S.FIELDS:
        default = S.DEFAULTS.get(source_text, {}).get(f.name)
        c = given.get(f.name, F.lit(None))
        c = c.cast(S.spark_type(f))
        cols.append((F.coalesce(c, F.lit(default)) if default else c).alias(f.name))
    return df.select(*cols)


def completed(df: DataFrame) -> DataFrame:
    """The table with all fields of an entry, nulls where it lacks them, and its other columns."""
    lacking = [F.lit(None).cast(S.spark_type(f)).alias(f.name) for f in S.FIELDS if f.name not in df.columns]
    return df.select("*", *lacking)
