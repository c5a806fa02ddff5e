"""Scalar text functions, as Column expressions that stay in the JVM.

Lengths and positions count code points. White space and digits are Unicode-aware where the pattern
says ``(?U)``; Spark's ``trim`` and ``split`` treat only spaces, so ``strip`` and ``tokens`` are used.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The script whose letters mark a line as verse, as a regex class body.
TAMIL = r"\x{0B80}-\x{0BFF}"
TAMIL_DIGITS = "௦-௯"
BLANK = "_—_"


def strip(c: Column) -> Column:
    """Without white space at either end, of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def rstrip_chars(c: Column, chars: str) -> Column:
    return F.rtrim(c, F.lit(chars))


def spaces(c: Column) -> Column:
    """No-break spaces, also as entities, become spaces."""
    return F.replace(F.replace(c, F.lit("\u00a0"), F.lit(" ")), F.lit("&nbsp;"), F.lit(" "))


def block_text(html: Column) -> Column:
    """Markup to text: ``<br>`` is a line end, other tags go."""
    return spaces(F.regexp_replace(F.regexp_replace(html, r"(?i)<br\s*/?>", "\n"), r"<[^>]+>", ""))


def clean_text(c: Column) -> Column:
    return strip(F.regexp_replace(spaces(c), r"(?U)\s+", " "))


def clean_lines(c: Column, line_patterns: Sequence[str], drop: str | None = None) -> Column:
    """Each line less what the patterns match, trimmed; blank lines, and those that ``drop`` matches, go."""
    text = spaces(c)

    def one(line: Column) -> Column:
        for p in line_patterns:
            line = F.regexp_replace(line, p, "")
        return strip(line)

    lines = F.filter(F.transform(F.split(text, "\n"), one), lambda x: x != "")
    if drop:
        lines = F.filter(lines, lambda x: ~x.rlike(drop))
    return strip(F.array_join(lines, "\n"))


# What each family of editions leaves in its lines (patterns taken out of a line, lines dropped).
LINE_RULES: dict[str, tuple[tuple[str, ...], str | None]] = {
    "list": ((r"(?U)\s+\d{1,3}\s*$", rf"^\s*[1-3](?=[{TAMIL}])", r"(?U)^\s*\(\d+\)\s*$"), r"^-{3,}$"),
    "table": ((r"(?U)\s+\d+(?:\.\d+){0,2}\s*$",), r"^-{3,}$"),
    "numbered": ((r"(?U)\s+\d+(?:\.\d+){1,2}\s*$", r"(?U)\s+\d{1,4}\.?\s*$"), r"^[()\[\].,]+$"),
    "dotted": ((r"(?U)\s+\d{1,4}\s*$",), None),
    "stanza": ((r"(?U)\s+\d{2}-\d{3}\s*$", r"(?U)\s+\d{1,4}\.?\s*$"), r"^-{3,}$"),
    "chapter": ((r"(?U)\s+\d{1,4}\s*$", rf"\s+[{TAMIL_DIGITS}]+\s*$", rf"^\s*[{TAMIL_DIGITS}]+\s*-\s*[{TAMIL_DIGITS}]+\s*\.\s*"), r"^-{3,}$"),
    "marked": ((r"(?U)\s{3,}\d{1,3}\s*$", r"(?U)\t+\s*\d{1,3}\s*$"), None),
}


def clean_verse(c: Column, family: str) -> Column:
    patterns, drop = LINE_RULES[family]
    if family == "list":  # a last line such as "- Name." says who wrote it
        c = F.regexp_replace(spaces(c), r"(?U)\n\s*-\s*[^\n]+\.\s*$", "")
    if family == "marked":
        c = F.regexp_replace(strip(spaces(c)), r"(?U)\s*\(\d+\)\s*$", "")
    return clean_lines(c, patterns, drop)


def script_count(c: Column, script: str = TAMIL) -> Column:
    return F.length(F.regexp_replace(c, f"[^{script}]", ""))


def has_script(c: Column, script: str = TAMIL) -> Column:
    return c.rlike(f"[{script}]")


def script_density(c: Column, script: str = TAMIL) -> Column:
    """Percent of characters in the script; 0 for empty texts."""
    return F.when(F.length(c) > 0, script_count(c, script) / F.length(c) * 100).otherwise(F.lit(0.0))


def normalize(c: Column) -> Column:
    """One line in lower case: line ends, also written as backslash n, and runs of space are a space."""
    return F.lower(strip(F.regexp_replace(F.replace(c, F.lit("\\n"), F.lit(" ")), r"(?U)\s+", " ")))


def first_line(c: Column) -> Column:
    return normalize(F.split(c, "\n", 2)[0])


def ngrams(normalized: Column, n: int = 3) -> Column:
    """The distinct runs of n characters; none if the text is shorter. Characters are split once, as
    finding a place in a text takes time in proportion to it."""
    chars = F.regexp_extract_all(normalized, F.lit("(?s)."), F.lit(0))
    runs = lambda cs: F.transform(F.sequence(F.lit(0), F.size(cs) - F.lit(n)), lambda i: F.concat(*[F.get(cs, i + F.lit(k)) for k in range(n)]))
    # The one-item array binds the characters, so they are split once and not for each run.
    bound = F.transform(F.array(chars), lambda cs: F.when(F.size(cs) >= n, F.array_distinct(runs(cs))))[0]
    return F.coalesce(bound, F.array().cast("array<string>"))


def tokens(normalized: Column) -> Column:
    return F.filter(F.split(normalized, " "), lambda t: t != "")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets: 1 if both are empty, 0 if one is."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(both / F.size(F.array_union(a, b)))


def first_hit(c: Column, table: Sequence[tuple[str, str]]) -> Column:
    """The value of the first key, in the table's order, that the text contains."""
    return F.coalesce(*[F.when(F.contains(c, F.lit(k)), F.lit(v)) for k, v in table])


def exact_or_hit(c: Column, table: Sequence[tuple[str, str]]) -> Column:
    """An exact look-up after zero-width characters and trailing marks go; else ``first_hit``."""
    t = F.regexp_replace(c, r"[\x{200B}-\x{200D}\x{FEFF}]", "")
    t = strip(F.rtrim(F.rtrim(strip(t), F.lit(".")), F.lit(",")))
    exact = F.coalesce(*[F.when(t == k, F.lit(v)) for k, v in table])
    return F.when(F.coalesce(c, F.lit("")) != "", F.coalesce(exact, first_hit(t, table)))


def padded_id(prefix: Column | str, number: Column, width: int) -> Column:
    """PREFIX-007; longer numbers are not cut."""
    n = number.cast("string")
    p = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.concat_ws("-", p, F.when(F.length(n) < width, F.lpad(n, width, "0")).otherwise(n))


def labelled(parts: Sequence[tuple[str, Column]], sep: str = "; ") -> Column:
    """``label value`` of the parts that hold something, joined; null if none does."""
    joined = F.concat_ws(sep, *[F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(k), v)) for k, v in parts])
    return F.nullif(joined, F.lit(""))


def title_case(name: str) -> str:
    return name.replace("_", " ").title()


def markdown_value(c: Column, kind: str) -> Column:
    """One value as inline Markdown; blank ones show a dash."""
    if kind.startswith("array"):
        v = F.when(F.size(c) > 0, F.array_join(c, ", "))
    elif kind.startswith("struct"):
        fields = [f.split(":")[0] for f in kind[len("struct<") : -1].split(",")]
        v = F.when(c.isNotNull(), F.concat_ws("; ", *[F.concat(F.lit(f"{f}: "), F.coalesce(c[f].cast("string"), F.lit("None"))) for f in fields]))
    elif kind.startswith("map"):
        v = F.when(F.size(c) > 0, F.array_join(F.transform(F.map_entries(c), lambda e: F.concat(e.key, F.lit(": "), F.coalesce(e.value.cast("string"), F.lit("None")))), "; "))
    else:
        v = F.replace(F.nullif(c.cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    return F.coalesce(v, F.lit(BLANK))


def markdown_block(c: Column) -> Column:
    """A text; fenced if it has several lines."""
    t = F.nullif(c, F.lit(""))
    return F.coalesce(F.when(F.contains(t, F.lit("\n")), F.concat(F.lit("```\n"), t, F.lit("\n```"))).otherwise(t), F.lit(BLANK))


def preview(c: Column, n: int = 100, more: str = "...") -> Column:
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit(more))).otherwise(c)


def json_in_text(c: Column) -> Column:
    """The JSON in a model's answer, as a variant: the whole answer, else a ``json`` block, else any
    fenced block, else from the first brace to the last; null if the one chosen does not parse."""
    fenced_json = F.regexp_extract(c, r"(?s)```json(.*?)(?:```|$)", 1)
    fenced = F.regexp_extract(c, r"(?s)```(.*?)(?:```|$)", 1)
    chosen = (
        F.when(F.contains(c, F.lit("```json")), strip(fenced_json))
        .when(F.contains(c, F.lit("```")), strip(fenced))
        .otherwise(F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit("")))
    )
    return F.coalesce(F.try_parse_json(c), F.try_parse_json(chosen))


def without_thinking(content: Column, fallback: Column) -> Column:
    """An answer without its ``<think>`` blocks; the fallback, if nothing is left."""
    cut = lambda x: strip(F.regexp_replace(x, r"(?is)<think>.*?</think>", ""))
    return F.coalesce(F.nullif(cut(content), F.lit("")), F.nullif(cut(fallback), F.lit("")), F.lit(""))


def cost(prompt_tokens: Column, completion_tokens: Column, per_million_in: float = 0.2, per_million_out: float = 0.8) -> Column:
    return prompt_tokens * F.lit(per_million_in) / F.lit(1e6) + completion_tokens * F.lit(per_million_out) / F.lit(1e6)


def slug(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(c), r"(?U)\s+", "_"), "[^a-z_]", "")


def clamp(c: Column, low: int, high: int) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def extras(m: Column, known: Sequence[str]) -> Column:
    """What a map holds under other keys, as JSON; empty text if nothing."""
    rest = F.map_filter(m, lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest)).otherwise(F.lit(""))


def megabytes(size: Column) -> Column:
    return F.round(size / F.lit(1048576), 2)


def definition_lines(c: Column, most: int = 5, long: int = 500, head: int = 280) -> Column:
    """Dictionary lines worth showing: trimmed, not tiny, not a heading; walls of text are cut.
    If none is left, the head of the text."""
    t = strip(c)
    lines = F.filter(F.transform(F.split(t, r"\n+"), strip), lambda x: (F.length(x) >= 5) & ~x.rlike(r"^[=#\-\s]+$"))
    shown = F.slice(F.transform(lines, lambda x: F.when(F.length(x) > long, F.concat(strip(F.substring(x, 1, head)), F.lit("…"))).otherwise(x)), 1, most)
    whole = F.when(F.size(shown) > 0, shown).otherwise(F.array(strip(F.substring(t, 1, head))))
    return F.when(F.coalesce(t, F.lit("")) != "", whole).otherwise(F.array().cast("array<string>"))


def count_literal(c: Column, literal: str) -> Column:
    """How often a literal stands in a text, not overlapping."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(literal), F.lit("")))) / F.lit(len(literal))).cast("long")


def attributed(part: Column, author: str, parts: Sequence[int]) -> Column:
    """The author of some parts of a text; empty for the others."""
    return F.when(part.isin(*parts), F.lit(author)).otherwise(F.lit(""))
