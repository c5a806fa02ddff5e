"""Reading header lines: setting, genre, poet, speaker, attribution."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import block_text, clean_text, first_hit, has_script, strip

# The spellings of the settings in headers, in the order in which they are tried.
SETTINGS = [
    ("குறிஞ்சி", "Kurinji"), ("குறிஞ்சித் திணை", "Kurinji"), ("குறிஞ்சித்திணை", "Kurinji"),
    ("முல்லை", "Mullai"), ("முல்லைத் திணை", "Mullai"), ("முல்லைத்திணை", "Mullai"),
    ("மருதம்", "Marutham"), ("மருதத் திணை", "Marutham"), ("மருதத்திணை", "Marutham"),
    ("நெய்தல்", "Neytal"), ("நெய்தல் திணை", "Neytal"), ("நெய்தல்த் திணை", "Neytal"), ("நெய்தல்த்திணை", "Neytal"), ("நெய்தற் திணை", "Neytal"), ("நெய்தற்திணை", "Neytal"),
    ("பாலை", "Palai"), ("பாலைத் திணை", "Palai"), ("பாலைத்திணை", "Palai"),
    ("கைக்கிளை", "Kaikkilai"), ("கைக்கிளைத் திணை", "Kaikkilai"), ("பெருந்திணை", "Peruntinai"),
]
# The seven plain setting names.
SETTING_NAMES = [("குறிஞ்சி", "Kurinji"), ("முல்லை", "Mullai"), ("மருதம்", "Marutham"), ("நெய்தல்", "Neytal"), ("பாலை", "Palai"), ("கைக்கிளை", "Kaikkilai"), ("பெருந்திணை", "Peruntinai")]
# Speakers named in headers, in order; the last two are no schema values.
SPEAKERS = [
    ("தலைவி", "talaivi"), ("தலைவன்", "talaivan"), ("தோழி", "tozi"), ("செவிலி", "cevilittay"), ("நற்றாய்", "nattay"),
    ("பாணன்", "panan"), ("விறலி", "virali"), ("கண்டோர்", "kantor"), ("பரத்தை", "parattai"), ("நுதலி", "nuttay"),
]
# English phrases tried after those, in order.
SPEAKERS_ENGLISH = [
    ("heroine's friend", "tozi"), ("friend of the heroine", "tozi"), ("heroine", "talaivi"), ("hero's friend", "panan"),
    ("hero", "talaivan"), ("foster mother", "cevilittay"), ("bard", "panan"),
]
SAME = "(same as previous)"


def _group(c: Column, pattern: str, k: int) -> Column:
    """A group of the first match; null where the pattern does not match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, k))


def _or_empty(*cs: Column) -> Column:
    return F.coalesce(*cs, F.lit(""))


def setting_and_genre(raw: Column) -> Column:
    """struct(tinai, turai) of a header: ``N. x[y]``, then ``N. x``, then labelled lines."""
    t = strip(F.replace(raw, F.lit("\u00a0"), F.lit(" ")))
    bare = lambda c: F.rtrim(strip(c), F.lit("."))
    bracketed, plain = r"(?U)^\s*\d+\.\s*([^\[]+?)\s*\[([^\]]+)\]", r"(?U)^\s*\d+\.\s*([^\n]+)$"
    label = lambda p: F.rtrim(strip(_group(t, p, 1)), F.lit(";"))
    tinai = F.when(t.rlike(bracketed), bare(_group(t, bracketed, 1))).when(t.rlike(plain), bare(_group(t, plain, 1))).otherwise(label(r"(?U)தி[ணன]ை[:\s]*([^\n.]+)"))
    turai = F.when(t.rlike(bracketed), bare(_group(t, bracketed, 2))).when(t.rlike(plain), F.lit("")).otherwise(label(r"(?U)துறை[:\s]*([^\n.]+)"))
    return F.struct(_or_empty(tinai).alias("tinai"), _or_empty(turai).alias("turai"))


def attribution_line(line: Column) -> Column:
    """struct(tinai, turai, poet, subject) of a labelled attribution line. A line that says "as
    before" gives the marker ``SAME``."""
    t = strip(F.regexp_replace(clean_text(line), r"^\*+", ""))
    same_both = t.rlike(r"(?U)திணை\s*யு[ம்ந]\s*துறை\s*யு\s*ம?\s*அவை") | F.contains(t, F.lit("திணையும் துறையும் அவை"))
    same_one = t.rlike(r"(?U)திணை\s*:\s*அது")
    tidy = lambda c: strip(F.regexp_replace(strip(F.rtrim(strip(c), F.lit(";"))), r"(?U)^[-:\s]+", ""))
    tinai = tidy(_group(t, r"(?U)திணை[-:\s]*([^;.]+?)(?:[;.]|\s*துறை)", 1))
    tinai = F.when((F.length(tinai) >= 3) & ~F.contains(tinai, F.lit("அவை")), tinai)
    loose = tidy(_group(t, r"(?U)துறை[-:\s]*([^.;]+)", 1))
    turai = tidy(_group(t, r"(?U)துறை[-:\s]*([^.;]+?)(?:[.;]|$)", 1))
    wrote = F.lit("பாடியது")
    turai = F.when((F.length(turai) > 2) & ~F.contains(turai, F.lit("அவை")) & ~F.contains(turai, F.lit("மவை")) & ~F.contains(turai, wrote), turai)
    named = _group(t, r"(?U)(\S+(?:\s+\S+){0,5}?)\s+பாடியது", 1)
    words = F.filter(F.split(strip(named), r"(?U)\s+"), lambda w: w != "")
    # Who is sung of ends in an accusative; the poet's name follows.
    at = F.array_position(F.transform(words, lambda w: w.rlike("(யை|னை|ளை)$")), True).cast("int")
    short = F.size(words) <= 3
    poet = F.when(short, strip(named)).when(at > 0, F.array_join(F.slice(words, at + 1, F.greatest(F.size(words) - at, F.lit(0))), " ")).otherwise(F.array_join(F.slice(words, F.size(words) - 1, F.lit(2)), " "))
    subject = F.when(~short & (at > 0), F.array_join(F.slice(words, F.lit(1), at), " "))
    return F.struct(
        F.when(same_both | same_one, F.lit(SAME)).otherwise(_or_empty(tinai)).alias("tinai"),
        F.when(same_both, F.lit(SAME)).when(same_one, _or_empty(loose)).otherwise(_or_empty(turai)).alias("turai"),
        F.when(named.isNotNull(), _or_empty(poet)).otherwise(F.lit("")).alias("poet"),
        _or_empty(F.when(named.isNotNull(), subject)).alias("subject"),
    )


def resolved(c: Column) -> Column:
    """A value, or null where it says "as before" (or nothing)."""
    return F.when((c != "") & (c != SAME), c)


def poet_at_end(html: Column) -> Column:
    """``- Name.`` at the end of a block, if it looks like a name; else empty."""
    who = strip(_group(block_text(html), r"(?U)-\s*([^\n.]+?)\.\s*$", 1))
    return _or_empty(F.when((F.length(who) > 3) & (F.length(who) < 80) & has_script(who), who))


def poet_in_header(header: Column) -> Column:
    """The second comma part, cut at the first setting name that it contains."""
    part = strip(F.get(F.split(header, ","), F.lit(1)))
    cut = part
    for name, _ in reversed(SETTINGS):
        at = F.instr(part, name)
        trimmed = strip(F.rtrim(strip(F.rtrim(strip(F.substr(part, F.lit(1), at - 1)), F.lit(","))), F.lit("–")))
        cut = F.when(at > 0, trimmed).otherwise(cut)
    return F.when(F.length(cut) > 1, cut)


def setting_in_header(header: Column) -> Column:
    return first_hit(header, SETTINGS)


def speaker_in_header(header: Column) -> Column:
    return F.coalesce(first_hit(header, SPEAKERS), first_hit(F.lower(header), SPEAKERS_ENGLISH))
