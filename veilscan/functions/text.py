"""Columns on text: where a pattern matches, windows around matches, phrases, and normalisation."""

from __future__ import annotations

import operator
import unicodedata
import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab as V


def settled(df: DataFrame) -> DataFrame:
    """df, which the optimizer neither merges with what stands above it nor pushes filters into.

    Detection and scoring are deep trees of shared steps; a filter rewritten through them would copy every step again.
    Counting rows on the way is such a barrier: no rows move, nothing is stored, and each tree is planned by itself.
    """
    return df.observe(f"settled-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows"))


SPAN = "array<struct<value:string,start:int,end:int>>"


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """All matches of a pattern, or of one of its groups."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def located(text: Column, pattern: str, gate: Column | None = None) -> Column:
    """Matches with start and end in characters.  Spark has no match offsets: a match starts after the gaps and the matches before it.

    gate: a cheap condition that every text with a match meets.
    """
    parts = F.arrays_zip(found(text, pattern).alias("value"), F.split(text, pattern, -1).alias("gap"))
    parts = F.filter(parts, lambda p: p["value"].isNotNull())

    def step(acc: Column, p: Column) -> Column:
        start = acc["at"] + F.char_length(p["gap"])
        end = start + F.char_length(p["value"])
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(p["value"].alias("value"), start.alias("start"), end.alias("end"))).cast(SPAN)).alias("out"))

    spans = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out")), step, lambda acc: acc["out"])
    hit = text.rlike(pattern) if gate is None else gate & text.rlike(pattern)
    return F.when(hit, spans).otherwise(F.array().cast(SPAN))


def window(text: Column, span: Column, around: int) -> Column:
    """The match with so many characters before and after it, lower-cased."""
    a = F.greatest(span["start"] - around, F.lit(0))
    return F.lower(F.substring(text, a + 1, span["end"] + around - a))


def before(text: Column, span: Column, around: int) -> Column:
    a = F.greatest(span["start"] - around, F.lit(0))
    return F.lower(F.substring(text, a + 1, span["start"] - a))


def line_of(text: Column, span: Column) -> Column:
    """The line, or lines, that a match is in, lower-cased."""
    head = F.substring_index(F.substring(text, F.lit(1), span["start"]), "\n", -1)
    tail = F.substring_index(F.substring(text, span["end"] + 1, F.char_length(text)), "\n", 1)
    return F.lower(F.concat(head, span["value"], tail))


def any_of(text: Column, phrases: Iterable[str]) -> Column:
    """Whether any phrase is in the text.  Plain searches, one after another, are faster than a regex of alternatives."""
    return reduce(operator.or_, (text.contains(p) for p in phrases))


def present(text: Column, phrases: Iterable[str]) -> Column:
    """How many of the phrases are in the text."""
    return sum((F.contains(text, F.lit(p)).cast("int") for p in phrases), F.lit(0))


def occurrences(text: Column, phrase: str) -> Column:
    """How often a phrase is in the text, without overlaps."""
    lost = F.char_length(text) - F.char_length(F.replace(text, F.lit(phrase), F.lit("")))
    return F.when(F.contains(text, F.lit(phrase)), (lost / len(phrase)).cast("int")).otherwise(0)


def unique_trimmed(values: Column) -> Column:
    """Values without white space at their ends, blank ones and repeats dropped, order kept."""
    cut = F.transform(values, lambda v: F.regexp_replace(v, r"(?U)^\s+|\s+$", ""))
    return F.array_distinct(F.filter(cut, lambda v: v != ""))


#: Letters up to U+017F that are one ASCII letter without their marks.
_MARKED = {c: k for c in map(chr, [0xAA, 0xBA, *range(0xC0, 0x180)]) if len(k := unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()) == 1}


def unmarked(text: Column) -> Column:
    """Common marked letters without their marks."""
    return F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, "".join(_MARKED), "".join(_MARKED.values()))).otherwise(text)


def _tree(words: Iterable[str]) -> str:
    """A regex of whole words (letters only, none before its own beginning) that shares beginnings: tried letter by letter, not word by word."""
    by_letter: dict[str, list[str]] = {}
    for w in words:
        by_letter.setdefault(w[:1], []).append(w[1:])
    ends = by_letter.pop("", None) is not None
    rest = "|".join(c + _tree(tails) for c, tails in sorted(by_letter.items()))
    return "" if not rest else f"(?:{rest})" + ("?" if ends else "") if ends or len(by_letter) > 1 else rest


#: What matches i, s and k in any case besides their capitals.
_ODD, _EVEN = "İıſK", "iisk"
_FIRST = sorted({w[0] for w in V.LOST_LIGATURES})
#: Words that lost a ligature, in any case.  Their first letters are looked for first, as word boundaries are dear.
_LOST = rf"(?U)(?=[{''.join(_FIRST)}{''.join(_FIRST).upper()}{_ODD}])\b(?i:{_tree(V.LOST_LIGATURES)})\b"


def normalize(text: Column) -> Column:
    """Ligatures spelled out, NUL removed between letters and blank elsewhere, white space collapsed, at most one blank line, lost ligatures repaired, trimmed."""
    out = text
    for glyph, letters in V.LIGATURES.items():
        out = F.replace(out, F.lit(glyph), F.lit(letters))
    out = F.regexp_replace(out, r"\x00(?<=[A-Za-zА-Яа-яЁё]\x00)(?=[A-Za-zА-Яа-яЁё])", "")
    out = F.replace(out, F.lit("\x00"), F.lit(" "))
    out = F.regexp_replace(out, r"[\t\r\f\x0B][ \t\r\f\x0B]*| [ \t\r\f\x0B]+", " ")
    out = F.regexp_replace(out, r"\n{3,}", "\n\n")
    return F.regexp_replace(repair_ligatures(out), r"(?U)\A\s+|\s+\z", "")


def needs_ligature_repair(text: Column) -> Column:
    """Two or more words that lost a ligature in the first 20,000 characters."""
    return F.regexp_count(F.substring(text, 1, 20_000), F.lit(_LOST)) >= 2


def repair_ligatures(text: Column) -> Column:
    """Words that lost fi, fl or ff get it back, in the case they have: three replacements for each such word of a text, run only where needed."""
    table = F.create_map(*(F.lit(x) for pair in V.LOST_LIGATURES.items() for x in pair))
    lost = F.array_distinct(F.transform(found(text, _LOST), lambda w: F.lower(F.translate(w, _ODD, _EVEN))))
    begin, end = F.lit(r"(?U)\b"), F.lit(r"\b")

    def fix(fixed: Column, bad: Column) -> Column:
        good, first, rest = F.element_at(table, bad), F.substring(bad, 1, 1), F.concat(F.lit("(?i:"), F.substr(bad, F.lit(2)), F.lit(")"))
        # capitals first, then a capital initial, then any other case
        fixed = F.regexp_replace(fixed, F.concat(begin, F.upper(bad), end), F.upper(good))
        fixed = F.regexp_replace(fixed, F.concat(begin, F.upper(first), rest, end), F.concat(F.upper(F.substring(good, 1, 1)), F.substr(good, F.lit(2))))
        return F.regexp_replace(fixed, F.concat(begin, first, rest, end), good)

    return F.when(needs_ligature_repair(text), F.aggregate(lost, text, fix)).otherwise(text)


def truncate(text: Column, most: int = 5_000_000) -> Column:
    return F.substring(text, 1, most)


def file_id(relative_path: Column) -> Column:
    """A readable, unique name for a path: slug and the start of the path's SHA-1."""
    path = F.replace(relative_path, F.lit("\\"), F.lit("/"))
    slug = F.substring(F.btrim(F.regexp_replace(path, r"[^A-Za-zА-Яа-я0-9._-]+", "__"), F.lit("._")), 1, 120)
    return F.concat(F.when(slug == "", "file").otherwise(slug), F.lit("__"), F.substring(F.sha1(path.cast("binary")), 1, 12))


def report_path(path: Column) -> Column:
    """Forward slashes and exactly one at the start."""
    return F.concat(F.lit("/"), F.ltrim(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/")))


def escape_markdown(value: Column) -> Column:
    return F.replace(F.replace(value, F.lit("|"), F.lit("\\|")), F.lit("\n"), F.lit(" "))


def extension_of(path: Column) -> Column:
    """Lower-cased suffix with its dot; '' where a name has none or only a leading or a trailing dot."""
    name = F.substring_index(path, "/", -1)
    return F.lower(F.regexp_extract(name, r"(?s)[^.].*?(\.[^.]+)\z", 1))
