"""How good an extracted text is, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.text import any_of, occurrences

LETTERS, LATIN, CYRILLIC = "[A-Za-zА-Яа-яЁё]", "[A-Za-z]", "[А-Яа-яЁё]"


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def lost_ligatures(text: Column) -> Column:
    """An English text of at least 500 letters in which three or more words lack fi, fl or ff."""
    sample = F.substring(text, 1, 20_000)
    letters = _count(sample, LETTERS)
    hits = sum((_count(F.lower(sample), f"(?U){p}") for p in V.LIGATURE_LOSS), F.lit(0))
    return (letters >= 500) & (_count(sample, LATIN) / F.greatest(letters, F.lit(1)) >= 0.75) & (hits >= 3)


def garbled_ocr(text: Column) -> Column:
    """Recognised text that mixes alphabets so much that rules on it mean nothing."""
    sample = F.substring(text, 1, 5000)
    letters = _count(sample, LETTERS)
    latin, cyrillic = (_count(sample, p) / F.greatest(letters, F.lit(1)) for p in (LATIN, CYRILLIC))
    low = F.lower(sample)
    markers = sum((occurrences(low, m) for m in V.GARBLED_MARKERS), F.lit(0))
    tokens = F.regexp_extract_all(sample, F.lit("[A-Za-zА-Яа-яЁё0-9]{5,}"), F.lit(0))
    numbered = F.size(F.filter(tokens, lambda t: t.rlike("[0-9]") & t.rlike(LATIN)))
    mixed = F.size(F.filter(tokens, lambda t: (t.rlike(LATIN) & t.rlike(CYRILLIC)) | (t.rlike("[0-9]") & t.rlike(LETTERS))))
    russian = any_of(low, V.RUSSIAN_HINTS)
    return (letters >= 200) & (
        (markers >= 3)
        | ((latin > 0.85) & (cyrillic < 0.08) & (markers >= 2) & (numbered >= 3))
        | (russian & (latin > 0.45) & (cyrillic < 0.45))
        | (russian & (mixed >= 20) & (latin > 0.35))
    )


def ocr_score(text: Column) -> Column:
    """Worth of a recognised text: words of three letters, digits and letters count for it, symbols against."""
    t = F.regexp_replace(text, r"(?U)\A\s+|\s+\z", "")
    words = F.size(F.filter(F.split(t, r"(?U)\s+"), lambda w: _count(w, r"\p{L}") >= 3))
    alnum, digits = _count(t, r"[\p{L}\p{N}]"), _count(t, r"\p{Nd}")
    symbols = _count(t, r"(?U)[^\p{L}\p{N}\s]")
    return F.when(F.char_length(t) < 12, 0).otherwise(words * 12 + digits * 2 + alnum + _count(t, "\n") - symbols * 3)


def fingerprint(text: Column) -> Column:
    """The first 120 letters and digits, lower-cased; '' if there are fewer than 20."""
    t = F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}]", ""))
    return F.when(F.char_length(t) < 20, "").otherwise(F.substring(t, 1, 120))
