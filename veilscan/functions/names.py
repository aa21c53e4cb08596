"""Which capitalised word pairs and triples are people's names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def candidate(value: Column) -> Column:
    """Blanks collapsed, punctuation at the ends cut."""
    return F.btrim(F.regexp_replace(value, r"(?U)\s+", " "), F.lit(" ,.;:()[]{}"))


def folded(word: Column) -> Column:
    return F.btrim(F.translate(F.lower(word), "ё", "е"), F.lit("-"))


def first_name(word: Column) -> Column:
    return word.isin(V.FIRST_NAMES)


def surname(word: Column) -> Column:
    return word.rlike(V.SURNAME_END)


def patronymic(word: Column) -> Column:
    return word.rlike(V.PATRONYMIC_END)


def likely_name(value: Column) -> Column:
    """Two words, a first name and a surname in either order; or surname, first name, patronymic.  No stop word."""
    words = F.transform(F.split(value, " "), folded)
    one, two, three = (F.get(words, F.lit(i)) for i in range(3))
    pair = (F.size(words) == 2) & ((first_name(one) & surname(two)) | (surname(one) & first_name(two)))
    triple = (F.size(words) == 3) & surname(one) & first_name(two) & patronymic(three)
    return (pair | triple) & ~F.arrays_overlap(words, F.lit(list(V.NAME_STOPWORDS)))


def people(values: Column) -> Column:
    """The matches that are names, tidied."""
    return F.filter(F.transform(values, candidate), likely_name)


def person_key(value: Column) -> Column:
    """One spelling for each person."""
    return F.translate(F.lower(F.btrim(F.regexp_replace(value, r"(?U)\s+", " "))), "ё", "е")
