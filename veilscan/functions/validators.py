"""Checksums and masks of personal numbers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocab as V


def only_digits(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)\D+", "")


def _weighted(digits: Column, weights: list[int]) -> Column:
    """Sum of the first digits times weights."""
    return sum((F.substring(digits, i + 1, 1).cast("int") * w for i, w in enumerate(weights)), F.lit(0))


def luhn_ok(value: Column) -> Column:
    """Luhn check of 13 to 19 digits; anything else in the value is ignored."""
    d = only_digits(value)
    return F.char_length(d).between(13, 19) & F.call_function("luhn_check", d)


def snils_ok(value: Column) -> Column:
    """11 digits, not all alike, whose last two are the control number."""
    d = only_digits(value)
    total = _weighted(d, list(range(9, 0, -1)))
    control = F.when(total < 100, total).otherwise(total % 101 % 100)
    return F.when(d.rlike(r"\A[0-9]{11}\z") & ~d.rlike(r"\A(.)\1{10}\z"), control == F.substring(d, 10, 2).cast("int")).otherwise(False)


#: Weights of the check digits (fixed values); each control is the weighted sum modulo 11 modulo 10.
INN_10 = [2, 4, 10, 3, 5, 9, 4, 6, 8]
INN_12_FIRST = [7, *INN_10]
INN_12_SECOND = [3, *INN_12_FIRST]


def inn_ok(value: Column) -> Column:
    """10 digits with one check digit or 12 with two."""
    d = only_digits(value)

    def holds(weights: list[int]) -> Column:
        return _weighted(d, weights) % 11 % 10 == F.substring(d, len(weights) + 1, 1).cast("int")

    return F.when(d.rlike(r"\A[0-9]{10}\z"), holds(INN_10)).when(d.rlike(r"\A[0-9]{12}\z"), holds(INN_12_FIRST) & holds(INN_12_SECOND)).otherwise(False)


def short_hash(value: Column) -> Column:
    return F.substring(F.sha2(value.cast("binary"), 256), 1, 12)


def mask(category: str, value: Column) -> Column:
    """What a report may show of a value."""
    v = F.btrim(value)
    if category == "email":
        at = F.instr(v, "@")
        return F.when((at > 0) & (at < F.char_length(v)), F.concat(F.substring(F.substring_index(v, "@", 1), 1, 2), F.lit("***@"), F.substring(v, at + 1, F.char_length(v)))).otherwise(short_hash(v))
    if category == "foreign_id_document":
        return F.lit("identity_document_marker")
    if category in V.DIGIT_MASKED:
        d = only_digits(v)
        return F.when(F.char_length(d) <= 4, F.repeat(F.lit("*"), F.char_length(d))).otherwise(F.concat(F.substring(d, 1, 2), F.lit("***"), F.substring(d, -2, 2)))
    if category == "full_name":
        return F.array_join(F.transform(F.split(v, r"(?U)\s+"), lambda p: F.concat(F.substring(p, 1, 1), F.lit("***"))), " ")
    return F.when(F.char_length(v) <= 4, "***").otherwise(F.concat(F.substring(v, 1, 2), F.lit("***"), F.substring(v, -1, 1)))
