"""The numbers and flags that risk rules use, from a row's categories."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V


def _listed(categories: Iterable[str]) -> str:
    return "array(" + ", ".join(f"'{c}'" for c in categories) + ")"


def has(*categories: str) -> Column:
    """Whether any of these categories was found (column names: the keys of categories)."""
    return F.expr(f"arrays_overlap(names, {_listed(categories)})")


def has_all(*categories: str) -> Column:
    return F.expr(f"size(array_except({_listed(categories)}, names)) = 0")


def only(categories: Iterable[str]) -> Column:
    """Whether nothing but these categories was found."""
    return F.expr(f"size(array_except(names, {_listed(categories)})) = 0")


def kinds(categories: Iterable[str]) -> Column:
    """How many of these categories were found."""
    return F.expr(f"size(array_intersect(names, {_listed(categories)}))")


def total(categories: Iterable[str] | None = None) -> Column:
    """Sum of counts over these categories, or all."""
    counted = "categories" if categories is None else f"map_filter(categories, (k, v) -> array_contains({_listed(categories)}, k))"
    return F.expr(f"aggregate(map_values({counted}), 0, (s, x) -> s + x.count)")


def half_even(x: Column, digits: int) -> Column:
    """x rounded as Python rounds: to the decimal nearest to the double's exact value, exact ties to even.

    The double product x * 10**digits may land on a tie that the exact one misses; the error of the product, which
    splitting x in two halves of 26 bits makes exact, decides there.
    """
    scale = float(10**digits)
    wide = x * 134217729.0  # 2**27 + 1
    high = wide - (wide - x)
    product = x * scale
    error = (high * scale - product) + (x - high) * scale
    down = F.floor(product).cast("double")
    beyond = product - (down + 0.5)
    up = (beyond > 0) | ((beyond == 0) & ((error > 0) | ((error == 0) & (F.abs(down) % 2 == 1))))
    return (down + F.when(up, 1.0).otherwise(0.0)) / scale


SENSITIVE = (*V.DIRECT, "bank_card", "cvv", *V.SPECIAL_FEATURES)


def with_features(detected: DataFrame, text_col: str = "text", extension_col: str = "extension", size_col: str = "size_bytes", ocr: Column | None = None) -> DataFrame:
    """detected with names (its categories, sorted) and features.  ocr: whether a text came from character recognition."""
    ext = F.coalesce(F.col(extension_col), F.lit(""))
    step = detected.withColumn("names", F.array_sort(F.map_keys("categories")))
    length = F.char_length(F.coalesce(F.col(text_col), F.lit("")))
    step = step.withColumns({"total_": total(), "weak_": total(V.WEAK), "length_": length})
    value = F.greatest(F.col("total_") - F.col("weak_"), F.lit(0))
    thousands = F.greatest(F.col("length_"), F.lit(1)) / F.lit(1000.0)
    name, strong = F.array_contains("names", "full_name"), has(*V.DIRECT)
    identity = (*V.DIRECT, *V.DEMOGRAPHIC, *V.CONTACT, "bank_card")
    columns = {
        "has_passport_and_snils": has_all("passport_rf", "snils"),
        "has_government_id_bundle": has("passport_rf", "foreign_id_document", "snils", "driver_license", "mrz") & (name | (kinds(V.DIRECT) >= 2)),
        "has_card_and_phone": has_all("bank_card", "phone"),
        "has_payment_bundle": has("bank_card", "cvv") | has_all("bank_account", "bik"),
        "has_contact_bundle": name & (kinds(V.CONTACT) >= 2),
        "has_full_identity_bundle": name & (has_all("passport_rf", "snils") | (strong & has("birth_date", "address", "phone", "email")) | (kinds(identity) >= 4)),
        "unique_persons": F.col("signals.unique_persons"),
        "total_findings": F.col("total_"),
        "value_findings": value,
        "weak_keyword_findings": F.col("weak_"),
        "sensitive_findings": total(SENSITIVE),
        "direct_identifier_findings": total(V.DIRECT),
        "contact_findings": total(V.CONTACT),
        "financial_findings": total(V.FINANCIAL),
        "category_count": F.size("names"),
        "sensitive_category_count": kinds(SENSITIVE),
        "text_length": F.col("length_"),
        "file_size_bytes": F.col(size_col).cast("bigint"),
        "is_structured": ext.isin(*V.RISK_TABLES),
        "is_image_or_scan": ext.isin(*V.SCAN_EXT) | ((ext == ".pdf") & (F.lit(False) if ocr is None else F.coalesce(ocr, F.lit(False)))),
        "pdn_density": half_even(F.col("total_") / thousands, 3),
        "value_pdn_density": half_even(value / thousands, 3),
    }
    return step.withColumn("features", F.struct(*(c.alias(k) for k, c in columns.items()))).drop("total_", "weak_", "length_")
