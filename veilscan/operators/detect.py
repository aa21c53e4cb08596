"""Finds personal data in a row's text and path.

detect() adds three columns to files with relative_path, extension, size_bytes and text:
categories  map of category to (count, up to three masked samples)
validation  map of checked number to (candidates, valid, rejected)
signals     passport_context, foreign_document, unique_persons
Every step is a projection: no shuffle, no Python (but for the folding of foreign letters, see ascii_fold).
Null texts and paths count as empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import names, validators
from ..functions import vocab as V
from ..functions.text import any_of, before, found, line_of, located, present, settled, unique_trimmed, unmarked, window

FINDING = "struct<count:int,samples_masked:array<string>>"
STRINGS = "array<string>"
NONE = F.array


def technical(text: Column, span: Column) -> Column:
    """Hex runs, URL escapes or words such as uuid within 40 characters."""
    return window(text, span, 40).rlike(V.TECHNICAL)


def other_number_line(text: Column, span: Column) -> Column:
    """The line is about a legal or bank number or a telephone and not about a passport."""
    line = line_of(text, span)
    legal = line.rlike(V.LEGAL_LINE)
    return F.when(line.rlike(V.PASSPORT_WORD), legal & ~line.rlike(V.SERIES_OR_NUMBER)).otherwise(legal | line.rlike(V.CONTACT_LINE))


def blank_template(text: Column, span: Column) -> Column:
    """A form: bank words, or at least two placeholders and two passport fields.

    Windows are lower case, so a filled-in name, which has capitals, can't be told here; forms with names count as blank.
    """
    near = window(text, span, 180)
    return near.rlike(V.BANK_TEMPLATE) | ((F.regexp_count(near, F.lit(V.PLACEHOLDER)) >= 2) & (present(near, V.TEMPLATE_PHRASES) >= 2))


def passport_nearby(text: Column, span: Column) -> Column:
    """What stands around a ten-digit number says that it is a passport's."""
    near = window(text, span, 220)
    series, number = near.rlike(V.SERIES_WORD), near.rlike(V.NUMBER_WORD)
    issuer = present(near, V.ISSUER_PHRASES) > 0
    person = (present(near, V.PERSON_PHRASES) > 0) | near.rlike(r"(?U)\bимя\b")
    label = before(text, span, 35).rlike(V.PASSPORT_LABEL)
    told = label | (near.rlike(V.PASSPORT_WORD) & (series | number | issuer | person)) | ((series | number) & issuer & person)
    return ~blank_template(text, span) & told


def is_passport(text: Column, span: Column) -> Column:
    spaced = F.regexp_replace(F.btrim(span["value"]), r"(?U)\s+", " ").rlike(r"(?U)\A(?:\d{4} \d{6}|\d{2} \d{2} \d{6})\z")
    return ~validators.inn_ok(span["value"]) & spaced & ~technical(text, span) & ~other_number_line(text, span) & passport_nearby(text, span)


def is_card(text: Column, span: Column) -> Column:
    """Passes Luhn, isn't four years, and stands near a word for cards."""
    digits = validators.only_digits(span["value"])
    # Four groups of four digits, as written; groups that run together are cut every four.
    years = digits.rlike(r"\A(?:(?:19|20)[0-9]{2}){4}\z")
    return validators.luhn_ok(span["value"]) & ~years & ~technical(text, span) & window(text, span, 100).rlike(V.CARD_WORD)


def is_snils(text: Column, span: Column) -> Column:
    return validators.snils_ok(span["value"]) & ~technical(text, span) & window(text, span, 100).rlike(V.SNILS_WORD)


def passports_in_context(text: Column, low: Column) -> Column:
    """`dddd dddddd` of series and number near the word passport or its fields."""
    none = NONE().cast(STRINGS)

    def numbers(pattern: str, word: str) -> Column:
        hit = low.contains(word) & text.rlike(pattern)
        groups = [F.transform(F.when(hit, found(text, pattern, g)).otherwise(none), validators.only_digits) for g in (1, 2)]
        rows = F.arrays_zip(located(text, pattern, hit).alias("span"), groups[0].alias("series"), groups[1].alias("number"))

        def good(r: Column) -> Column:
            written = (F.char_length(r["series"]) == 4) & (F.char_length(r["number"]) == 6)
            return written & ~validators.inn_ok(F.concat(r["series"], r["number"])) & ~other_number_line(text, r["span"]) & ~blank_template(text, r["span"])

        return F.transform(F.filter(rows, good), lambda r: F.concat(r["series"], F.lit(" "), r["number"]))

    return F.concat(*map(numbers, V.PASSPORT_IN_CONTEXT, ("паспорт", "паспорт", "сер")))


def birth_dates(text: Column, gate: Column) -> Column:
    return F.concat(*(F.when(gate & text.rlike(p), found(text, p, 1)).otherwise(NONE().cast(STRINGS)) for p in V.BIRTH_IN_CONTEXT))


@F.pandas_udf(T.StringType())
def ascii_fold(texts):
    """Letters without their marks, everything else but A-Z a-z 0-9 . / - a blank, lower case: Spark has no Unicode decomposition."""
    import re
    import unicodedata

    def fold(t: str) -> str:
        plain = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode("ascii")
        return " ".join(re.sub(r"[^A-Za-z0-9./-]+", " ", plain).lower().split())

    return texts.map(fold)


def identity_marker(folded: Column) -> Column:
    """The kind of identity document that a folded text names first in the list, or null."""
    return F.coalesce(*(F.when(folded.rlike(p), label) for p, label in V.ID_MARKERS))


def foreign_document(folded: Column, text: Column) -> Column:
    """The marker, where number, or fields with dates, or a Czech card's words confirm it."""
    dates = F.regexp_count(text, F.lit(V.ANY_DATE))
    fields = sum((folded.rlike(p).cast("int") for p in V.ID_FIELDS), F.lit(0))
    czech = folded.rlike(V.ID_CZECH) | (folded.rlike(V.ID_CZECH_STATE) & folded.rlike(V.ID_CZECH_WORD))
    confirmed = (czech & (dates >= 1)) | folded.rlike(V.ID_NUMBER) | ((fields >= 4) & (dates >= 2) & folded.rlike(V.ID_FILLED))
    return F.when(confirmed, identity_marker(folded))


#: Without one of these no marker matches, nor without letters beyond the common ones: keeps the fold from almost all texts.
MARKER_WORDS = ("identity", "dentification", "document", "national", "obcansk")
RARE_LETTERS = r"[^\x{0}-\x{17F}\x{400}-\x{4FF}\x{2010}-\x{2027}]"


def may_name_document(text: Column, low: Column) -> Column:
    return any_of(unmarked(low), MARKER_WORDS) | text.rlike(RARE_LETTERS)


def _in_sql(word: str) -> str:
    return "'" + word.replace("'", "\\'") + "'"


def keyword_count(words: tuple[str, ...]) -> Column:
    """Occurrences of the words in text and path (columns low_ and lowpath_), without overlaps of a word with itself."""
    one = "if(contains({c}, {k}), cast((char_length({c}) - char_length(replace({c}, {k}, ''))) / {n} as int), 0)"
    return F.expr(" + ".join(one.format(c=c, k=_in_sql(w), n=len(w)) for w in words for c in ("low_", "lowpath_")))


def keywords_used(words: tuple[str, ...]) -> Column:
    each = ", ".join(f"if(contains(low_, {_in_sql(w)}) or contains(lowpath_, {_in_sql(w)}), {_in_sql(w.strip())}, null)" for w in words)
    return F.expr(f"filter(array({each}), w -> w is not null)")


def _finding(category: str, values: Column, count: Column | None = None) -> Column:
    return F.struct((F.size(values) if count is None else count).cast("int").alias("count"), F.transform(F.slice(values, 1, 3), lambda v: validators.mask(category, v)).alias("samples_masked")).cast(FINDING)


def _stats(candidates: Column, valid: Column) -> Column:
    return F.struct(candidates.alias("candidates"), valid.alias("valid"), (candidates - valid).alias("rejected"))


def _filled_map(entries: list[tuple[str, Column, Column]], kind: str) -> Column:
    """Map of the entries (key, value, whether it is there)."""
    every = F.array(*(F.when(there, F.struct(F.lit(key).alias("key"), value.alias("value"))) for key, value, there in entries))
    return F.map_from_entries(F.filter(every, lambda e: e.isNotNull())).cast(kind)


def detect(files: DataFrame, text_col: str = "text", path_col: str = "relative_path") -> DataFrame:
    """files with categories, validation and signals."""
    kept = files.columns
    text, path = F.col("t_"), F.col("p_")
    base = files.withColumns({"t_": F.coalesce(F.col(text_col), F.lit("")), "p_": F.coalesce(F.col(path_col), F.lit(""))})
    # The name counts twice among path words: once in the path, once alone.
    base = base.withColumns({"low_": F.lower("t_"), "lowpath_": F.lower(F.concat(path, F.lit(" "), F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)))})
    base = base.withColumns({"digits_": text.rlike(r"\p{Nd}\p{Nd}"), "cyrillic_": text.rlike(r"[\x{400}-\x{4FF}]")})
    digits, cyrillic, low = F.col("digits_"), F.col("cyrillic_"), F.col("low_")
    gates = {
        "email": text.contains("@"), "phone": digits, "inn": digits, "bik": digits & any_of(low, ("бик", "bik")), "bank_account": digits & cyrillic, "cvv": digits & any_of(low, ("cvv", "cvc", "код безопасности")),
        "mrz": any_of(text, ("P<", "ID", "I<")), "full_name": cyrillic,
    }
    plain = {c: F.when(g & text.rlike(V.PATTERNS[c]), found(text, V.PATTERNS[c])).otherwise(NONE().cast(STRINGS)) for c, g in gates.items()}
    spans = {f"s_{c}": located(text, V.PATTERNS[c], digits) for c in ("passport_rf", "snils", "bank_card")}
    born = digits & (cyrillic | any_of(low, ("birth", "dob", "born")))
    # The fold is Python; the gate keeps it to texts that can have a marker.
    step = base.withColumns({f"v_{c}": x for c, x in plain.items()} | spans | {"birth_": birth_dates(text, born), "passports_": passports_in_context(text, low), "gate_": may_name_document(text, low)})
    step = step.withColumn("fold_", ascii_fold(F.when(F.col("gate_"), text).otherwise("")))
    step = step.withColumns(
        {
            "ok_passport": F.transform(F.filter("s_passport_rf", lambda s: is_passport(text, s)), lambda s: s["value"]),
            "ok_snils": F.transform(F.filter("s_snils", lambda s: is_snils(text, s)), lambda s: s["value"]),
            "ok_card": F.transform(F.filter("s_bank_card", lambda s: is_card(text, s)), lambda s: s["value"]),
            "ok_inn": F.filter("v_inn", validators.inn_ok),
            "ok_name": names.people(F.col("v_full_name")),
            "foreign_": F.when(F.col("fold_") != "", foreign_document(F.col("fold_"), text)),
        }
    )
    values = {
        "email": F.col("v_email"), "phone": F.col("v_phone"), "snils": F.col("ok_snils"), "bank_card": F.col("ok_card"), "bik": F.col("v_bik"), "bank_account": F.col("v_bank_account"), "cvv": F.col("v_cvv"), "mrz": F.col("v_mrz"), "full_name": F.col("ok_name"),
        "inn_person": F.filter("ok_inn", lambda v: F.char_length(v) == 12), "inn_legal": F.filter("ok_inn", lambda v: F.char_length(v) == 10), "birth_date": F.col("birth_"), "foreign_id_document": F.filter(F.array("foreign_"), lambda v: v.isNotNull()),
    }
    counts = {f"k_{c}": keyword_count(words) for c, words in V.KEYWORDS.items()}
    counts["k_driver_license"] = F.when((counts["k_driver_license"] > 0) & text.rlike(V.DRIVER_NUMBER), counts["k_driver_license"]).otherwise(0)
    step = step.withColumns({f"u_{c}": unique_trimmed(v) for c, v in values.items()} | {"u_number": unique_trimmed(F.col("ok_passport")), "u_context": unique_trimmed(F.col("passports_"))} | counts)

    entries = [(c, _finding(c, F.col(f"u_{c}")), F.size(f"u_{c}") > 0) for c in values]
    # Found twice, a category has the larger count and the first three samples of both.
    both = F.greatest(F.size("u_number"), F.size("u_context"))
    samples = F.concat(F.transform(F.slice("u_number", 1, 3), lambda v: validators.mask("passport_rf", v)), F.transform(F.slice("u_context", 1, 3), lambda v: validators.mask("passport_rf", v)))
    merged = F.when(F.size("u_number") == 0, F.slice(samples, 1, 3)).when(F.size("u_context") == 0, F.slice(samples, 1, 3)).otherwise(F.slice(_merge(samples, F.least(F.size("u_number"), F.lit(3))), 1, 3))
    entries.append(("passport_rf", F.struct(both.cast("int").alias("count"), merged.alias("samples_masked")).cast(FINDING), both > 0))
    for c, words in V.KEYWORDS.items():
        used = keywords_used(words)
        entries.append((c, _finding(c, used, F.col(f"k_{c}")), F.col(f"k_{c}") > 0))
    checked = (("snils", "s_snils", "ok_snils"), ("passport_rf_generic", "s_passport_rf", "ok_passport"), ("inn", "v_inn", "ok_inn"))
    stats = [(k, _stats(F.size(a), F.size(b)), F.size(a) > 0) for k, a, b in checked]
    signals = F.struct((F.size("passports_") > 0).alias("passport_context"), F.col("foreign_").isNotNull().alias("foreign_document"), F.size(F.array_distinct(F.transform("ok_name", names.person_key))).alias("unique_persons"))
    maps = {"categories": _filled_map(entries, f"map<string,{FINDING}>"), "validation": _filled_map(stats, "map<string,struct<candidates:int,valid:int,rejected:int>>"), "signals": signals}
    return settled(step.select(*kept, *(c.alias(k) for k, c in maps.items())))


def _merge(samples: Column, first: Column) -> Column:
    """The first samples as they are, then those of the rest that are not among them."""
    head = F.slice(samples, F.lit(1), first)
    rest = F.slice(samples, first + 1, F.size(samples))
    return F.concat(head, F.array_distinct(F.filter(rest, lambda v: ~F.array_contains(head, v))))


def findings(detected: DataFrame, *keys: str) -> DataFrame:
    """One row for each category found: keys, category, count, samples_masked."""
    return detected.select(*keys, F.explode_outer("categories").alias("category", "finding")).where("category is not null").select(*keys, "category", "finding.count", "finding.samples_masked")
