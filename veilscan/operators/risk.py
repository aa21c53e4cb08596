"""Document types, risk scores with their reasons, and what goes into the report.

Each rule is a pair of a condition and the points and reason it gives; scores are sums over rules, reasons are what holds
of them, in order.  All of it is one projection over detected rows with features.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..functions.text import any_of, settled
from .features import has, kinds, only

TABLE = "struct<status:string,rows_with_pii:int,rows_with_sensitive_pii:int,rows_with_sensitive_combo:int,pii_row_ratio:double,combo_row_ratio:double,sensitive_column_count:int>"


@dataclass
class Rule:
    when: Column
    points: int | Column
    reason: str | Column


def first_of(*rules: Rule) -> list[Rule]:
    """Rules of which only the first that holds counts."""
    out, none = [], F.lit(True)
    for r in rules:
        held = F.coalesce(r.when, F.lit(False))
        out.append(Rule(none & held, r.points, r.reason))
        none = none & ~held
    return out


def points(rules: list[Rule]) -> Column:
    return sum((F.when(F.coalesce(r.when, F.lit(False)), F.lit(r.points) if isinstance(r.points, int) else r.points).otherwise(0) for r in rules), F.lit(0))


def reasons(rules: list[Rule]) -> Column:
    return F.filter(F.array(*(F.when(F.coalesce(r.when, F.lit(False)), F.lit(r.reason) if isinstance(r.reason, str) else r.reason) for r in rules)), lambda x: x.isNotNull())


def _f(name: str) -> Column:
    return F.col(f"features.{name}")


def _t(name: str) -> Column:
    return F.coalesce(F.col(f"table_analysis.{name}"), F.lit(0))


def document_type(content: Column, ext: Column, text: Column, ocr: Column) -> Column:
    """The first kind whose words, categories or file type are there."""
    images = ext.isin(".jpg", ".jpeg", ".png", ".tif", ".tiff", ".gif")
    passport = any_of(content, ("паспорт", "passport")) | has("passport_rf")
    scanned_pdf = (ext == ".pdf") & (F.col("signals.passport_context") | (F.char_length(text) < 3000) | ocr)
    legal = F.array_except("names", F.lit(list(V.LEGAL)))
    order = [
        (any_of(content, V.POLICY_PHRASES), V.POLICY),
        (any_of(content, V.ADMISSION_PHRASES) & any_of(content, V.EDUCATION_WORDS), V.ADMISSION),
        (F.contains(content, F.lit("согласие на обработ")) & F.contains(content, F.lit("персональн")), V.CONSENT),
        (passport & (images | scanned_pdf), V.PASSPORT_SCAN),
        (has("foreign_id_document"), V.ID_CARD),
        (has("driver_license") | F.contains(content, F.lit(V.DRIVER)), V.DRIVER),
        (has("bank_card", "cvv"), V.CARD_DOC),
        (has("health"), V.MEDICAL),
        ((_t("rows_with_sensitive_combo") > 0) | (ext.isin(*V.ANALYSED_TABLES) & (F.size(legal) >= 3)), V.ID_TABLE),
        (any_of(content, V.DUMP_WORDS), V.DUMP),
        (any_of(content, V.RECEIPT_WORDS), V.RECEIPT),
        (any_of(content, V.INVOICE_WORDS), V.INVOICE),
        (F.contains(content, F.lit(V.WAYBILL)), V.WAYBILL),
        (F.contains(content, F.lit(V.ORDER)), V.ORDER),
        (F.contains(content, F.lit(V.CONTRACT)), V.CONTRACT),
        (content.contains("акт") & content.rlike(r"(?U)\bакт\b"), V.ACT),
        (ext.isin(".jpg", ".jpeg", ".png", ".gif"), V.PICTURE),
    ]
    out = F.when(*order[0][:1], order[0][1])
    for condition, label in order[1:]:
        out = out.when(condition, label)
    return out.otherwise(V.UNKNOWN)


def bonus(category: Column, count: Column) -> Column:
    """Whole binary logarithm of the count, one more for high-impact categories, each kind with its cap."""
    log = sum(((count >= 1 << k).cast("int") for k in range(1, 31)), F.lit(0))
    capped = F.when(category.isin(*V.HIGH_IMPACT), F.least(log + 1, F.lit(5))).when(category.isin(*V.CONTACT, "full_name", "birth_date"), F.least(log, F.lit(3))).otherwise(F.least(log, F.lit(2)))
    return F.when(count <= 1, 0).otherwise(capped)


def sensitivity_rules() -> list[Rule]:
    requisites_only = has(*V.LEGAL) & ~has("bank_card", "cvv")
    return [
        *first_of(
            Rule(_f("has_full_identity_bundle"), 6, "Full identity bundle: name plus strong identifiers/contact data (+6 sensitivity)"),
            Rule(_f("has_government_id_bundle"), 5, "Government ID bundle detected (+5 sensitivity)"),
        ),
        *first_of(
            Rule(_f("has_card_and_phone"), 5, "Bank card plus phone detected (+5 sensitivity)"),
            Rule(_f("has_payment_bundle") & ~requisites_only, 3, "Payment data bundle detected (+3 sensitivity)"),
        ),
        Rule(_f("has_contact_bundle"), 3, "Name plus multiple contact categories detected (+3 sensitivity)"),
        Rule(F.col("signals.passport_context"), 2, "Passport context confirmed around passport-like number (+2 sensitivity)"),
        Rule(F.col("signals.foreign_document"), 2, "Foreign identity document context detected (+2 sensitivity)"),
    ]


def category_parts() -> Column:
    """For each category in order its points and reason."""
    table = F.create_map(*(F.lit(x) for kv in V.POINTS.items() for x in kv))

    def part(name: Column) -> Column:
        count = F.element_at("categories", name)["count"]
        weak = (name == "health") & F.col("weak_health")
        base = F.coalesce(F.try_element_at(table, name), F.lit(1))
        extra = bonus(name, count)
        head = F.concat(name, F.lit(": "), count.cast("string"))
        said = F.when(weak, F.concat(head, F.lit(" public/regulatory mentions (+1 weak context)"))).when(extra > 0, F.concat(head, F.lit(" found (+"), base.cast("string"), F.lit("+"), extra.cast("string"), F.lit(" count)"))).otherwise(F.concat(head, F.lit(" found (+"), base.cast("string"), F.lit(")")))
        return F.struct(F.when(weak, 1).otherwise(base + extra).alias("points"), said.alias("reason"))

    return F.transform("names", part)


def massiveness_rules(ext: Column) -> list[Rule]:
    value, persons, density = _f("value_findings"), _f("unique_persons"), _f("value_pdn_density")
    sensitive = F.when(F.col("weak_health"), 0).otherwise(_f("sensitive_findings"))
    table = F.coalesce(F.col("table_analysis.status") == "ok", F.lit(False))
    combos, private, pii = _t("rows_with_sensitive_combo"), _t("rows_with_sensitive_pii"), _t("rows_with_pii")

    def told(n: Column, what: str) -> Column:
        return F.concat(F.lit("Table has "), n.cast("string"), F.lit(f" rows with {what} massiveness)"))

    return [
        *first_of(Rule(value >= 30, 5, "Many non-keyword PII findings (>=30) (+5 massiveness)"), Rule(value >= 10, 3, "Many non-keyword PII findings (>=10) (+3 massiveness)")),
        *first_of(Rule(sensitive >= 10, 4, "Many sensitive identifiers (>=10) (+4 massiveness)"), Rule(sensitive >= 3, 2, "Several sensitive identifiers (>=3) (+2 massiveness)")),
        *first_of(Rule((density >= 2.0) & (value >= 5), 3, "High value PII density (+3 massiveness)"), Rule((density >= 0.8) & (value >= 3), 1, "Elevated value PII density (+1 massiveness)")),
        *first_of(Rule(persons >= 20, 5, "Many distinct full names (>=20) (+5 massiveness)"), Rule(persons >= 5, 3, "Multiple distinct full names (>=5) (+3 massiveness)")),
        *first_of(Rule(table & ((combos >= 10) | (_t("combo_row_ratio") >= 0.2)), 8, "Table has many rows with sensitive PII combinations (+8 massiveness)"), Rule(table & (combos > 0), 5, told(combos, "sensitive PII combinations (+5"))),
        *first_of(Rule(table & (private >= 20), 6, "Table has many rows with sensitive PII (+6 massiveness)"), Rule(table & (private >= 3), 4, told(private, "sensitive PII (+4"))),
        *first_of(Rule(table & ((pii >= 50) | (_t("pii_row_ratio") >= 0.3)), 4, "Table has broad PII coverage across rows (+4 massiveness)"), Rule(table & (pii >= 10), 2, told(pii, "PII (+2"))),
        Rule(table & (_t("sensitive_column_count") >= 3), 3, "Table has multiple sensitive PII-bearing columns (+3 massiveness)"),
        Rule(ext.isin(*V.RISK_TABLES) & (value >= 5), 2, "Structured file contains repeated PII-like values (+2 massiveness)"),
    ]


def context_rules(ext: Column) -> list[Rule]:
    kind, high = F.col("document_type"), has(*V.HIGH_IMPACT)
    return [
        *first_of(
            Rule(ext.isin(*V.IMAGE_EXT) & high, 5, "Image file contains high-impact PII (+5 context)"),
            Rule(ext.isin(*V.VIDEO_EXT) & high, 5, "Video frame OCR contains high-impact PII (+5 context)"),
            Rule(_f("is_image_or_scan") & high & (ext != ".txt"), 4, "File looks like scan/image with sensitive PII (+4 context)"),
        ),
        Rule(F.col("dump_context"), 5, "Dump/backup/export context (+5 context)"),
        *first_of(
            Rule(kind.isin(V.PASSPORT_SCAN, V.DRIVER, V.ID_CARD), 5, F.concat(F.lit("Document type is "), kind, F.lit(" (+5 context)"))),
            Rule(kind == V.ID_TABLE, 4, "Document type is identifier table (+4 context)"),
            Rule(kind == V.DUMP, 5, "Document type is export/dump (+5 context)"),
            Rule((kind == V.MEDICAL) & has("health"), 3, "Medical context with health data (+3 context)"),
            Rule((kind == V.RECEIPT) & has(*V.DIRECT, *V.CONTACT), 3, "Personal receipt with identifiers/contact data (+3 context)"),
        ),
        Rule((F.col("table_analysis.status") == "ok") & (_t("rows_with_sensitive_combo") > 0), 2, "Row-level sensitive combinations confirmed (+2 context)"),
    ]


def storage_rules() -> list[Rule]:
    return [Rule(F.col("suspicious_path"), 4, "Suspicious file or directory name (+4 context)")]


def legitimacy_rules(content: Column) -> list[Rule]:
    kind, combo = F.col("document_type"), _t("rows_with_sensitive_combo") > 0
    return [
        *first_of(
            Rule((kind == V.POLICY) & ~combo & only(V.BENIGN), 8, "Public policy/terms with only contact or legal-entity data (-8 legitimate context)"),
            Rule((kind == V.POLICY) & ~combo & ~has(*V.STRICT), 10, "Public policy/terms context lowers weak special-category mentions (-10 legitimate context)"),
        ),
        Rule((kind == V.ADMISSION) & ~combo & (F.col("weak_health") | only(("health", *V.BENIGN))), 8, "Public admission/regulatory document with weak PII mentions (-8 legitimate context)"),
        Rule(F.col("weak_special"), 8, "Special-category words without a concrete person anchor (-8 legitimate context)"),
        Rule(any_of(content, V.BUSINESS_WORDS) & ~has("bank_card", "cvv", "mrz", "health", "biometric", "inn_person"), 4, "Formal business context without personal high-impact identifiers (-4 legitimate context)"),
        Rule(kind.isin(V.INVOICE, V.ACT, V.WAYBILL, V.CONTRACT, V.ORDER) & only(V.BENIGN), 5, "Likely legitimate business document with benign/legal-entity categories (-5 legitimate context)"),
        Rule((F.size("names") > 0) & only(V.REQUISITES), 4, "Only contact/legal-entity requisites found (-4 legitimate context)"),
        Rule(~has(*V.HIGH_IMPACT) & ~combo & only(V.BENIGN), 2, "No high-impact personal category found (-2 legitimate context)"),
    ]


def weak_health(kind: Column) -> Column:
    """Health words in a public document without a person."""
    return has("health") & kind.isin(V.ADMISSION, V.POLICY) & (_t("rows_with_sensitive_combo") <= 0) & only(("health", *V.REQUISITES, "full_name")) & (_f("unique_persons") <= 0)


def weak_special(kind: Column) -> Column:
    """Words of special categories without a person or a number."""
    allowed = (*V.SPECIAL_RISK, *V.REQUISITES)
    return has(*V.SPECIAL_RISK) & (_t("rows_with_sensitive_combo") <= 0) & (_f("unique_persons") <= 0) & only(allowed) & kind.isin(V.POLICY, V.ADMISSION, V.MEDICAL, V.CONSENT, V.UNKNOWN)


def public_low_risk(path: Column) -> Column:
    public = F.col("document_type").isin(V.ADMISSION, V.POLICY) | any_of(path, V.PUBLIC_PATHS) | F.col("public_web")
    contacts = F.contains(path, F.lit("координаты для связи")) & only(("full_name", "phone", "email", "address", "snils"))
    little = (_f("value_findings") < 5) & ~_f("has_full_identity_bundle")
    return (_t("rows_with_sensitive_combo") <= 0) & public & (~has(*V.DIRECT, "bank_card", "cvv") | contacts | little)


def include(path: Column, ext: Column) -> Column:
    """Whether a row is reported: the first rule that holds decides."""
    kind, level, value = F.col("document_type"), F.col("risk_level"), _f("value_findings")
    combo, mass = _t("rows_with_sensitive_combo") > 0, _t("rows_with_sensitive_pii") >= 3
    strong = has(*V.DIRECT, "bank_card", "cvv")
    identity = _f("has_full_identity_bundle") | _f("has_government_id_bundle")
    payment = _f("has_card_and_phone") | _f("has_payment_bundle")
    suspicious = F.col("context_score") >= 5
    dump = ext.isin(*V.RISK_TABLES) & F.col("suspicious_path") & (value >= 20) & (kinds((*V.DIRECT, *V.CONTACT)) >= 2)
    leak = has("full_name") & has(*V.CONTACT) & any_of(path, V.PERSONAL_PATHS)
    contact = _f("has_contact_bundle") & (strong | suspicious | (F.col("risk_score") >= V.HIGH))
    return (
        F.when(F.size("names") == 0, False)
        .when(F.col("weak_special"), False)
        .when(F.col("public_web") & ~combo & (value < 10) & ~identity, False)
        .when(public_low_risk(path), False)
        .when(kind.isin(V.ORDER, V.ADMISSION, V.POLICY) & ~F.col("suspicious_path") & ~combo & only(("snils", "full_name", *V.REQUISITES)), False)
        .when(leak & level.isin("medium", "high"), True)
        .when(only(("full_name", *V.REQUISITES)) & ~combo & ~suspicious, False)
        .when(level == "high", combo | mass | identity | payment | dump | (strong & suspicious))
        .when(level == "medium", combo | identity | payment | contact)
        .otherwise(False)
    )


def assess(featured: DataFrame, text_col: str = "text", path_col: str = "relative_path", extension_col: str = "extension", ocr: Column | None = None) -> DataFrame:
    """featured with document_type, the four scores, risk_score, risk_level, include_in_report, reasons, recommendation.

    A column table_analysis (see operators.tables) is used where there is one; rows without have null in it.
    """
    kept = featured.columns
    featured = settled(featured)
    step = featured if "table_analysis" in kept else featured.withColumn("table_analysis", F.lit(None).cast(TABLE))
    text, path = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(path_col), F.lit(""))
    read = F.lit(False) if ocr is None else F.coalesce(ocr, F.lit(False))
    step = step.withColumns({"text_": text, "ext_": F.coalesce(F.col(extension_col), F.lit("")), "content_": F.lower(F.concat(path, F.lit(" "), text)), "path_": F.replace(F.lower(path), F.lit("\\"), F.lit("/"))})
    ext, content, where = F.col("ext_"), F.col("content_"), F.col("path_")
    step = step.withColumns({"document_type": document_type(content, ext, F.col("text_"), read), "public_web": any_of(where, V.PUBLIC_WEB)})
    step = step.withColumns(
        {
            "weak_health": weak_health(F.col("document_type")),
            "weak_special": weak_special(F.col("document_type")),
            "suspicious_path": ~F.col("public_web") & any_of(where, V.SUSPICIOUS_PATHS),
            "dump_context": ~F.col("public_web") & (any_of(where, V.DUMP_PATHS) | any_of(content, V.DUMP_CONTENT)),
        }
    )
    step = step.withColumn("parts_", category_parts())
    sense, mass, context, legit, storage = sensitivity_rules(), massiveness_rules(ext), context_rules(ext), legitimacy_rules(content), storage_rules()
    step = step.withColumns(
        {
            "sensitivity_score": F.aggregate("parts_", F.lit(0), lambda s, p: s + p["points"]) + points(sense),
            "massiveness_score": points(mass),
            "context_score": points(context) + points(storage),
            "legitimacy_discount": F.least(points(legit), F.lit(12)),
        }
    )
    step = step.withColumn("risk_score", F.greatest(F.col("sensitivity_score") + F.col("massiveness_score") + F.col("context_score") - F.col("legitimacy_discount"), F.lit(0)))
    step = step.withColumn("risk_level", F.when(F.col("risk_score") >= V.HIGH, "high").when(F.col("risk_score") >= V.MEDIUM, "medium").otherwise("low"))
    head = F.concat(F.lit("Risk components: pii_sensitivity="), F.col("sensitivity_score").cast("string"), F.lit(", massiveness="), F.col("massiveness_score").cast("string"), F.lit(", context_suspicion="), F.col("context_score").cast("string"), F.lit(", legitimate_context=-"), F.col("legitimacy_discount").cast("string"))
    anything = has(*V.HIGH_IMPACT) | (_t("rows_with_sensitive_combo") > 0)
    step = step.withColumns(
        {
            "include_in_report": include(where, ext),
            "reasons": F.concat(F.array(head), F.transform("parts_", lambda p: p["reason"]), reasons([*sense, *mass, *context, *legit, *storage])),
            "recommendation": F.when((F.col("risk_level") == "high") & anything, V.RECOMMEND_HIGH).when(F.col("risk_level") == "medium", V.RECOMMEND_MEDIUM).otherwise(V.RECOMMEND_LOW),
        }
    )
    made = ["document_type", "sensitivity_score", "massiveness_score", "context_score", "legitimacy_discount", "risk_score", "risk_level", "include_in_report", "reasons", "recommendation"]
    return settled(step.select(*kept, *made))
