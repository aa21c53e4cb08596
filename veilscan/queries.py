"""The library's own queries, each over whole tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import cases as C
from . import fixtures as X
from .functions import names, text, validators
from .functions import vocab as V
from .operators import quality, routing, tables, video
from .operators.detect import ascii_fold, detect, findings, identity_marker
from .operators.features import with_features
from .operators.risk import assess
from .plans.pipeline import score
from .session import dealt, written
from .sources import sinks
from .sources.files import html_text, json_values

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fixture(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    view = f"veilscan_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {view}"))


def _customers(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A view of customers for steps that take long for a row."""
    dealt(table(spark, sf_dir, "customer"), "c_custkey").createOrReplaceTempView("veilscan_dealt_customer")
    return spark.sql(sql.replace("FROM customer", "FROM veilscan_dealt_customer"))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customers(spark, sf_dir, X.PEOPLE)


def document_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, X.FILES, "documents")


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# --- Scanning and routing ---

SUPPORTED = [e for e in X.EXTENSIONS if e in V.SUPPORTED_EXT]


@query(f"""
WITH f AS ({X.FILES})
SELECT relative_path, extension, size_bytes, CASE WHEN error IS NULL THEN 'pending' ELSE 'skipped' END AS status, error FROM (
  SELECT *, CASE WHEN doc_id % 23 = 0 THEN 'Temporary Office lock file' WHEN extension NOT IN {_in(SUPPORTED)} THEN 'Unsupported extension: ' || CASE WHEN extension = '' THEN '<none>' ELSE extension END
    WHEN size_bytes > 104857600 THEN 'File is larger than limit: ' || CAST(size_bytes AS VARCHAR) || ' bytes' END AS error FROM f) s""")
def scan_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir)
    state, error = routing.status(F.substring_index("relative_path", "/", -1), text.extension_of(F.col("relative_path")), F.col("size_bytes"))
    return files.select("relative_path", text.extension_of(F.col("relative_path")).alias("extension"), "size_bytes", state.alias("status"), error.alias("error"))


WANTED = f"SELECT CASE WHEN doc_id % 14 = 0 THEN '  /' || relative_path WHEN doc_id % 7 = 0 THEN 'gone/' || relative_path ELSE '# ' || relative_path END AS value FROM ({X.FILES}) w"


def _wanted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.include_list(_fixture(spark, sf_dir, WANTED, "documents"))


@query(f"WITH f AS ({X.FILES}) SELECT relative_path, size_bytes FROM f WHERE doc_id % 14 = 0")
def include_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.selected(document_files(spark, sf_dir), _wanted(spark, sf_dir)).select("relative_path", "size_bytes")


@query(f"WITH f AS ({X.FILES}) SELECT DISTINCT 'gone/' || relative_path AS relative_path FROM f WHERE doc_id % 7 = 0 AND doc_id % 14 <> 0")
def include_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routing.missing(document_files(spark, sf_dir), _wanted(spark, sf_dir))


@query(f"""WITH f AS ({X.FILES}) SELECT relative_path, substr(regexp_replace(regexp_replace(relative_path, '[^A-Za-zА-Яа-я0-9._-]+', '__', 'g'), '^[._]+|[._]+$', '', 'g'), 1, 120) || '__' || substr(sha1(relative_path), 1, 12) AS file_id FROM f""")
def file_id_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_files(spark, sf_dir).select("relative_path", text.file_id(F.col("relative_path")).alias("file_id"))


def _text_rows(files: DataFrame) -> DataFrame:
    """Texts as an earlier run leaves them; those of ids divisible by 3 have lost their original."""
    return files.select(F.concat(F.lit("/out/"), text.file_id(F.col("relative_path")), F.lit(".txt")).alias("text_path"), F.col("relative_path").alias("text"), F.lit(7).cast("bigint").alias("text_bytes"))


@query(f"""WITH f AS ({X.FILES}), i AS (SELECT *, '/out/' || regexp_replace(relative_path, '[^A-Za-zА-Яа-я0-9._-]+', '__', 'g') || '__' || substr(sha1(relative_path), 1, 12) || '.txt' AS text_path FROM f WHERE extension <> ''),
m AS (SELECT text_path, doc_id % 3 <> 0 AS matched, CASE WHEN doc_id % 3 <> 0 THEN relative_path ELSE 'text-only/' || regexp_replace(regexp_replace(relative_path, '[^A-Za-zА-Яа-я0-9._-]+', '__', 'g'), '__', '/', 'g') END AS relative_path, CASE WHEN doc_id % 3 <> 0 THEN size_bytes ELSE 7 END AS size_bytes FROM i)
SELECT text_path, relative_path, size_bytes, matched, row_number() OVER (ORDER BY text_path) - 1 AS ord FROM m""")
def text_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir).where("extension <> ''")
    return routing.match_texts(_text_rows(files), files.where("doc_id % 3 <> 0").drop("doc_id")).select("text_path", "relative_path", "size_bytes", "matched", "ord")


@query(f"WITH f AS ({X.FILES}) SELECT CASE WHEN extension = '.pdf' THEN 'pdf' WHEN extension IN {_in(V.HEAVY_EXT)} THEN 'heavy' ELSE 'light' END AS weight, count(*) AS files, sum(size_bytes) AS bytes FROM f GROUP BY 1")
def weight_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return document_files(spark, sf_dir).groupBy(routing.weight(F.col("extension")).alias("weight")).agg(F.count("*").alias("files"), F.sum("size_bytes").alias("bytes"))


# --- Detectors on the driver's texts ---


@query(r"SELECT doc_id, len(list_distinct(regexp_extract_all(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b'))) AS n_email FROM documents WHERE regexp_matches(text, '\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}\b')")
def email_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.unique_trimmed(text.found(F.col("text"), V.PATTERNS["email"]))
    return table(spark, sf_dir, "documents").where(F.contains("text", F.lit("@"))).select("doc_id", F.size(found).cast("bigint").alias("n_email")).where("n_email > 0")


@query(r"SELECT doc_id, len(list_distinct(regexp_extract_all(text, '\(\s*\d{3}\s*\)\s*\d{3}[\s-]?\d{2}[\s-]?\d{2}'))) AS n_phone FROM documents WHERE regexp_matches(text, '\(\s*\d{3}\s*\)\s*\d{3}[\s-]?\d{2}[\s-]?\d{2}')")
def phone_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = text.unique_trimmed(text.found(F.col("text"), V.PATTERNS["phone"]))
    return table(spark, sf_dir, "documents").where(F.col("text").rlike(r"\d{2}")).select("doc_id", F.size(found).cast("bigint").alias("n_phone")).where("n_phone > 0")


LUHN = "list_sum(list_transform(range(1, 17), lambda i: CASE WHEN i % 2 = 1 THEN CASE WHEN CAST(substr(c, CAST(i AS INT), 1) AS INT) * 2 > 9 THEN CAST(substr(c, CAST(i AS INT), 1) AS INT) * 2 - 9 ELSE CAST(substr(c, CAST(i AS INT), 1) AS INT) * 2 END ELSE CAST(substr(c, CAST(i AS INT), 1) AS INT) END)) % 10 = 0"


@query(rf"WITH c AS (SELECT doc_id, unnest(regexp_extract_all(text, '\b\d{{16}}\b')) AS c FROM documents) SELECT doc_id, c AS number, {LUHN} AS valid FROM c")
def card_luhn(spark: SparkSession, sf_dir: str) -> DataFrame:
    runs = table(spark, sf_dir, "documents").where(F.col("text").rlike(r"\d{16}")).select("doc_id", F.explode(text.found(F.col("text"), r"\b\d{16}\b")).alias("number"))
    return runs.select("doc_id", "number", validators.luhn_ok(F.col("number")).alias("valid"))


@query(f"SELECT c_custkey, {X.INN} AS inn, c_custkey % 3 <> 0 AS valid FROM customer")
def inn_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, f"SELECT c_custkey, {X.INN} AS inn FROM customer", "customer").withColumn("valid", validators.inn_ok(F.col("inn")))


@query(f"SELECT c_custkey, {X.SNILS} AS snils, c_custkey % 5 <> 0 AS valid FROM customer")
def snils_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, f"SELECT c_custkey, {X.SNILS} AS snils FROM customer", "customer").withColumn("valid", validators.snils_ok(F.col("snils")))


# --- Detection, features, types and risk on texts with known contents ---


@query(f"SELECT c_custkey, category, n AS count FROM ({X.FOUND}) g")
def pii_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(detect(people(spark, sf_dir)), "c_custkey").select("c_custkey", "category", "count")


@query(f"""
SELECT c_custkey, category, CASE category WHEN 'email' THEN substr('u' || CAST(c_custkey AS VARCHAR), 1, 2) || '***@example.com' WHEN 'phone' THEN CASE WHEN c_custkey % 9 = 0 THEN '79' ELSE '89' END || '***' || {X.TWO}
  WHEN 'full_name' THEN 'И*** И*** И***' WHEN 'bank_card' THEN '41***11' WHEN 'cvv' THEN '***' WHEN 'inn_legal' THEN substr({X.INN}, 1, 2) || '***' || substr({X.INN}, 9, 2) WHEN 'snils' THEN substr({X.SNILS}, 1, 2) || '***' || substr({X.SNILS}, 13, 2)
  WHEN 'bank_account' THEN '40***' || {X.TWO} WHEN 'bik' THEN '04***' || {X.TWO} WHEN 'birth_date' THEN '0' || CAST(1 + c_custkey % 9 AS VARCHAR) || '***80' WHEN 'passport_rf' THEN '45***56' WHEN 'health' THEN 'ди***з' WHEN 'nationality' THEN 'на***ь' END AS sample
FROM ({X.FOUND}) g""")
def mask_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(detect(people(spark, sf_dir)), "c_custkey").select("c_custkey", "category", F.get("samples_masked", F.lit(0)).alias("sample"))


@query(f"""
SELECT c_custkey, 'inn' AS checked, 1 AS candidates, CAST(c_custkey % 3 <> 0 AS INT) AS valid FROM customer WHERE c_custkey % 9 = 1
UNION ALL SELECT c_custkey, 'snils', 1, CAST(c_custkey % 5 <> 0 AS INT) FROM customer WHERE c_custkey % 9 = 2
UNION ALL SELECT c_custkey, 'passport_rf_generic', 1, 0 FROM customer WHERE c_custkey % 9 = 1
UNION ALL SELECT g.c_custkey, 'passport_rf_generic', 1, CAST(f.category IS NOT NULL AS INT) FROM customer g LEFT JOIN ({X.FOUND}) f ON f.c_custkey = g.c_custkey AND f.category = 'passport_rf' WHERE g.c_custkey % 9 = 7""")
def validation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = detect(people(spark, sf_dir)).select("c_custkey", F.explode("validation").alias("checked", "v"))
    return found.select("c_custkey", "checked", F.col("v.candidates").alias("candidates"), F.col("v.valid").alias("valid"))


def _sum(categories) -> str:
    return f"coalesce(sum(CASE WHEN category IN {_in(categories)} THEN n END), 0)"


def _kinds(categories) -> str:
    return f"count(CASE WHEN category IN {_in(categories)} THEN 1 END)"


SENSITIVE = (*V.DIRECT, "bank_card", "cvv", *V.SPECIAL_FEATURES)
#: Features as sums over the known findings.
FEATURES = f"""
SELECT p.c_custkey, count(category) AS category_count, coalesce(sum(n), 0) AS total_findings, {_sum(V.WEAK)} AS weak_keyword_findings, {_sum(SENSITIVE)} AS sensitive_findings, {_sum(V.CONTACT)} AS contact_findings, {_sum(V.FINANCIAL)} AS financial_findings,
  coalesce(max(CASE WHEN category = 'full_name' THEN 1 END), 0) AS unique_persons, max(length(p.text)) AS text_length, {_kinds(("bank_card", "phone"))} = 2 AS has_card_and_phone, {_kinds(("bank_card", "cvv"))} > 0 OR {_kinds(("bank_account", "bik"))} = 2 AS has_payment_bundle,
  {_kinds(("full_name",))} = 1 AND {_kinds(V.CONTACT)} >= 2 AS has_contact_bundle, {_kinds(("passport_rf", "snils"))} = 2 AS has_passport_and_snils,
  {_kinds(("passport_rf", "foreign_id_document", "snils", "driver_license", "mrz"))} > 0 AND ({_kinds(("full_name",))} > 0 OR {_kinds(V.DIRECT)} >= 2) AS has_government_id_bundle,
  {_kinds(("full_name",))} > 0 AND ({_kinds(("passport_rf", "snils"))} = 2 OR ({_kinds(V.DIRECT)} > 0 AND {_kinds(("birth_date", "address", "phone", "email"))} > 0) OR {_kinds((*V.DIRECT, *V.DEMOGRAPHIC, *V.CONTACT, "bank_card"))} >= 4) AS has_full_identity_bundle,
  coalesce(sum(n), 0) - {_sum(V.WEAK)} AS value_findings, {_sum(V.DIRECT)} AS direct_identifier_findings, {_kinds(SENSITIVE)} AS sensitive_category_count, max(p.size_bytes) AS file_size_bytes, max(CAST(p.extension = '.csv' AS INT)) = 1 AS is_structured, FALSE AS is_image_or_scan,
  round(coalesce(sum(n), 0) * 1000.0 / max(length(p.text)), 3) AS pdn_density, round((coalesce(sum(n), 0) - {_sum(V.WEAK)}) * 1000.0 / max(length(p.text)), 3) AS value_pdn_density
FROM ({X.PEOPLE}) p LEFT JOIN ({X.FOUND}) g ON g.c_custkey = p.c_custkey GROUP BY p.c_custkey"""


@query(FEATURES)
def pii_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_features(detect(people(spark, sf_dir)))
    return rows.select("c_custkey", *(F.col(f"features.{f.name}").cast("bigint" if f.dataType.simpleString() == "int" else f.dataType).alias(f.name) for f in rows.schema["features"].dataType.fields))


#: The known texts' document types: the passport rule needs a short PDF or a picture, dumps a word in the path.
TYPES = f"""
SELECT p.c_custkey, CASE WHEN c_custkey % 9 = 7 AND extension = '.pdf' THEN '{V.PASSPORT_SCAN}' WHEN c_custkey % 9 = 3 THEN '{V.CARD_DOC}' WHEN c_custkey % 9 = 4 THEN '{V.MEDICAL}' WHEN c_custkey % 9 = 0 AND extension = '.csv' THEN '{V.ID_TABLE}'
  WHEN c_custkey % 4 = 1 THEN '{V.DUMP}' ELSE '{V.UNKNOWN}' END AS document_type FROM ({X.PEOPLE}) p"""


@query(TYPES)
def doc_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(people(spark, sf_dir)).select("c_custkey", "document_type")


POINT_CASE = "CASE category " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in V.POINTS.items()) + " END"
#: Scores by the rules that these texts can meet.  Paths: 1 of 4 is a backup's.  health has count 3, so a bonus of 2.
SCORES = f"""
WITH f AS ({FEATURES}), t AS ({TYPES}), p AS ({X.PEOPLE}),
c AS (SELECT c_custkey, sum({POINT_CASE} + CASE WHEN category = 'health' THEN 2 ELSE 0 END) AS points, max(CASE WHEN category IN {_in(V.HIGH_IMPACT)} THEN 1 ELSE 0 END) AS high,
  max(CASE WHEN category = 'passport_rf' THEN 1 ELSE 0 END) AS passport, max(CASE WHEN category NOT IN {_in(V.BENIGN)} THEN 1 ELSE 0 END) AS beyond, max(CASE WHEN category NOT IN {_in(V.REQUISITES)} THEN 1 ELSE 0 END) AS more FROM ({X.FOUND}) g GROUP BY c_custkey),
a AS (SELECT f.*, t.document_type, p.extension, coalesce(c.points, 0) AS points, coalesce(c.high, 0) AS high, coalesce(c.beyond, 0) AS beyond, coalesce(c.more, 0) AS more, coalesce(c.passport, 0) AS passport, f.total_findings - f.weak_keyword_findings AS value,
  floor((f.total_findings - f.weak_keyword_findings) * 1000.0 / f.text_length * 1000 + 0.5) / 1000 AS density FROM f JOIN t ON t.c_custkey = f.c_custkey JOIN p ON p.c_custkey = f.c_custkey LEFT JOIN c ON c.c_custkey = f.c_custkey),
s AS (SELECT c_custkey, document_type, high, category_count,
  points + CASE WHEN has_card_and_phone THEN 5 ELSE 0 END + CASE WHEN has_contact_bundle THEN 3 ELSE 0 END + 2 * passport AS sensitivity_score,
  CASE WHEN sensitive_findings >= 10 THEN 4 WHEN sensitive_findings >= 3 THEN 2 ELSE 0 END + CASE WHEN density >= 2 AND value >= 5 THEN 3 WHEN density >= 0.8 AND value >= 3 THEN 1 ELSE 0 END AS massiveness_score,
  CASE WHEN c_custkey % 4 = 1 THEN 9 ELSE 0 END + CASE document_type WHEN '{V.PASSPORT_SCAN}' THEN 5 WHEN '{V.ID_TABLE}' THEN 4 WHEN '{V.DUMP}' THEN 5 WHEN '{V.MEDICAL}' THEN 3 ELSE 0 END AS context_score,
  least(12, CASE WHEN c_custkey % 9 = 4 THEN 8 ELSE 0 END + CASE WHEN category_count > 0 AND more = 0 THEN 4 ELSE 0 END + CASE WHEN beyond = 0 THEN 2 ELSE 0 END) AS legitimacy_discount FROM a)
SELECT *, greatest(sensitivity_score + massiveness_score + context_score - legitimacy_discount, 0) AS risk_score FROM s"""


@query(f"SELECT c_custkey, sensitivity_score, massiveness_score, context_score, legitimacy_discount, risk_score FROM ({SCORES}) r")
def risk_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = ("sensitivity_score", "massiveness_score", "context_score", "legitimacy_discount", "risk_score")
    return score(people(spark, sf_dir)).select("c_custkey", *(F.col(p).cast("bigint").alias(p) for p in parts))


@query(f"""SELECT c_custkey, CASE WHEN risk_score >= 11 THEN 'high' WHEN risk_score >= 6 THEN 'medium' ELSE 'low' END AS risk_level,
  CASE WHEN risk_score >= 11 AND high = 1 THEN '{V.RECOMMEND_HIGH}' WHEN risk_score >= 6 AND risk_score < 11 THEN '{V.RECOMMEND_MEDIUM}' ELSE '{V.RECOMMEND_LOW}' END AS recommendation FROM ({SCORES}) r""")
def risk_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(people(spark, sf_dir)).select("c_custkey", "risk_level", "recommendation")


@query()
def report_include(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(people(spark, sf_dir)).select("c_custkey", "include_in_report", F.array_join("reasons", "; ").alias("reasons"))


@query(f"SELECT CASE WHEN risk_score >= 11 THEN 'high' WHEN risk_score >= 6 THEN 'medium' ELSE 'low' END AS risk_level, document_type, count(*) AS files, max(risk_score) AS highest FROM ({SCORES}) r GROUP BY 1, 2")
def risk_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(people(spark, sf_dir)).groupBy("risk_level", "document_type").agg(F.count("*").alias("files"), F.max(F.col("risk_score").cast("bigint")).alias("highest"))


# --- Known cases, one for each customer ---


def _values(rows, columns: str) -> str:
    return f"(VALUES {', '.join(rows)}) v({columns})"


def _quoted(x) -> str:
    return "NULL" if x is None else str(x).upper() if isinstance(x, bool) else C.text_literal(x) if isinstance(x, str) else str(x)


def _expected(cases: tuple, columns: str, *places: int) -> str:
    rows = [f"({i}, {', '.join(_quoted(c[k]) for k in places)})" for i, c in enumerate(cases)]
    return f"SELECT c_custkey, {columns} FROM customer JOIN {_values(rows, f'place, {columns}')} ON c_custkey % {len(cases)} = place"


def _cases(spark: SparkSession, sf_dir: str, cases: tuple) -> DataFrame:
    return _customers(spark, sf_dir, C.texts(cases))


FOUND_CASES = [f"({i}, '{k}', {n})" for i, c in enumerate(C.DETECT) for k, n in c[2].items()]


@query(f"SELECT c_custkey, category, n AS count FROM customer JOIN {_values(FOUND_CASES, 'place, category, n')} ON c_custkey % {len(C.DETECT)} = place")
def detector_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every detector, with what each of its conditions refuses."""
    return findings(detect(_cases(spark, sf_dir, C.DETECT)), "c_custkey").select("c_custkey", "category", "count")


@query(_expected(C.MARKERS, "marker", 1))
def identity_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = _fixture(spark, sf_dir, f"SELECT c_custkey, {C.pick([C.text_literal(m[0]) for m in C.MARKERS])} AS text FROM customer", "customer")
    return texts.select("c_custkey", identity_marker(ascii_fold("text")).alias("marker"))


@query(_expected(C.TYPES, "document_type", 2))
def document_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_cases(spark, sf_dir, C.TYPES)).select("c_custkey", "document_type")


@query(_expected(tuple((*c[:8], c[2] + c[3] + c[4] - c[5] if c[2] + c[3] + c[4] > c[5] else 0, "; ".join((f"Risk components: pii_sensitivity={c[2]}, massiveness={c[3]}, context_suspicion={c[4]}, legitimate_context=-{c[5]}", *c[8]))) for c in C.RISKS), "sensitivity_score, massiveness_score, context_score, legitimacy_discount, risk_level, include_in_report, risk_score, reasons", 2, 3, 4, 5, 6, 7, 8, 9))
def risk_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores, level, the report rule and all reasons."""
    parts = ("sensitivity_score", "massiveness_score", "context_score", "legitimacy_discount", "risk_score")
    return score(_cases(spark, sf_dir, C.RISKS)).select("c_custkey", *(F.col(p).cast("bigint").alias(p) for p in parts), "risk_level", "include_in_report", F.array_join("reasons", "; ").alias("reasons"))


#: Two words of each key for every keyword category, once in capitals, and one of the path.
WORDS = [w for words in V.KEYWORDS.values() for w in words]
KEYWORD_TEXTS = f"""SELECT c_custkey, 'x/' || {C.pick([C.text_literal(w.strip().replace("/", "")) for w in WORDS])} || '.txt' AS relative_path, '.txt' AS extension, cast(1 as bigint) AS size_bytes,
  {C.pick([C.text_literal(w) for w in WORDS])} || ', ' || upper({C.pick([C.text_literal(w) for w in WORDS[7:] + WORDS[:7]])}) || ' ' || {C.pick([C.text_literal(w) for w in WORDS[::-1][:31]])} AS text FROM customer"""


def _count_words(words) -> str:
    return " + ".join(f"CAST((length({c}) - length(replace({c}, '{w}', ''))) / {len(w)} AS INT)" for w in words for c in ("low", "path"))


@query(
    f"WITH t AS (SELECT c_custkey, lower(text) AS low, lower(relative_path || ' ' || substr(relative_path, 3)) AS path FROM ({KEYWORD_TEXTS}) k), c AS ("
    + " UNION ALL ".join(f"SELECT c_custkey, '{c}' AS category, {_count_words(words)} AS count FROM t" for c, words in V.KEYWORDS.items() if c != "driver_license")
    + ") SELECT c_custkey, category, count FROM c WHERE count > 0"
)
def keyword_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All keywords of all categories, counted in texts and paths; licences need a number and so have none here."""
    return findings(detect(_customers(spark, sf_dir, KEYWORD_TEXTS)), "c_custkey").where(F.col("category").isin(*V.KEYWORDS)).select("c_custkey", "category", "count")


BASE_12 = f"(c_custkey * 7919 + 5000000000)"  # noqa: F541
CHECK_12 = f"({X.weighted(BASE_12, 10, (7, 2, 4, 10, 3, 5, 9, 4, 6, 8))} % 11 % 10)"
SECOND_12 = f"(({X.weighted(BASE_12, 10, (3, 7, 2, 4, 10, 3, 5, 9, 4, 6))} + 8 * {CHECK_12}) % 11 % 10)"
INN_12 = f"cast({BASE_12} as string) || cast(({CHECK_12} + case when c_custkey % 4 = 1 then 1 else 0 end) % 10 as string) || cast(({SECOND_12} + case when c_custkey % 4 = 2 then 3 else 0 end) % 10 as string)"


@query(f"SELECT c_custkey, {INN_12} AS inn, c_custkey % 4 NOT IN (1, 2) AS valid FROM customer")
def inn12_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, f"SELECT c_custkey, {INN_12} AS inn FROM customer", "customer").withColumn("valid", validators.inn_ok(F.col("inn")))


@query("SELECT c_custkey, substr(sha256(c_name), 1, 12) AS hash, '/' || ltrim(replace(CASE WHEN c_custkey % 2 = 0 THEN '//a' || chr(92) || 'b/' ELSE '' END || c_name, chr(92), '/'), '/') AS path, replace(replace('a|' || c_name || chr(10) || 'b', '|', chr(92) || '|'), chr(10), ' ') AS cell, substr('Файл ' || c_name, 1, 9) AS cut FROM customer")
def report_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short hashes, report paths, Markdown cells and cut texts."""
    name = F.col("c_name")
    path = F.concat(F.when(F.col("c_custkey") % 2 == 0, "//a\\b/").otherwise(""), name)
    return table(spark, sf_dir, "customer").select("c_custkey", validators.short_hash(name).alias("hash"), text.report_path(path).alias("path"), text.escape_markdown(F.concat(F.lit("a|"), name, F.lit("\nb"))).alias("cell"), text.truncate(F.concat(F.lit("Файл "), name), 9).alias("cut"))


FOREIGN = """SELECT c_custkey, case c_custkey % 4 when 0 then 'Identity card, document no AB12345' || cast(c_custkey % 10 as string) when 1 then 'Česká republika, identification card, 1.1.19' || lpad(cast(c_custkey % 100 as string), 2, '0')
  when 2 then 'identity document without more' else 'Bibliothèque, 12.12.2012' end AS text, '' AS relative_path, '.txt' AS extension, cast(1 as bigint) AS size_bytes FROM customer"""


@query("SELECT c_custkey, 1 AS count FROM customer WHERE c_custkey % 4 IN (0, 1)")
def foreign_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = findings(detect(_customers(spark, sf_dir, FOREIGN)), "c_custkey")
    return found.where("category = 'foreign_id_document'").select("c_custkey", "count")


NAMES = """SELECT c_custkey, case c_custkey % 5 when 0 then 'Иванова Мария Петровна' when 1 then 'Сергей Кузнецов' when 2 then 'Договор Поставки' when 3 then 'Петров Пётр' else 'Нижний Новгород Город' end AS value FROM customer"""


@query("SELECT c_custkey, c_custkey % 5 IN (0, 1, 3) AS is_name, CASE c_custkey % 5 WHEN 0 THEN 'иванова мария петровна' WHEN 1 THEN 'сергей кузнецов' WHEN 2 THEN 'договор поставки' WHEN 3 THEN 'петров петр' ELSE 'нижний новгород город' END AS person FROM customer")
def full_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fixture(spark, sf_dir, NAMES, "customer").select("c_custkey", names.likely_name(names.candidate(F.col("value"))).alias("is_name"), names.person_key(F.col("value")).alias("person"))


# --- Texts ---


@query(r"SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[ \t\r\f\v]+', ' ', 'g'), '\n{3,}', chr(10) || chr(10), 'g'), ' ' || chr(10)) AS text FROM documents WHERE len(list_filter(regexp_extract_all(lower(substr(text, 1, 20000)), '[\p{L}\p{N}_]+'), lambda w: w IN " + _in(w for w in V.LOST_LIGATURES) + ")) < 2")
def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.where(~text.needs_ligature_repair(F.col("text"))).select("doc_id", text.normalize(F.col("text")).alias("text"))


@query(r"SELECT doc_id, len(list_filter(regexp_extract_all(lower(substr(text, 1, 20000)), '[\p{L}\p{N}_]+'), lambda w: w IN " + _in(w for w in V.LOST_LIGATURES) + ")) >= 2 AS needs_repair FROM documents")
def ligature_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.needs_ligature_repair(F.col("text")).alias("needs_repair"))


@query()
def ligature_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.where(text.needs_ligature_repair(F.col("text"))).select("doc_id", F.sha2(text.normalize(F.col("text")), 256).alias("text_sha256"))


@query()
def html_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.normalize(html_text("html")).alias("text"))


@query("SELECT event_id, 'k' || chr(10) || (props->>'$.k') AS \"values\" FROM events")
def json_walk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.array_join(json_values("props"), "\n").alias("values"))


#: Letters and digits of a text in SQL.
ALNUM = r"[\p{L}\p{N}]"


@query(rf"""WITH t AS (SELECT doc_id, trim(text, ' ' || chr(10) || chr(9) || chr(13)) AS s FROM documents)
SELECT doc_id, CASE WHEN length(s) < 12 THEN 0 ELSE 12 * len(list_filter(regexp_split_to_array(s, '\s+'), lambda w: len(regexp_extract_all(w, '\p{{L}}')) >= 3)) + 2 * len(regexp_extract_all(s, '\p{{Nd}}')) + len(regexp_extract_all(s, '{ALNUM}')) + len(regexp_extract_all(s, '\n')) - 3 * len(regexp_extract_all(s, '[^\p{{L}}\p{{N}}\s]')) END AS score FROM t""")
def ocr_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", quality.ocr_score(F.col("text")).cast("bigint").alias("score"))


@query(rf"SELECT doc_id, CASE WHEN length(m) < 20 THEN '' ELSE substr(m, 1, 120) END AS mark FROM (SELECT doc_id, lower(regexp_replace(text, '[^\p{{L}}\p{{N}}]', '', 'g')) AS m FROM documents) t")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", quality.fingerprint(F.col("text")).alias("mark"))


LOST = " + ".join(f"len(regexp_extract_all(w, '^(?:{p[2:-2]})$'))" for p in V.LIGATURE_LOSS)


@query(rf"""WITH s AS (SELECT doc_id, substr(text, 1, 20000) AS s FROM documents), c AS (SELECT doc_id, len(regexp_extract_all(s, '[A-Za-zА-Яа-яЁё]')) AS n, len(regexp_extract_all(s, '[A-Za-z]')) AS l,
  coalesce(list_sum(list_transform(regexp_extract_all(lower(s), '[\p{{L}}\p{{N}}_]+'), lambda w: {LOST})), 0) AS hits FROM s)
SELECT doc_id, n >= 500 AND l / greatest(n, 1) >= 0.75 AND hits >= 3 AS lost FROM c""")
def ligature_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", quality.lost_ligatures(F.col("text")).alias("lost"))


MARKERS = " + ".join(f"CAST((length(low) - length(replace(low, '{m}', ''))) / {len(m)} AS INT)" for m in V.GARBLED_MARKERS)


@query(rf"""WITH s AS (SELECT doc_id, substr(text, 1, 5000) AS s, lower(substr(text, 1, 5000)) AS low FROM documents),
c AS (SELECT doc_id, low, len(regexp_extract_all(s, '[A-Za-zА-Яа-яЁё]')) AS n, len(regexp_extract_all(s, '[A-Za-z]')) AS l, len(regexp_extract_all(s, '[А-Яа-яЁё]')) AS k, {MARKERS} AS markers, len(list_filter(regexp_extract_all(s, '[A-Za-zА-Яа-яЁё0-9]{{5,}}'), lambda t: regexp_matches(t, '[0-9]') AND regexp_matches(t, '[A-Za-z]'))) AS numbered FROM s)
SELECT doc_id, n >= 200 AND (markers >= 3 OR (l / greatest(n, 1) > 0.85 AND k / greatest(n, 1) < 0.08 AND markers >= 2 AND numbered >= 3)) AS garbled FROM c""")
def garbled_ocr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", quality.garbled_ocr(F.col("text")).alias("garbled"))


# --- Frames and snippets: a conversation as a video, its turns as frames ---


def _turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("video"), F.col("turn").alias("frame"), "text", F.lit("rus+eng").alias("language"), F.lit("full/enhanced_gray --psm 6").alias("variant"), F.col("turn").alias("seq"))


@query("SELECT video, frame, score FROM (SELECT conv_id AS video, turn AS frame, length(text) AS score, row_number() OVER (PARTITION BY conv_id ORDER BY length(text) DESC, turn) AS r FROM conversations) t WHERE r <= 4")
def top_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    return video.top_frames(_turns(spark, sf_dir).select("video", "frame", F.char_length("text").cast("bigint").alias("score")))


#: Videos of unknown, short and long duration; frames of many shapes.
DURATION = "case when c_custkey % 5 = 0 then null else cast(c_custkey % 400 as double) / 16 end"
KNOWN = "d IS NOT NULL AND d > 0"


@query(f"WITH t AS (SELECT c_custkey, {DURATION} AS d FROM customer), n AS (SELECT *, CASE WHEN {KNOWN} THEN least(8, greatest(1, CAST(floor(d / 0.5) AS INT))) ELSE 8 END AS n FROM t) SELECT c_custkey, n AS frames, round(list_sum(list_transform(range(n), lambda i: i * CASE WHEN {KNOWN} THEN greatest(d - 0.1, 0) / greatest(n - 1, 1) ELSE 0.5 END)), 6) AS seconds FROM n")
def frame_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fixture(spark, sf_dir, f"SELECT c_custkey, {DURATION} AS d FROM customer", "customer").withColumn("at", video.frame_times(F.col("d")))
    return rows.select("c_custkey", F.size("at").cast("bigint").alias("frames"), F.round(F.aggregate("at", F.lit(0.0), lambda a, x: a + x), 6).alias("seconds"))


SHAPE = "SELECT c_custkey, cast(60 + c_custkey * 37 % 1900 as int) AS w, cast(60 + c_custkey * 53 % 1100 as int) AS h FROM customer"


@query(f"""WITH s AS ({SHAPE}), b AS (SELECT c_custkey, w, h, 'full' AS name, 0 AS x0, 0 AS y0, w AS x1, h AS y1, 0 AS ord FROM s
UNION ALL SELECT c_custkey, w, h, name, CAST(floor(w * a / 100) AS INT), CAST(floor(h * t / 100) AS INT), CAST(floor(w * c / 100) AS INT), CAST(floor(h * d / 100) AS INT), ord FROM s JOIN (VALUES (TRUE, 'middle_band', 0, 22, 100, 78, 1), (TRUE, 'document_band', 0, 30, 100, 72, 2), (TRUE, 'lower_band', 0, 32, 100, 85, 3), (FALSE, 'center_band', 8, 0, 92, 100, 1), (FALSE, 'middle_strip', 10, 12, 90, 88, 2), (FALSE, 'lower_strip', 8, 30, 92, 100, 3)) v(upright, name, a, t, c, d, ord) ON upright = (h >= w)
UNION ALL SELECT c_custkey, w, h, 'detected_document_1', 0, 0, w, least(h, 300), 4 FROM s WHERE c_custkey % 3 = 0),
k AS (SELECT *, row_number() OVER (PARTITION BY c_custkey, x0, y0, x1, y1 ORDER BY ord) AS r FROM b WHERE x1 - x0 >= 80 AND y1 - y0 >= 80)
SELECT c_custkey, string_agg(name || ' ' || x0 || ' ' || y0 || ' ' || x1 || ' ' || y1, '; ' ORDER BY ord) AS boxes FROM k WHERE r = 1 GROUP BY c_custkey""")
def frame_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bands and a found document's box, clamped; small and repeated boxes left out."""
    rows = _customers(spark, sf_dir, SHAPE)
    found = F.when(F.col("c_custkey") % 3 == 0, F.array(F.lit(-5), F.lit(-5), F.col("w") + 5, F.lit(300)))
    said = F.transform("regions", lambda b: F.concat_ws(" ", b["name"], F.array_join(b["box"].cast("array<string>"), " ")))
    return text.settled(rows.withColumn("regions", video.regions(F.col("w"), F.col("h"), found))).where(F.size("regions") > 0).select("c_custkey", F.array_join(said, "; ").alias("boxes"))


@query("SELECT l_orderkey, l_linenumber, round(l_discount * 4 + l_tax + l_quantity / 100, 9) AS score FROM lineitem")
def frame_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", F.round(video.frame_score(F.col("l_discount"), F.col("l_tax"), F.col("l_quantity") / 100), 9).alias("score"))


@query()
def snippet_greedy(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = video.frame_candidates(video.scored(_turns(spark, sf_dir)))
    return video.snippets(best).select("video", F.array_join("snippets", "\n\n").alias("text"))


# --- Tables ---


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as five tables by nation modulo 5, with a column of names, of numbers and of contacts."""
    rows = _fixture(spark, sf_dir, f"SELECT 'tables/' || cast(c_nationkey % 5 as string) || '.csv' AS relative_path, '.csv' AS extension, cast(1 as bigint) AS size_bytes, c_custkey, case when c_custkey % 2 = 0 then 'Иванов Иван' else '' end AS person, {X.INN} AS inn, case when c_custkey % 4 = 0 then 'u' || cast(c_custkey as string) || '@example.com' end AS contact FROM customer", "customer")
    return tables.wide_rows(_numbered(rows), ["person", "inn", "contact"])


def _numbered(rows: DataFrame) -> DataFrame:
    """rows with row_no in each file, dealt over all tasks: numbering leaves a file's rows in one."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy("relative_path").orderBy("c_custkey"))
    return dealt(rows.withColumn("row_no", place), "relative_path", "row_no")


#: Found in a row: a name at even keys, a valid number where the key isn't divisible by 3, an address where it is by 4.
CELL_ROWS = "SELECT 'tables/' || CAST(c_nationkey % 5 AS VARCHAR) || '.csv' AS relative_path, c_custkey % 2 = 0 AS has_name, c_custkey % 3 <> 0 AS has_inn, c_custkey % 4 = 0 AS has_email FROM customer"


@query(f"SELECT relative_path, count(*) AS rows_analyzed, count(CASE WHEN has_name OR has_inn OR has_email THEN 1 END) AS rows_with_pii, 0 AS rows_with_sensitive_pii, 0 AS rows_with_sensitive_combo, floor(count(CASE WHEN has_name OR has_inn OR has_email THEN 1 END) * 10000.0 / count(*) + 0.5) / 10000 AS pii_row_ratio FROM ({CELL_ROWS}) c GROUP BY 1")
def table_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = ("rows_analyzed", "rows_with_pii", "rows_with_sensitive_pii", "rows_with_sensitive_combo")
    return tables.summarise(_cells(spark, sf_dir)).select("relative_path", *(F.col(f"table_analysis.{c}").cast("bigint").alias(c) for c in whole), F.col("table_analysis.pii_row_ratio").alias("pii_row_ratio"))


#: Tables of people: a name at even keys, a passport's number where the key is divisible by 3, a card where it is by 5.
PRIVATE = "SELECT 'p' || cast(c_nationkey % 4 as string) || '.csv' AS relative_path, '.csv' AS extension, cast(1 as bigint) AS size_bytes, c_custkey, case when c_custkey % 2 = 0 then 'Иванов Иван' else '' end AS person, case when c_custkey % 3 = 0 then 'паспорт: 4510 123456' end AS doc, case when c_custkey % 5 = 0 then 'visa 4111 1111 1111 1111' else 'nan' end AS card FROM customer"
PRIVATE_ROWS = "SELECT 'p' || CAST(c_nationkey % 4 AS VARCHAR) || '.csv' AS relative_path, c_custkey % 2 = 0 AS name, c_custkey % 3 = 0 AS doc, c_custkey % 5 = 0 AS card, c_custkey, row_number() OVER (PARTITION BY c_nationkey % 4 ORDER BY c_custkey) AS row_no FROM customer"
PRIVATE_COUNTS = f"SELECT relative_path, count(*) AS rows_analyzed, least(count(*), 5000) AS row_detail_rows_scanned, count(CASE WHEN row_no <= 5000 AND (name OR doc OR card) THEN 1 END) AS rows_with_pii, count(CASE WHEN row_no <= 5000 AND (doc OR card) THEN 1 END) AS rows_with_sensitive_pii, count(CASE WHEN row_no <= 5000 AND ((name AND (doc OR card)) OR (doc AND card)) THEN 1 END) AS rows_with_sensitive_combo FROM ({PRIVATE_ROWS}) p GROUP BY relative_path"


def _private(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _fixture(spark, sf_dir, PRIVATE, "customer")
    return tables.wide_rows(_numbered(rows), ["person", "doc", "card"])


@query(f"SELECT *, round(rows_with_pii / rows_analyzed, 4) AS pii_row_ratio, round(rows_with_sensitive_pii / rows_analyzed, 4) AS sensitive_row_ratio, round(rows_with_sensitive_combo / rows_analyzed, 4) AS combo_row_ratio, 3 AS columns_total, 3 AS sensitive_column_count, 3 AS pii_column_count, 'ok' AS status, 'csv' AS sheets FROM ({PRIVATE_COUNTS}) c")
def table_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of tables with sensitive rows, combinations and columns."""
    counts = ("rows_analyzed", "row_detail_rows_scanned", "rows_with_pii", "rows_with_sensitive_pii", "rows_with_sensitive_combo", "columns_total", "sensitive_column_count", "pii_column_count")
    a = tables.summarise(_private(spark, sf_dir), detail=tables.ROW_DETAIL).select("relative_path", "table_analysis.*")
    return a.select("relative_path", *(F.col(c).cast("bigint").alias(c) for c in counts), "pii_row_ratio", "sensitive_row_ratio", "combo_row_ratio", "status", F.array_join("sheets", ",").alias("sheets"))


@query(f"SELECT relative_path, combo, count(*) AS rows FROM (SELECT relative_path, CASE WHEN name AND doc AND card THEN 'bank_card+full_name+passport_rf' WHEN name AND doc THEN 'full_name+passport_rf' WHEN name AND card THEN 'bank_card+full_name' ELSE 'bank_card+passport_rf' END AS combo FROM ({PRIVATE_ROWS}) p WHERE row_no <= 5000 AND ((name AND (doc OR card)) OR (doc AND card))) q GROUP BY 1, 2")
def table_combinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = tables.summarise(_private(spark, sf_dir), detail=tables.ROW_DETAIL)
    return a.select("relative_path", F.explode("table_analysis.row_combinations").alias("combo", "rows"))


@query(f"""WITH c AS ({PRIVATE_COUNTS}) SELECT relative_path, CASE WHEN rows_with_sensitive_combo > 0 THEN '{V.ID_TABLE}' ELSE '{V.UNKNOWN}' END AS document_type,
  CASE WHEN rows_with_sensitive_combo >= 10 OR round(rows_with_sensitive_combo / rows_analyzed, 4) >= 0.2 THEN 8 WHEN rows_with_sensitive_combo > 0 THEN 5 ELSE 0 END + CASE WHEN rows_with_sensitive_pii >= 20 THEN 6 WHEN rows_with_sensitive_pii >= 3 THEN 4 ELSE 0 END
  + CASE WHEN rows_with_pii >= 50 OR round(rows_with_pii / rows_analyzed, 4) >= 0.3 THEN 4 WHEN rows_with_pii >= 10 THEN 2 ELSE 0 END + 3 AS massiveness_score, CASE WHEN rows_with_sensitive_combo > 0 THEN 6 ELSE 0 END AS context_score FROM c""")
def table_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the rules on tables add to files whose own text holds nothing."""
    summary = written(tables.summarise(_private(spark, sf_dir), detail=tables.ROW_DETAIL), "private")
    files = summary.select("relative_path", F.lit(".csv").alias("extension"), F.lit(1).cast("bigint").alias("size_bytes"), F.lit("").alias("text"))
    return score(files, summary).select("relative_path", "document_type", *(F.col(p).cast("bigint").alias(p) for p in ("massiveness_score", "context_score")))


@query(f"""SELECT relative_path, category, count(*) AS rows FROM (SELECT relative_path, 'full_name' AS category FROM ({CELL_ROWS}) c WHERE has_name UNION ALL SELECT relative_path, 'inn_legal' FROM ({CELL_ROWS}) c WHERE has_inn UNION ALL SELECT relative_path, 'email' FROM ({CELL_ROWS}) c WHERE has_email) u GROUP BY 1, 2""")
def table_row_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.row_categories(tables.probed(_cells(spark, sf_dir))).select("relative_path", F.explode("names").alias("category")).groupBy("relative_path", "category").agg(F.count("*").alias("rows"))


@query(f"SELECT DISTINCT relative_path, \"column\", category FROM (SELECT relative_path, 'csv:person' AS \"column\", 'full_name' AS category FROM ({CELL_ROWS}) c WHERE has_name UNION ALL SELECT relative_path, 'csv:inn', 'inn_legal' FROM ({CELL_ROWS}) c WHERE has_inn UNION ALL SELECT relative_path, 'csv:contact', 'email' FROM ({CELL_ROWS}) c WHERE has_email) u")
def table_col_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.column_categories(tables.probed(_cells(spark, sf_dir))).select("relative_path", "column", F.explode("names").alias("category"))


def _combo_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = written(detect(people(spark, sf_dir)).select("c_custkey", F.array_sort(F.map_keys("categories")).alias("names")), "found")
    both = F.array_join(F.array_sort(F.array_intersect("names", F.lit(list(V.IDENTIFIER_TABLE)))), "+")
    return found.select(F.concat(F.lit("group/"), (F.col("c_custkey") % 5).cast("string")).alias("relative_path"), F.lit("s").alias("sheet"), F.col("c_custkey").alias("row_no"), F.when(tables.sensitive_combo(F.col("names")) & (both != ""), both).alias("combo"))


@query("SELECT relative_path, combo, rows, row_number() OVER (PARTITION BY relative_path ORDER BY rows DESC, first) AS place FROM (SELECT 'group/' || CAST(c_custkey % 5 AS VARCHAR) AS relative_path, CASE c_custkey % 9 WHEN 0 THEN 'email+full_name+phone' ELSE 'bank_card+phone' END AS combo, count(*) AS rows, min(c_custkey) AS first FROM customer WHERE c_custkey % 9 IN (0, 3) GROUP BY 1, 2) t")
def combos_top50(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.combos(_combo_rows(spark, sf_dir))


# --- Reports ---


@query(f"WITH f AS ({X.FILES}), s AS (SELECT CASE WHEN doc_id % 23 = 0 OR extension NOT IN {_in(SUPPORTED)} OR size_bytes > 104857600 THEN 'skipped' WHEN doc_id % 11 = 0 THEN 'error' ELSE 'processed' END AS b FROM f) SELECT count(*) + 3 AS total_files, count(CASE WHEN b = 'processed' THEN 1 END) AS processed_files, count(CASE WHEN b = 'skipped' THEN 1 END) + 3 AS skipped_files, count(CASE WHEN b = 'error' THEN 1 END) AS error_files FROM s")
def run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = document_files(spark, sf_dir)
    state, _ = routing.status(F.substring_index("relative_path", "/", -1), F.col("extension"), F.col("size_bytes"))
    bucket = F.when(state == "skipped", state).when(F.col("doc_id") % 11 == 0, "error").otherwise("processed")
    return sinks.run_stats(files.select(bucket.alias("bucket")), spark.range(3).select(F.col("id").cast("string").alias("relative_path")))


@query("SELECT '/' || source AS line FROM (SELECT source, min(doc_id) AS m FROM documents GROUP BY source) t")
def leaked_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return sinks.leaked_paths(docs.select(F.concat(F.lit("\\"), "source").alias("relative_path"), F.lit("").alias("path"), F.col("doc_id").alias("ord")))


@query(f"SELECT relative_path AS \"путь\", extension AS \"формат_файла\", document_type AS \"тип_документа\", CASE WHEN risk_score >= 11 THEN 'high' WHEN risk_score >= 6 THEN 'medium' ELSE 'low' END || ' (' || CAST(risk_score AS VARCHAR) || ')' AS \"риск_утечки\" FROM ({SCORES}) r JOIN ({X.PEOPLE}) p ON p.c_custkey = r.c_custkey".replace("SELECT relative_path AS", "SELECT p.relative_path AS").replace("extension AS \"ф", "p.extension AS \"ф").replace("document_type AS \"т", "r.document_type AS \"т"))
def report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.csv_rows(sinks.report_rows(score(people(spark, sf_dir)))).select("путь", "формат_файла", "тип_документа", "риск_утечки")


@query()
def document_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain over all documents, as files in a tree."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("relative_path"), F.lit(".txt").alias("extension"), F.col("n_chars").alias("size_bytes"), "text")
    return score(docs).select("doc_id", F.array_sort(F.map_keys("categories")).cast("string").alias("categories"), "document_type", "risk_score", "risk_level", "include_in_report")


def entry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk of the documents together with the texts of known contents."""
    known = people(spark, sf_dir).select("relative_path", "extension", "size_bytes", "text")
    docs = table(spark, sf_dir, "documents").select(F.concat("source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("relative_path"), F.lit(".txt").alias("extension"), F.col("n_chars").alias("size_bytes"), "text")
    rows = assess(with_features(detect(known.unionByName(docs))))
    return rows.select("relative_path", "document_type", "risk_score", "risk_level", "include_in_report", F.array_sort(F.map_keys("categories")).alias("categories"))
