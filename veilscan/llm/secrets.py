"""Secret scans over an incremental blob ledger.

Every version of a text is addressed by its content (a blob).  The ledger holds one row for each scanned pair of blob and
rule version, with the spans found.  A scan reduces its input to distinct blobs, leaves out pairs that the ledger has,
scans the rest once, appends them, and joins spans back to all paths.  Only DataFrame functions are used.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, shared_dir, text_bytes


@dataclass(frozen=True)
class Rule:
    """kind; a cheap regex that any text with a match has; the regex; least length of a group of the match."""

    kind: str
    gate: str
    pattern: str
    group: int = 0
    least: int = 0


#: The first three are the base; the order is that of kinds at equal starts.  `{24,}` and `{16,}` are the greedy runs that pass the length test, as such runs are maximal.
RULES = (
    Rule("assign", r"(?i)(?:passw|secret|token|api_?key)", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16}", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24}", r"[0-9a-f]{24,}"),
    Rule("pem", r"-----BEGIN ", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8}", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]", r"gh[pousr]_[A-Za-z0-9]{36,}"),
)
BASE = 3
SPAN = "array<struct<start:bigint,rank:int,end:bigint>>"


def rule_version(rules: tuple[Rule, ...] = RULES) -> str:
    """Changes with any rule."""
    return hashlib.sha256(json.dumps([vars(r) for r in rules]).encode()).hexdigest()[:16]


def _raw(rule: Rule, text: Column) -> list[Column]:
    hit, k, p = text.rlike(rule.gate), rule.kind, F.lit(rule.pattern)
    size = lambda x: F.char_length(x).cast("bigint")
    return [
        F.when(hit, F.transform(F.regexp_extract_all(text, p, F.lit(0)), size)).alias(f"m_{k}"),
        F.when(hit, F.transform(F.split(text, rule.pattern, -1), size)).alias(f"g_{k}"),
        F.when(hit, F.transform(F.regexp_extract_all(text, p, F.lit(rule.group)), size)).alias(f"v_{k}"),
    ]


def _spans(rule: Rule, rank: int) -> Column:
    """Spans in code points: each match starts after the gaps and the matches before it."""
    k = rule.kind
    none = F.array().cast(SPAN)
    parts = F.arrays_zip(F.col(f"m_{k}").alias("m"), F.col(f"g_{k}").alias("g"), F.col(f"v_{k}").alias("v"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["g"]
        end = start + x["m"]
        span = F.array(F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"))).cast(SPAN)
        return F.struct(end.alias("at"), F.when(x["v"] >= rule.least, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out"))

    parts = F.filter(parts, lambda x: x["m"].isNotNull())  # the last gap has no match after it
    found = F.aggregate(parts, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.size(f"m_{k}") > 0, found).otherwise(none)


def find_spans(texts: DataFrame, text_col: str, keep: list[str], rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """keep and spans (sorted by start, then rank) of each row."""
    raw = texts.select(*keep, *(c for r in rules for c in _raw(r, F.col(text_col))))
    return raw.select(*keep, F.sort_array(F.concat(*(_spans(r, i) for i, r in enumerate(rules)))).alias("spans"))


def blob_id(text_col: str = "text") -> Column:
    return F.sha2(text_bytes(text_col), 256)


def new_ledger(df: DataFrame) -> str:
    """A place for a ledger in the folder that executors share."""
    return f"{shared_dir(df.sparkSession)}/ledger-{uuid.uuid4().hex}"


def _ledger(df: DataFrame, path: str, version: str) -> DataFrame | None:
    spark = df.sparkSession
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not there.getFileSystem(spark._jsc.hadoopConfiguration()).exists(there):
        return None
    return spark.read.schema(f"blob string, spans {SPAN}, rule_version string").parquet(path).where(F.col("rule_version") == version)


def update_ledger(versions: DataFrame, path: str, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """Scan what the ledger lacks of versions under these rules, append it, and return the rule version's ledger rows."""
    version = rule_version(rules)
    blobs = versions.select(blob_id(text_col).alias("blob"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("content")).groupBy("blob").agg(F.first("content").alias("content"))
    known = _ledger(versions, path, version)
    if known is not None:
        blobs = blobs.join(known.select(F.col("blob").alias("known")).distinct(), F.col("blob") == F.col("known"), "left_anti")
    find_spans(blobs, "content", ["blob"], rules).withColumn("rule_version", F.lit(version)).write.mode("append").partitionBy("rule_version").parquet(path)
    # A task that was run again can't leave a pair twice; writers that ran side by side can.
    return _ledger(versions, path, version).groupBy("blob").agg(F.first("spans").alias("spans"))


def scan(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, blob, spans for every row of docs: null and empty texts have none, repeated rows are each returned.

    ledger: folder of the ledger, kept from scan to scan; by default a new one.
    """
    rows = update_ledger(docs, ledger or new_ledger(docs), rules, text_col).withColumnsRenamed({"blob": "scanned"})
    paths = docs.select(F.col(id_col).alias("doc_id"), blob_id(text_col).alias("blob"))
    return paths.join(rows, F.col("blob") == F.col("scanned")).select("doc_id", "blob", "spans")


def listed(spans: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """kind:start:end of spans, comma-joined."""
    kinds = F.lit([r.kind for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, ledger: str | None = None, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """docs with every span of text_col replaced by <kind>; overlapping spans become one, named by the first.  Other columns stay."""
    own, scanned, spans = free_names(docs, "blob_", "scanned_blob_", "found_spans_")
    rows = update_ledger(docs, ledger or new_ledger(docs), rules, text_col).where(F.size("spans") > 0).select(F.col("blob").alias(scanned), F.col("spans").alias(spans))
    text, kinds = F.col(text_col), F.lit([r.kind for r in rules])
    zero = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        # at: end of what is already covered; substr is by code points, from 1
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        fresh = F.concat(acc["out"], F.array(gap, F.concat(F.lit("<"), F.get(kinds, s["rank"]), F.lit(">"))))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], fresh).otherwise(acc["out"]).alias("out"))

    new = F.aggregate(F.col(spans), zero, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substr(text, (acc["at"] + 1).cast("int"))))
    joined = docs.withColumn(own, blob_id(text_col)).join(rows, F.col(own) == F.col(scanned), "left")
    return joined.withColumn(text_col, F.when(F.col(spans).isNotNull(), new).otherwise(text)).select(*docs.columns)
