"""The whole scan as one plan: files or texts to findings, features, document types, risk and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import tables as table_ops
from ..operators.detect import detect
from ..operators.features import with_features
from ..operators.risk import assess
from ..operators.routing import match_texts, missing, selected
from ..session import written
from ..sources import files as source
from ..sources import sinks
from ..sources.extract import TABLES


def score(texts: DataFrame, table_analysis: DataFrame | None = None, ocr: Column | None = None) -> DataFrame:
    """texts (relative_path, extension, size_bytes, text) to assessed rows: projections only, but for the join with table summaries.

    ocr: whether a text was recognised; only the full mode knows that.
    """
    if table_analysis is not None:
        summary = table_analysis.withColumnRenamed("relative_path", "of_")
        texts = texts.join(summary, F.col("relative_path") == F.col("of_"), "left").drop("of_")
    return assess(with_features(detect(texts), ocr=ocr), ocr=ocr)


def full(spark: SparkSession, root: str, include: DataFrame | None = None, limit_mb: float = 100.0, max_rows: int = 50_000, use_ocr: bool = True, timeout: float = 600.0) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """First pass: (assessed rows, outcomes of all files, missing paths).

    Files are listed by name and size; only pending ones are opened, once for their texts and tables once more for their
    rows, and what is read is written before it is scored.  ord is the path: reports list files in that order.
    """
    listed = source.scan(spark, root, limit_mb)
    lost = None
    if include is not None:
        lost, listed = missing(listed, include), selected(listed, include)
    listed = written(listed, "listed")
    reach = {"limit_mb": limit_mb, "chosen": include is not None}
    texts = written(source.read_texts(source.contents(spark, root, listed, **reach), use_ocr, max_rows, timeout), "texts")
    rows = written(source.table_rows(source.contents(spark, root, listed, TABLES, **reach), max_rows, timeout), "table-rows")
    good = texts.where("extract_status = 'ok'").withColumn("ord", F.col("path"))
    scored = score(good, table_ops.summarise(rows, max_rows, table_ops.ROW_DETAIL), F.coalesce(F.element_at("metadata", "ocr_used") == "true", F.lit(False)))
    skipped = listed.where("status <> 'pending'").select("path", F.lit("skipped").alias("bucket"), F.lit("scan").alias("stage"), F.col("error").alias("message"))
    read = texts.select("path", F.when(F.col("extract_status") == "ok", "processed").otherwise(F.col("extract_status")).alias("bucket"), F.lit("process").alias("stage"), F.array_join("warnings", "; ").alias("message"))
    return written(scored, "scored"), skipped.unionByName(read), lost


def text_only(texts: DataFrame, originals: DataFrame) -> DataFrame:
    """Second pass: texts (text_path, text, text_bytes) matched with their originals and scored without table analysis or recognition data."""
    return score(match_texts(texts, originals))


def run(spark: SparkSession, root: str, output: str, include: DataFrame | None = None, limit_mb: float = 100.0, max_rows: int = 50_000, use_ocr: bool = True, timeout: float = 600.0, per_file: bool = True) -> None:
    """Scan root; write tables, reports, the log and leaked_paths.txt below output.

    per_file: also one text and one file of findings for each file, as reports name them.  They go through the driver one
    by one; without them reports name the tables, which hold the same by file_id and take any number of files.
    """
    scored, outcomes, lost = full(spark, root, include, limit_mb, max_rows, use_ocr, timeout)
    sinks.write_tables(scored, output, per_file)
    if per_file:
        sinks.write_files(spark, scored, output)
    _report(spark, scored, outcomes, lost, output, per_file)


def rerun(spark: SparkSession, texts: DataFrame, root: str, output: str) -> None:
    """Second pass over texts (text_path, text, text_bytes), with root as their originals: tables, reports, the log and leaked_paths.txt."""
    scored = written(text_only(texts, source.scan(spark, root)), "rescored")
    sinks.write_tables(scored, output, False)
    outcomes = scored.select("relative_path", F.col("text_path").alias("path"), F.lit("processed").alias("bucket"), F.lit("reprocess").alias("stage"), F.when(F.col("matched"), "").otherwise("original file not found").alias("message"))
    _report(spark, scored, outcomes, None, output, False)


def both(spark: SparkSession, root: str, folder: str, **options) -> None:
    """Both passes in one run: texts and first results below folder/parsed, the final reports and leaked_paths.txt below folder/final."""
    run(spark, root, f"{folder}/parsed", **options)
    texts = spark.read.parquet(f"{folder}/parsed/tables/extracted_texts")
    rerun(spark, texts.select(F.concat(F.lit(f"{folder}/parsed/extracted_texts/"), "file_id", F.lit(".txt")).alias("text_path"), "text", F.octet_length("text").cast("bigint").alias("text_bytes")), root, f"{folder}/final")


def _report(spark: SparkSession, scored: DataFrame, outcomes: DataFrame, lost: DataFrame | None, output: str, per_file: bool) -> None:
    sinks.append_log(outcomes, f"{output}/logs")
    rows = sinks.report_rows(scored.where("include_in_report"), output, per_file)
    sinks.write_reports(spark, rows, sinks.run_stats(outcomes, lost), f"{output}/reports")
    sinks.write_leaked(spark, rows, f"{output}/leaked_paths.txt")
