"""Findings, reports, logs and the list of leaked paths."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import escape_markdown, file_id, report_path

#: Headers of the CSV report and the head of the Markdown report (fixed values).
CSV_HEADERS = ("путь", "формат_файла", "тип_документа", "категории_ПДн", "количество_находок", "риск_утечки", "обоснование", "рекомендация")
MD_TITLE = "# Итоговый отчет по высокорисковым файлам"
MD_METHOD = "Подход: рекурсивное сканирование, извлечение текстового слоя, поиск категорий ПДн, прозрачный риск-скоринг."
MD_COUNTS = ("- Всего файлов: {}", "- Обработано: {}", "- Пропущено: {}", "- Ошибок: {}", "- В отчете: {}")
MD_HEADERS = ("Путь", "Формат", "Тип документа", "Категории ПДн", "Риск", "Обоснование", "Рекомендация")


def report_rows(assessed: DataFrame, output: str = "", per_file: bool = True) -> DataFrame:
    """What a report has of each assessed row: 14 columns, and ord where there is one.

    per_file: whether texts and findings are files; else the paths are those of the tables.
    """
    ident = file_id(F.col("relative_path"))
    table = F.col("table_analysis") if "table_analysis" in assessed.columns else F.lit(None).cast("string")
    path = F.col("path") if "path" in assessed.columns else F.col("relative_path")
    columns = [
        path.alias("path"), F.col("relative_path"), F.col("extension").alias("file_format"), "document_type", F.array_sort(F.map_keys("categories")).alias("pii_categories"), F.transform_values("categories", lambda _, v: v["count"]).alias("finding_counts"), "features", "risk_level", "risk_score", "reasons", "recommendation",
        table.alias("table_analysis"), *(F.concat(F.lit(f"{output}/{kind}/"), ident, F.lit(end)).alias(name) if per_file else F.lit(f"{output}/tables/{kind}").alias(name) for kind, end, name in (("extracted_texts", ".txt", "extracted_text_path"), ("pii_findings", ".json", "pii_findings_path"))),
    ]
    return assessed.select(*columns, *(["ord"] if "ord" in assessed.columns else []))


def risk_label() -> Column:
    return F.concat("risk_level", F.lit(" ("), F.col("risk_score").cast("string"), F.lit(")"))


def csv_rows(rows: DataFrame) -> DataFrame:
    """The eight columns of the CSV report, in its words."""
    counts = F.array_join(F.transform(F.array_sort(F.map_entries("finding_counts")), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), "; ")
    values = (F.col("path"), F.col("file_format"), F.col("document_type"), F.array_join("pii_categories", ", "), counts, risk_label(), F.array_join("reasons", "; "), F.col("recommendation"))
    return rows.select(*(v.alias(h) for v, h in zip(values, CSV_HEADERS, strict=True)))


def markdown_lines(rows: DataFrame) -> DataFrame:
    """line: the Markdown table row of each report row."""
    values = (F.col("path"), F.col("file_format"), F.col("document_type"), F.array_join("pii_categories", ", "), risk_label(), F.array_join("reasons", "; "), F.col("recommendation"))
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *map(escape_markdown, values)), F.lit(" |")).alias("line"))


def run_stats(outcomes: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """total_files, processed_files, skipped_files, error_files over outcomes (column bucket); paths that are missing count as skipped."""
    one = outcomes.agg(F.count("*").alias("n"), F.count_if(F.col("bucket") == "processed").alias("p"), F.count_if(F.col("bucket") == "skipped").alias("s"), F.count_if(F.col("bucket") == "error").alias("e"))
    lost = F.lit(0) if missing is None else F.col("m")
    both = one if missing is None else one.crossJoin(missing.agg(F.count("*").alias("m")))  # one row each
    return both.select((F.col("n") + lost).alias("total_files"), F.col("p").alias("processed_files"), (F.col("s") + lost).alias("skipped_files"), F.col("e").alias("error_files"))


def leaked_paths(rows: DataFrame, order: str = "ord") -> DataFrame:
    """line: each reported path once, in the order of its first row; without relative path the file's name."""
    blank = F.coalesce(F.trim("relative_path"), F.lit("")) == ""
    path = F.when(~blank, report_path(F.col("relative_path"))).when(F.trim("path") != "", report_path(F.substring_index("path", "/", -1)))
    return rows.select(path.alias("line"), F.col(order).alias("at_")).where(F.col("line").isNotNull()).groupBy("line").agg(F.min("at_").alias("at_")).orderBy("at_").select("line")


def write_tables(assessed: DataFrame, output: str, per_file: bool = True) -> None:
    """Texts, findings and report items as tables by file_id: a shared file system takes any path length and any number of rows."""
    ident = file_id(F.col("relative_path")).alias("file_id")
    assessed.select(ident, "relative_path", "text").write.mode("overwrite").parquet(f"{output}/tables/extracted_texts")
    assessed.select(ident, "relative_path", F.col("extension").alias("file_format"), "categories", "validation", "features").write.mode("overwrite").json(f"{output}/tables/pii_findings")
    report_rows(assessed.where("include_in_report"), output, per_file).write.mode("overwrite").json(f"{output}/tables/report_items")


def write_files(spark: SparkSession, assessed: DataFrame, output: str) -> None:
    """extracted_texts/<file_id>.txt and pii_findings/<file_id>.json of each row, streamed through the driver."""
    path = F.col("path") if "path" in assessed.columns else F.col("relative_path")
    found = F.to_json(F.struct(path.alias("file_path"), "relative_path", F.col("extension").alias("file_format"), "categories", "features", F.struct("validation", "signals").alias("metadata")))
    for r in assessed.select(file_id(F.col("relative_path")).alias("id"), "text", found.alias("found")).toLocalIterator():
        _put(spark, f"{output}/extracted_texts/{r.id}.txt", [r.text or ""])
        _put(spark, f"{output}/pii_findings/{r.id}.json", [json.dumps(json.loads(r.found), ensure_ascii=False, indent=2)])


def log_rows(outcomes: DataFrame) -> DataFrame:
    """timestamp, file_path, stage, status, message of outcomes with stage, bucket and message."""
    return outcomes.select(F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSXXX").alias("timestamp"), F.col("path").alias("file_path"), F.col("stage"), F.col("bucket").alias("status"), F.coalesce("message", F.lit("")).alias("message"))


def append_log(outcomes: DataFrame, path: str) -> None:
    log_rows(outcomes).write.mode("append").json(path)


def _put(spark: SparkSession, path: str, parts: Iterable[str]) -> None:
    """Write a file through Hadoop's file systems: to a side file first, then renamed."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    final, side = hadoop.Path(path), hadoop.Path(f"{path}.part")
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    stream = fs.create(side, True)
    try:
        for part in parts:
            stream.write(bytearray(part.encode("utf-8")))
    finally:
        stream.close()
    fs.delete(final, False)
    if not fs.rename(side, final):
        raise OSError(f"cannot write {path}")


def write_reports(spark: SparkSession, rows: DataFrame, stats: DataFrame, folder: str) -> None:
    """final_report.csv, .json and .md: single files, streamed row by row in order, so the driver holds one partition at most."""
    ordered = rows.orderBy("ord") if "ord" in rows.columns else rows
    numbers = stats.first().asDict()

    def quoted(v: str) -> str:
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in '",\r\n') else v

    def csv_lines():
        yield "﻿" + ",".join(CSV_HEADERS) + "\r\n"
        for r in csv_rows(ordered).toLocalIterator():
            yield ",".join(quoted(v or "") for v in r) + "\r\n"

    def json_lines():
        yield '{"stats": ' + json.dumps(numbers) + ', "items": ['
        for i, r in enumerate(ordered.select(F.to_json(F.struct(*(c for c in ordered.columns if c != "ord"))).alias("j")).toLocalIterator()):
            yield (",\n" if i else "\n") + r.j
        yield "\n]}\n"

    def md_lines():
        count = rows.count()
        filled = [t.format(n) for t, n in zip(MD_COUNTS, (*(numbers[k] for k in ("total_files", "processed_files", "skipped_files", "error_files")), count), strict=True)]
        yield "\n".join([MD_TITLE, "", MD_METHOD, "", *filled, "", f"| {' | '.join(MD_HEADERS)} |", "|" + "---|" * len(MD_HEADERS)]) + "\n"
        for r in markdown_lines(ordered).toLocalIterator():
            yield r.line + "\n"

    for name, lines in (("csv", csv_lines), ("json", json_lines), ("md", md_lines)):
        _put(spark, f"{folder}/final_report.{name}", lines())


def write_leaked(spark: SparkSession, rows: DataFrame, path: str) -> None:
    _put(spark, path, (r.line + "\n" for r in leaked_paths(rows).toLocalIterator()))


def load_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of a JSON report that are objects; an error where the report has no items."""
    report = spark.read.option("multiLine", "true").json(path)
    if "items" not in report.columns:
        raise ValueError(f"{path} has no items")
    return report.select(F.explode("items").alias("item")).where("item is not null").select("item.*")
