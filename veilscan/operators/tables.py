"""Personal data in tables, by row and by column.

Input is one row for each row of a table: rows(relative_path, extension, size_bytes, sheet, row_no, cells), with row_no
from 1 in each sheet and cells an array of (col_no, col_name, value).  Row 0 names the columns of a sheet without rows,
and a column problem, where there is one, says why a table can't be read.  Rows become probe texts where they are;
columns gather the first values of each.  Probes go through detect(), then summaries.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import vocab as V
from ..session import written
from .detect import detect
from .features import half_even

#: Rows of a sheet that a scan of files looks at one by one; values of a column looked at together; listed combinations and columns.
ROW_DETAIL, COLUMN_SAMPLE, TOP_COMBOS, TOP_COLUMNS, TOP_SENSITIVE = 5000, 300, 50, 50, 100
FILE = ("relative_path", "extension", "size_bytes")


def wide_rows(table: DataFrame, columns: list[str], sheet: str = "csv", row_no: str = "row_no", keep: tuple[str, ...] = FILE) -> DataFrame:
    """A wide table with file columns and row numbers as rows with cells; null values stay null."""
    cells = F.array(*(F.struct(F.lit(i).alias("col_no"), F.lit(c).alias("col_name"), F.col(c).cast("string").alias("value")) for i, c in enumerate(columns)))
    return table.select(*keep, F.lit(sheet).alias("sheet"), F.col(row_no).cast("int").alias("row_no"), cells.alias("cells"))


def column_probes(rows: DataFrame) -> DataFrame:
    """sheet:column and a text of its name and first values, blank ones too."""
    first = rows.where(F.col("row_no") <= COLUMN_SAMPLE).select(*FILE, "sheet", "row_no", F.explode("cells").alias("cell")).select(*FILE, "sheet", "row_no", "cell.*")
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("row_no") > 0, F.struct("row_no", F.coalesce("value", F.lit("")).alias("value"))))), lambda x: x["value"])
    grouped = first.groupBy(*FILE, "sheet", "col_no", "col_name").agg(listed.alias("values_"))
    return grouped.select(*FILE, F.concat("sheet", F.lit(":"), "col_name").alias("column"), F.array_join(F.concat(F.array("col_name"), "values_"), " | ").alias("text"))


def row_probes(rows: DataFrame, detail: int | None = None) -> DataFrame:
    """A text `ROW n: column: value | ...` of every row with values, or of a sheet's first `detail` rows; blank and nan values are left out.  A projection."""
    full = F.filter("cells", lambda c: c["value"].isNotNull() & (c["value"] != "") & (F.lower(c["value"]) != "nan"))
    line = F.array_join(F.transform(full, lambda c: F.concat(c["col_name"], F.lit(": "), c["value"])), " | ")
    detailed = rows.where(F.col("row_no") >= 1 if detail is None else F.col("row_no").between(1, detail)).select(*FILE, "sheet", "row_no", line.alias("line_"))
    return detailed.where("line_ != ''").select(*FILE, "sheet", "row_no", F.concat(F.lit("ROW "), F.col("row_no").cast("string"), F.lit(": "), F.col("line_")).alias("text"))


def probed(rows: DataFrame, detail: int | None = None) -> DataFrame:
    """FILE, names, and sheet and row_no of a row or column of a column, of all probes in which something is found; written, as summaries read it again and again."""
    probes = row_probes(rows, detail).unionByName(column_probes(rows), allowMissingColumns=True)
    found = detect(probes).select(*FILE, "sheet", "row_no", "column", F.array_sort(F.map_keys("categories")).alias("names"))
    return written(found.where(F.size("names") > 0), "probes")


def _within(names: Column, of: tuple[str, ...]) -> Column:
    return F.array_intersect(names, F.lit(list(of)))


def sensitive_combo(names: Column) -> Column:
    """A name with something sensitive, two sensitive categories, or three identifiers."""
    sensitive = F.size(_within(names, V.SENSITIVE_TABLE))
    return (F.array_contains(names, "full_name") & (sensitive > 0)) | (sensitive >= 2) | (F.size(_within(names, V.IDENTIFIER_TABLE)) >= 3)


def row_categories(found: DataFrame) -> DataFrame:
    """FILE, sheet, row_no, names, sensitive, combo (identifiers joined by +, or null) of rows in which something is found (see probed)."""
    rows = found.where("row_no is not null").select(*FILE, "sheet", "row_no", "names")
    both = F.array_join(F.array_sort(_within(F.col("names"), V.IDENTIFIER_TABLE)), "+")
    return rows.withColumns({"sensitive": F.size(_within(F.col("names"), V.SENSITIVE_TABLE)) > 0, "is_combo": sensitive_combo(F.col("names")), "combo": F.when(sensitive_combo(F.col("names")) & (both != ""), both)})


def column_categories(found: DataFrame) -> DataFrame:
    """FILE, column, names of columns in which something is found (see probed)."""
    return found.where("column is not null").select(*FILE, "column", "names")


def combos(rows: DataFrame, top: int = TOP_COMBOS) -> DataFrame:
    """relative_path, combo, rows, place: the most frequent combinations of a file, ties by first appearance."""
    counted = rows.where(F.col("combo").isNotNull()).groupBy("relative_path", "combo").agg(F.count("*").alias("rows"), F.min(F.struct("sheet", "row_no")).alias("first_"))
    place = F.row_number().over(Window.partitionBy("relative_path").orderBy(F.col("rows").desc(), "first_"))
    return counted.withColumn("place", place).where(F.col("place") <= top).select("relative_path", "combo", "rows", "place")


def summarise(table_rows: DataFrame, max_rows: int | None = None, detail: int | None = None) -> DataFrame:
    """relative_path and table_analysis for every file with rows.

    All rows are analysed, one by one too.  A scan of files sets limits: sheets are cut at max_rows rows, and only the
    first `detail` of them are looked at one by one.  Ratios are to all analysed rows.
    """
    kept = table_rows if max_rows is None else table_rows.where(F.col("row_no") <= max_rows)
    scanned = F.col("n") if detail is None else F.least("n", F.lit(detail))
    sheets = kept.groupBy("relative_path", "sheet").agg(F.max("row_no").alias("n"), F.coalesce(F.max(F.size("cells")), F.lit(0)).alias("c"))
    problems = kept.groupBy("relative_path").agg(F.max("problem").alias("problem")) if "problem" in kept.columns else None
    shape = sheets.groupBy("relative_path").agg(F.sum("n").cast("int").alias("rows_analyzed"), F.sum("c").cast("int").alias("columns_total"), F.array_sort(F.collect_set("sheet")).alias("sheets"), F.sum(scanned).cast("int").alias("detail"))
    probes = probed(kept, detail)
    rows = row_categories(probes)
    per_row = rows.groupBy("relative_path").agg(F.count("*").cast("int").alias("rows_with_pii"), F.count_if("sensitive").cast("int").alias("rows_with_sensitive_pii"), F.count_if("is_combo").cast("int").alias("rows_with_sensitive_combo"))
    by_category = rows.select("relative_path", F.explode("names").alias("category")).groupBy("relative_path", "category").count()
    by_category = by_category.groupBy("relative_path").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "count")))).alias("category_row_counts"))
    ranked = combos(rows).groupBy("relative_path").agg(F.map_from_entries(F.transform(F.array_sort(F.collect_list(F.struct("place", "combo", "rows"))), lambda x: F.struct(x["combo"], x["rows"]))).alias("row_combinations"))
    found = column_categories(probes).select("relative_path", "column", F.explode("names").alias("category"))
    listed = found.groupBy("relative_path", "category").agg(F.slice(F.array_sort(F.collect_set("column")), 1, TOP_COLUMNS).alias("columns"))
    columns = listed.groupBy("relative_path").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "columns")))).alias("pii_columns"), F.sum(F.size("columns")).cast("int").alias("pii_column_count"))
    private = found.where(F.col("category").isin(*V.SENSITIVE_TABLE, *V.IDENTIFIER_TABLE)).groupBy("relative_path").agg(F.slice(F.array_sort(F.collect_set("column")), 1, TOP_SENSITIVE).alias("sensitive_columns"))
    joined = shape
    for part in (per_row, by_category, ranked, columns, private, problems):
        joined = joined if part is None else joined.join(part, "relative_path", "left")
    problem = F.lit(None).cast("string") if problems is None else F.col("problem")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    all_rows = F.greatest(F.col("rows_analyzed"), F.lit(1))
    ratio = lambda c: half_even(zero(c) / all_rows, 4)
    cut = F.lit(None).cast("string") if max_rows is None else F.when(F.col("rows_analyzed") >= max_rows, F.lit(f"Table analysis limited to max_rows={max_rows}"))
    short = F.when(F.col("detail") < F.col("rows_analyzed"), F.concat(F.lit("Row-level table detail limited to "), F.col("detail").cast("string"), F.lit(" rows; full-file PII detection still used extracted text")))
    analysis = F.struct(
        F.when(problem.isNull(), "ok").otherwise("error").alias("status"), F.col("rows_analyzed").alias("rows_total_known"), "rows_analyzed", "columns_total", "sheets", *(zero(c).alias(c) for c in ("rows_with_pii", "rows_with_sensitive_pii", "rows_with_sensitive_combo")),
        "category_row_counts", "row_combinations", "pii_columns", "sensitive_columns", F.col("detail").alias("row_detail_rows_scanned"), ratio("rows_with_pii").alias("pii_row_ratio"), ratio("rows_with_sensitive_pii").alias("sensitive_row_ratio"), ratio("rows_with_sensitive_combo").alias("combo_row_ratio"),
        zero("pii_column_count").alias("pii_column_count"), F.coalesce(F.size("sensitive_columns"), F.lit(0)).alias("sensitive_column_count"), F.filter(F.array(problem, cut, short), lambda w: w.isNotNull()).alias("warnings"),
    )
    return joined.select("relative_path", analysis.alias("table_analysis"))
