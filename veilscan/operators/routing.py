"""Which files are read, by which extractor, and which original a text belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab as V
from ..functions.text import file_id
from ..session import written


def status(name: Column, extension: Column, size: Column, limit_mb: float = 100.0) -> tuple[Column, Column]:
    """status and error of a file by its name, suffix and size; the first reason to skip counts."""
    shown = F.when(extension == "", "<none>").otherwise(extension)
    error = F.when(name.startswith("~$"), "Temporary Office lock file").when(~extension.isin(*V.SUPPORTED_EXT), F.concat(F.lit("Unsupported extension: "), shown)).when(size > int(limit_mb * 1024 * 1024), F.concat(F.lit("File is larger than limit: "), size.cast("string"), F.lit(" bytes")))
    return F.when(error.isNotNull(), "skipped").otherwise("pending"), error


def include_key(path: Column) -> Column:
    return F.ltrim(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/"))


def include_list(lines: DataFrame, column: str = "value") -> DataFrame:
    """relative_path: distinct wanted paths; blank lines and those that begin with # are no paths."""
    line = F.replace(F.regexp_replace(F.col(column), r"(?U)\A[\s\x{FEFF}]+|[\s\x{FEFF}]+\z", ""), F.lit("﻿"), F.lit(""))
    return lines.select(line.alias("line")).where((F.col("line") != "") & ~F.col("line").startswith("#")).select(include_key(F.col("line")).alias("relative_path")).distinct()


def selected(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Files on the list: a semi join on the tidied path (Spark broadcasts the list only if it is small)."""
    return files.join(wanted.select(F.col("relative_path").alias("wanted_")), include_key(files["relative_path"]) == F.col("wanted_"), "left_semi")


def missing(files: DataFrame, wanted: DataFrame) -> DataFrame:
    """Paths on the list of which there is no file."""
    return wanted.join(files.select(include_key(F.col("relative_path")).alias("there_")), F.col("relative_path") == F.col("there_"), "left_anti")


def weight(extension: Column) -> Column:
    """light, pdf or heavy: what extraction costs."""
    return F.when(extension.isin(*V.PDF_EXT), "pdf").when(extension.isin(*V.HEAVY_EXT), "heavy").otherwise("light")


def extractor(extension: Column) -> Column:
    out = F.when(extension.isin(*V.TEXT_EXT), "text")
    for name, of in (("structured", V.STRUCTURED_EXT), ("office", V.OFFICE_EXT), ("pdf", V.PDF_EXT), ("html", V.HTML_EXT), ("image", V.IMAGE_EXT), ("video", V.VIDEO_EXT)):
        out = out.when(extension.isin(*of), name)
    return out


@F.pandas_udf(T.ArrayType(T.StringType()))
def path_variants(paths):
    """A path as it is, composed and decomposed; Spark has no Unicode normalisation."""
    import unicodedata

    def three(p: str | None) -> list[str]:
        if p is None:
            return []
        p = p.replace("\\", "/")
        return list(dict.fromkeys([p, unicodedata.normalize("NFC", p), unicodedata.normalize("NFD", p)]))

    return paths.map(three)


def originals_by_id(files: DataFrame) -> DataFrame:
    """file_id and the first file (by path) of each, under all spellings of its path."""
    every = files.select("*", F.explode(path_variants("relative_path")).alias("variant_")).withColumn("file_id", file_id(F.col("variant_")))
    first = F.row_number().over(Window.partitionBy("file_id").orderBy("relative_path"))
    return every.withColumn("n_", first).where("n_ = 1").drop("n_", "variant_")


def match_texts(texts: DataFrame, files: DataFrame) -> DataFrame:
    """texts (text_path, text, text_bytes) with their original's columns; a text without one gets what its name tells.

    Adds ord, the text's place by path, and matched.
    """
    named = texts.withColumn("stem_", F.regexp_replace(F.substring_index("text_path", "/", -1), r"\.txt\z", ""))
    ids = originals_by_id(files).select(F.col("file_id").alias("id_"), F.col("relative_path").alias("rel_"), F.col("extension").alias("ext_"), F.col("size_bytes").alias("size_"))
    both = named.join(ids, F.col("stem_") == F.col("id_"), "left")
    told = F.replace(F.regexp_replace("stem_", r"(?s)__((?!__).)*\z", ""), F.lit("__"), F.lit("/"))
    suffix = F.lower(F.regexp_extract(F.substring_index(told, "/", -1), r"(?s)[^.].*?(\.[^.]+)\z", 1))
    out = both.select(
        *texts.columns,
        F.coalesce("rel_", F.concat(F.lit("text-only/"), told)).alias("relative_path"),
        F.coalesce("ext_", F.when(suffix == "", ".txt").otherwise(suffix)).alias("extension"),
        F.coalesce("size_", F.col("text_bytes")).alias("size_bytes"),
        F.col("id_").isNotNull().alias("matched"),
    )
    return with_order(out, "text_path")


def with_order(frame: DataFrame, by: str, name: str = "ord") -> DataFrame:
    """frame with each row's place in the order of a column, from 0, without putting all rows in one task.

    Rows are range-partitioned and sorted, and written so; places inside a partition are shifted by the sizes of those before it.
    """
    spread = frame.repartitionByRange(by).sortWithinPartitions(by).withColumn("row_", F.monotonically_increasing_id())
    return _numbered(written(spread, "ordered"), name)


def _numbered(spread: DataFrame, name: str) -> DataFrame:
    part, at = F.shiftright("row_", 33), F.col("row_").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = spread.groupBy(part.alias("part_")).agg((F.max(at) + 1).alias("n_"))
    shifts = sizes.select("part_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("shift_"))
    return spread.withColumns({"in_": part, "at_": at}).join(F.broadcast(shifts), F.col("in_") == F.col("part_")).withColumn(name, F.col("shift_") + F.col("at_")).drop("row_", "in_", "at_", "part_", "shift_")
