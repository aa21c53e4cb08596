"""Files, texts and tables as DataFrames."""

from __future__ import annotations

import functools
import itertools
import re
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import vocab as V
from ..functions.text import extension_of, normalize, truncate
from ..operators.routing import status
from ..session import shared_dir

RECORD = ("path", "relative_path", "extension", "size_bytes", "modified_at", "status", "error")
#: Files listed, or bytes of files, that the driver hands over at a time.
LISTED, HANDED_BYTES = 100_000, 64 << 20
#: A file or folder as Hadoop writes it out (fixed by its format).
STATUS = re.compile(r"path=(.*?); isDirectory=(?:(true)|false; length=(\d+); .*?); modification_time=(\d+); access_time", re.S)


def _store(spark: SparkSession, path: str):
    """Hadoop's path, and the file system that it is in."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there, there.getFileSystem(spark._jsc.hadoopConfiguration())


def unseen(path: str, root: str) -> bool:
    """Whether Spark's readers pass over a file: a name that begins with a dot or an underscore, its own or a folder's."""
    return any(n.startswith(".") or (n.startswith("_") and "=" not in n) or n.endswith("._COPYING_") for n in path.removeprefix(root).split("/") if n)


def list_files(spark: SparkSession, root: str) -> Iterator[tuple[str, int | None, float | None, str | None]]:
    """(path, length, seconds of modification, error) of every file below root, hidden and empty ones too.

    The driver asks the file system folder by folder, a call each; Spark's own listing, which the driver holds too, leaves
    files out.  A folder that can't be listed is one row with an error.
    """
    there, store = _store(spark, root)
    todo = [store.makeQualified(there).toString()]
    while todo:
        folder = todo.pop()
        try:
            found = spark._jvm.org.apache.hadoop.util.functional.RemoteIterators.toList(store.listStatusIterator(spark._jvm.org.apache.hadoop.fs.Path(folder))).toString()
        except Py4JJavaError as e:
            yield folder, None, None, f"Cannot stat file: {e.java_exception.getMessage()}"
            continue
        for path, is_folder, length, modified in STATUS.findall(found):
            if is_folder:
                todo.append(path)
            else:
                yield path, int(length), int(modified) / 1000, None


def scan(spark: SparkSession, root: str, limit_mb: float = 100.0) -> DataFrame:
    """One row for each file below root (path, relative_path, extension, size_bytes, modified_at, status, error, unseen).  No file is opened."""
    there, store = _store(spark, root)
    whole = store.makeQualified(there).toString().rstrip("/")
    names = pa.schema([("path", pa.string()), ("size_bytes", pa.int64()), ("modified_at", pa.float64()), ("failed", pa.string()), ("unseen", pa.bool_())])
    parts, rows = [], list_files(spark, root)
    while some := [(p, n, m, e, unseen(p, whole)) for p, n, m, e in itertools.islice(rows, LISTED)]:
        parts.append(spark.createDataFrame(pa.table([list(c) for c in zip(*some, strict=True)], schema=names)))
    listed = functools.reduce(DataFrame.unionAll, parts) if parts else spark.createDataFrame([], "path string, size_bytes bigint, modified_at double, failed string, unseen boolean")
    relative = F.substring(F.col("path"), len(whole) + 2, 1 << 30)
    state, error = status(F.substring_index("path", "/", -1), extension_of(F.col("path")), F.col("size_bytes"), limit_mb)
    return listed.select("path", relative.alias("relative_path"), extension_of(F.col("path")).alias("extension"), F.coalesce("size_bytes", F.lit(0)).alias("size_bytes"), "modified_at", F.when(F.col("failed").isNotNull(), "skipped").otherwise(state).alias("status"), F.coalesce("failed", error).alias("error"), "unseen")


def _escaped(path: str) -> str:
    """A path that Hadoop's globs take as it is."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _any_case(extensions: Iterable[str]) -> str:
    return "*.{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e[1:]) for e in sorted(extensions)) + "}"


def _handed(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, content of files that Spark's readers pass over: the driver reads them and writes them out, HANDED_BYTES at a time."""
    folder = f"{shared_dir(spark)}/unseen-{uuid.uuid4().hex}"
    kinds, held = pa.schema([("path", pa.string()), ("content", pa.binary())]), []

    def flush() -> None:
        spark.createDataFrame(pa.table([list(c) for c in zip(*held, strict=True)] or [[], []], schema=kinds)).write.mode("append").parquet(folder)
        held.clear()

    for path in paths:
        there, store = _store(spark, path)
        stream = store.open(there)
        try:
            held.append((path, bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))))
        finally:
            stream.close()
        if sum(len(c) for _, c in held) > HANDED_BYTES:
            flush()
    flush()
    return spark.read.schema("path string, content binary").parquet(folder)


def contents(spark: SparkSession, root: str, listed: DataFrame, extensions: Iterable[str] = V.SUPPORTED_EXT, limit_mb: float = 100.0, chosen: bool = False) -> DataFrame:
    """path, relative_path, extension, size_bytes, content of the pending files of listed with these extensions.

    One scan opens them: names and sizes are filtered by the reader, before any file is opened.  chosen: listed is a
    selection of few, whose paths are read one by one, so that the others stay closed.
    """
    there, store = _store(spark, root)
    whole = store.makeQualified(there).toString().rstrip("/")
    pending = listed.where((F.col("status") == "pending") & F.col("extension").isin(*extensions))
    reader = spark.read.format("binaryFile")
    plain = pending.where("not unseen and size_bytes > 0")
    if chosen:
        paths = [_escaped(r.path) for r in plain.select("path").toLocalIterator()]
        seen = reader.load(paths) if paths else None
    else:
        seen = reader.option("recursiveFileLookup", "true").option("pathGlobFilter", _any_case(extensions)).load(root).where((F.col("length") <= int(limit_mb * 1024 * 1024)) & ~F.substring_index("path", "/", -1).startswith("~$"))
    hidden = _handed(spark, [r.path for r in pending.where("unseen and size_bytes > 0").select("path").toLocalIterator()])
    rows = [hidden, pending.where("size_bytes = 0").select("path", F.lit(b"").cast("binary").alias("content"))]
    rows += [seen.select("path", "content")] if seen is not None else []
    every = functools.reduce(DataFrame.unionByName, rows)
    return every.select("path", F.substring(F.col("path"), len(whole) + 2, 1 << 30).alias("relative_path"), extension_of(F.col("path")).alias("extension"), F.octet_length("content").cast("bigint").alias("size_bytes"), "content")


EXTRACTED = T.StructType([T.StructField("raw_text", T.StringType()), T.StructField("extract_status", T.StringType()), T.StructField("metadata", T.MapType(T.StringType(), T.StringType())), T.StructField("warnings", T.ArrayType(T.StringType()))])


def read_texts(files: DataFrame, use_ocr: bool = False, max_rows: int = 50_000, timeout: float = 0) -> DataFrame:
    """files (pending, with content) with text, extract_status, metadata, warnings; content is dropped.

    Decoding and parsing are Python on Arrow batches, one file at a time, at most timeout seconds each (0: no limit);
    normalising is Spark's.
    """

    @F.pandas_udf(EXTRACTED)
    def read(content, extension):
        import pandas as pd

        from veilscan.sources.extract import extract

        rows = [extract(c or b"", e, use_ocr, max_rows, timeout) for c, e in zip(content, extension, strict=True)]
        return pd.DataFrame({"raw_text": [r.text for r in rows], "extract_status": [r.status for r in rows], "metadata": [r.metadata for r in rows], "warnings": [r.warnings for r in rows]})

    done = files.withColumn("x_", read("content", "extension"))
    return done.select(*(c for c in files.columns if c != "content"), truncate(normalize(F.col("x_.raw_text"))).alias("text"), F.col("x_.extract_status").alias("extract_status"), F.col("x_.metadata").alias("metadata"), F.col("x_.warnings").alias("warnings"))


ROWS = "relative_path string, extension string, size_bytes bigint, sheet string, row_no int, cells array<struct<col_no:int,col_name:string,value:string>>, problem string"
#: Rows of a sheet handed over at a time.
ROWS_AT_ONCE = 2000


def table_rows(files: DataFrame, max_rows: int = 50_000, timeout: float = 0) -> DataFrame:
    """The rows of table files (with content), see operators.tables.

    Row 0 without values names the columns of a sheet without rows; a table that can't be read is one row with a problem.
    """
    cell = pa.struct([("col_no", pa.int32()), ("col_name", pa.string()), ("value", pa.string())])
    shape = pa.schema([("relative_path", pa.string()), ("extension", pa.string()), ("size_bytes", pa.int64()), ("sheet", pa.string()), ("row_no", pa.int32()), ("cells", pa.list_(cell)), ("problem", pa.string())])

    def run(batches):
        from veilscan.sources.extract import table_frames, time_limit

        def rows_of(own: tuple, found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([v[k] for v in ((*own, *f) for f in found)], kind.type) for k, kind in enumerate(shape)], schema=shape)

        for batch in batches:
            for path, extension, size, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = (path, extension, size)
                try:
                    with time_limit(timeout):
                        frames = table_frames(content or b"", extension, max_rows)
                except Exception as e:  # noqa: BLE001 - one broken table is one row
                    yield rows_of(own, [(None, 0, None, f"table read failed: {e}")])
                    continue
                if not frames:
                    yield rows_of(own, [(None, 0, None, None)])
                for sheet, (columns, rows) in frames.items():
                    if not rows or not columns:
                        yield rows_of(own, [(sheet, len(rows), [{"col_no": i, "col_name": c, "value": None} for i, c in enumerate(columns)], None)])
                        continue
                    for at in range(0, len(rows), ROWS_AT_ONCE):
                        yield rows_of(own, [(sheet, at + n, [{"col_no": i, "col_name": c, "value": v} for i, (c, v) in enumerate(zip(columns, row, strict=True))], None) for n, row in enumerate(rows[at : at + ROWS_AT_ONCE], 1)])

    return files.select("relative_path", "extension", "size_bytes", "content").mapInArrow(run, ROWS)


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """text_path, text, text_bytes of the .txt files right in a folder."""
    raw = spark.read.option("pathGlobFilter", "*.txt").format("binaryFile").load(folder)
    return raw.select(F.col("path").alias("text_path"), F.try_validate_utf8(F.col("content").cast("string")).alias("good_"), "content", F.col("length").alias("text_bytes")).select("text_path", F.coalesce("good_", F.make_valid_utf8(F.col("content").cast("string"))).alias("text"), "text_bytes")


@F.udf(T.StringType(), useArrow=False)
def html_text(page):
    """Text nodes of a page outside script, style and noscript, one a line; null stays null.

    Pages go to Python a hundred at a time; Arrow would send ten thousand, of any size, and hold them with their texts.
    """
    from veilscan.sources.extract import html_nodes

    return None if page is None else html_nodes(page)


@F.pandas_udf(T.ArrayType(T.StringType()))
def json_values(values):
    """Keys and scalars of JSON texts, depth first; a text that is no JSON, and null, has none (null)."""
    import json

    from veilscan.sources.extract import walk

    def told(v: str) -> list[str] | None:
        try:
            return walk(json.loads(v), 50_000)
        except (ValueError, RecursionError):
            return None

    return values.map(told, na_action="ignore")


def supported(extension: Column) -> Column:
    return extension.isin(*V.SUPPORTED_EXT)
