"""What the operators share: Arrow batches of texts, and tables in the shared folder."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import dropped, shared_dir, written

__all__ = ["arrow_schema", "dropped", "free_names", "give_back", "keep_rows", "map_texts", "materialize", "shared_dir", "slices", "split_rule", "text_bytes"]

#: Texts are handed to Python code in slices of at most so many bytes (a longer text is a slice of its own).
SLICE_BYTES = 8 << 20


#: df as a table in the shared folder: cuts lineage, survives lost executors, computes df once.
materialize = written


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """Names for columns of our own that df doesn't have: underscores are added to wanted ones until none clashes."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def give_back() -> None:
    """Return freed memory to the system at the end of a partition: the worker lives on, beside others of its executor."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(text_col: str = "text") -> Column:
    """The whole text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(text_col).cast("binary"), F.lit(b"").cast("binary"))


def slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """batch in slices whose values in a binary column together stay under limit bytes, or of one row."""
    start, total = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        if i > start and total + (n or 0) > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n or 0
    if batch.num_rows > start:
        yield batch.slice(start)


def map_texts(docs: DataFrame, work: Callable[[list, list], dict], schema: str, id_col: str = "doc_id", text_col: str = "text", texts: Column | None = None) -> DataFrame:
    """Run work(ids, texts as bytes) -> {column: values} over bounded slices; no shuffle.  schema is the output's DDL."""
    frame = docs.select(F.col(id_col).alias("id"), (texts if texts is not None else text_bytes(text_col)).alias("text"))
    arrow = arrow_schema(docs.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                out = work(part.column(0).to_pylist(), part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        give_back()

    return frame.mapInArrow(run, schema)


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    """The Arrow types of a DDL string made of the plain types that operators return."""
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64(), "boolean": pa.bool_(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<bigint>": pa.list_(pa.int64()), "array<float>": pa.list_(pa.float32()), "array<double>": pa.list_(pa.float64()), "array<string>": pa.list_(pa.string())}
    from pyspark.sql.types import _parse_datatype_string

    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in _parse_datatype_string(ddl).fields])


def split_rule(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo modulus; null ids count as the text ''."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def keep_rows(docs: DataFrame, keep: Callable[[list], list], text_col: str = "text") -> DataFrame:
    """The rows of docs for whose texts (bytes, null as empty) keep says true; all columns, no shuffle."""
    (own,) = free_names(docs, "bytes_")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(text_col)
            texts = batch.column(at).cast(pa.large_binary())
            for part in slices(batch.append_column(own, texts), batch.num_columns):
                mask = keep([t or b"" for t in part.column(part.num_columns - 1).to_pylist()])
                yield part.select(list(range(part.num_columns - 1))).filter(pa.array(mask, pa.bool_()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
