"""From raw documents to packed sequences: toxicity, language, near duplicates, secrets, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared folder and gives
what is reread to the next.  All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilscan.llm import langid, packing, secrets, simhash, toxicity
from veilscan.llm.common import dropped, keep_rows, materialize

#: Least confidence of the language that a document must have to stay.
LEAST_SURE = 0.52


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose texts are predicted to be toxic go; all others stay as they are, repeated ones too.

    The model learns from labelled rows of docs; without labels of both kinds nothing is toxic.  Null and empty texts,
    which hold no passage, stay; a null id has no label.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    sent = spark.sparkContext.broadcast(model)
    return keep_rows(docs, lambda texts: [sent.value.score(t)[0] < toxicity.THRESHOLD for t in texts])


def drop_unknown_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose texts are null or have no letters, and those between two languages, go; all others stay as they are.

    The model learns from rows of docs with a language; where there are none, every row goes, as no text has a known one.
    """
    sent = spark.sparkContext.broadcast(langid.fit(langid.training_rows(docs)))

    def keep(texts: list) -> list:
        found = [sent.value.predict(t) for t in texts]
        return [lang != langid.UNKNOWN and sure >= LEAST_SURE for lang, sure in found]

    return keep_rows(docs, keep)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one row stays, the one with the smallest id (null ids last); see simhash.keep_one."""
    return simhash.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by their kind and n_chars is counted anew; every row stays, null texts as null (n_chars too)."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row, also without id or text, as one or more pieces of sequences; a text without tokens is its separator."""
    return packing.pack_documents(docs)


STAGES = [("toxicity", drop_toxic), ("language", drop_unknown_language), ("near_duplicates", drop_near_duplicates), ("secrets", redact_secrets), ("packing", pack_sequences)]

#: SQL has no SimHash, classifier or tokenizer; tests/llm hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of what the stages keep of documents.

    Every stage takes empty tables, rows without id or text, empty and very long texts, repeated rows and extra columns;
    what it makes of them is in its docstring.  A stage's input is removed once its output is written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        last, docs = docs, materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        dropped(last)
    return docs
