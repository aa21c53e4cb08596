"""The queries of this subpackage: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import ann, bpe, langid, licenses, media, packing, secrets, sharding, simhash, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _count(values: Column, wanted: int) -> Column:
    return F.size(F.filter(values, lambda v: v == wanted))


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.search(vectors, vectors.where(F.col("vec_id") % 50 == 0), 5)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_by_words(_table(spark, sf_dir, "documents"))
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return coded.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op4_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "codec", "duration", "keyframe_ranges")
    return media.media_columns(_table(spark, sf_dir, "documents")).select(*columns)


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["rank"] < secrets.BASE)
    ranks = F.transform("spans", lambda s: s["rank"])
    counts = [_count(ranks, k).cast("bigint").alias(f"n_{r.kind}") for k, r in enumerate(secrets.RULES[: secrets.BASE])]
    return found.select("doc_id", *counts, F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_bpe, op3_language, op4_media, op5_secrets, op6_packing, op7_licenses, op8_toxicity, op9_sharding, op10_simhash)}


def oracle_sql() -> dict[str, str]:
    """None so far: each of these is held against brute force in tests/llm instead."""
    return {}
