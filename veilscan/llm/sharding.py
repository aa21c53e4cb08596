"""A uniform shuffle into shards of exact sizes.

Rows are dealt to source partitions of bounded size by their place in the table.  A communication matrix says how many
rows go from each source to each shard; it is drawn from the multivariate hypergeometric law, so it is distributed as
under a uniform permutation of all rows.  It is drawn in two steps: on the driver for groups of sources, in tasks for the
sources of a group.  Rows are permuted inside their source, dealt out as the matrix says, exchanged, and permuted again:
into a random block of their shard, and inside it.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, text_bytes

N_SHARDS = 40
SEED = 20_240_229
#: Rows of a source partition, and of a block of a shard, on average; sources of a group.
BLOCK_ROWS = 20_000
GROUP_SOURCES = 1024


def hypergeometric(rng: np.random.Generator, good: int, bad: int, sample: int) -> int:
    """How many of `sample` rows drawn from good + bad ones are good; numbers over numpy's bound by ratio of uniforms."""
    if good < 1_000_000_000 and bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, sample))
    # The law is symmetric: draw the rarer kind in the smaller part.
    n, few, many = good + bad, min(good, bad), max(good, bad)
    m = min(sample, n - sample)
    p = few / n
    mean, spread = m * p + 0.5, math.sqrt((n - m) * m * p * (1 - p) / (n - 1) + 0.5)
    width = 1.7155277699214135 * spread + 0.8989161620588988  # 2 * sqrt(2 / e) and 3 - 2 * sqrt(3 / e)

    def weight(k: int) -> float:
        return -sum(map(math.lgamma, (k + 1, few - k + 1, m - k + 1, many - m + k + 1)))

    top = weight((m + 1) * (few + 1) // (n + 2))
    while True:
        u, v = rng.random(), rng.random()
        k = math.floor(mean + width * (v - 0.5) / u) if u else -1
        if 0 <= k <= min(m, few) and 2 * math.log(u) <= weight(k) - top:
            break
    k = k if good <= bad else m - k
    return k if m == sample else good - k


def communication_matrix(sources: list[int], targets: list[int], seed: int | list[int] = SEED) -> np.ndarray:
    """Rows sent from each source to each target: row sums are sources, column sums are targets (equal totals)."""
    rng, left = np.random.default_rng(seed), [int(t) for t in targets]
    out = np.zeros((len(sources), len(targets)), np.int64)
    for i, n in enumerate(sources):
        n, rest = int(n), sum(left)
        for j, there in enumerate(left):
            rest -= there
            out[i, j] = got = hypergeometric(rng, there, rest, n) if n else 0
            left[j] -= got
            n -= got
    return out


def split_evenly(n: int, parts: int) -> list[int]:
    """n in parts, at most one apart."""
    return [n // parts + (i < n % parts) for i in range(parts)]


def source_ends(counts: DataFrame, n: int, n_shards: int, seed: int) -> DataFrame:
    """source, ends: of the places in each source (column n of counts) the last ones that each shard takes.

    The driver holds n_shards numbers for each group, which is one for GROUP_SOURCES * BLOCK_ROWS rows.
    """
    grouped = counts.groupBy(F.floor(F.col("source") / GROUP_SOURCES).alias("group_")).agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("members"))
    sizes = {r[0]: r[1] for r in counts.groupBy(F.floor(F.col("source") / GROUP_SOURCES)).agg(F.sum("n")).collect()}
    order = sorted(sizes)
    matrix = communication_matrix([sizes[g] for g in order], split_evenly(n, n_shards), seed)
    shares = counts.sparkSession.createDataFrame([(g, [int(x) for x in row]) for g, row in zip(order, matrix, strict=True)], "of_ bigint, share array<bigint>")
    joined = grouped.join(shares, F.col("group_") == F.col("of_")).select("group_", F.transform("members", lambda m: m["source"]).alias("sources"), F.transform("members", lambda m: m["n"]).alias("sizes"), "share")

    def draw(batches):
        for batch in batches:
            for group, sources, own, share in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ends = np.cumsum(communication_matrix(own, share, [seed, group]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(sources, pa.int64()), pa.array(ends.tolist(), pa.list_(pa.int64()))], names=["source", "ends"])

    return joined.mapInArrow(draw, "source bigint, ends array<bigint>")


def _draw(what: str, seed: int, n: int | None = None) -> Column:
    """A number for each row, by its place: any, or one under n."""
    h = F.xxhash64(F.lit(what), F.lit(seed), F.col("row_"))
    return h if n is None else F.pmod(h, F.lit(n))


def shuffle_into_shards(rows: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED) -> DataFrame:
    """rows (with row_, a number of each row's own) with shard and slot: sizes of shards at most one row apart, slots gapless.

    Rows are told apart by row_ alone, so rows alike in all else are spread like any others.  Tasks sort about
    BLOCK_ROWS rows at a time, whatever the input.  An empty table gives none.
    """
    n = rows.count()
    p, q = max(1, -(-n // BLOCK_ROWS)), max(1, -(-n // (n_shards * BLOCK_ROWS)))
    placed = rows.withColumn("source_", _draw("source", seed, p))
    ends = source_ends(placed.groupBy(F.col("source_").alias("source")).agg(F.count("*").alias("n")), n, n_shards, seed)
    local = placed.withColumn("at_", F.row_number().over(Window.partitionBy("source_").orderBy(_draw("deal", seed), "row_")))
    # A row's shard is the number of ends below its place.
    sent = local.join(ends, F.col("source_") == F.col("source")).withColumn("shard", F.size(F.filter("ends", lambda e: e < F.col("at_"))).cast("int")).drop("source_", "source", "at_", "ends")
    dealt = materialize(sent.withColumn("block_", _draw("block", seed, q)), "shard-dealt")
    full = dealt.groupBy("shard", "block_").agg(F.count("*").alias("n_"))
    before = F.coalesce(F.sum("n_").over(Window.partitionBy("shard").orderBy("block_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    bases = full.select(F.col("shard").alias("of_"), F.col("block_").alias("in_"), before.alias("base_"))
    again = F.row_number().over(Window.partitionBy("shard", "block_").orderBy(_draw("again", seed), "row_"))
    out = dealt.withColumn("again_", again).join(bases, (F.col("shard") == F.col("of_")) & (F.col("block_") == F.col("in_")))
    return out.withColumn("slot", F.col("base_") + F.col("again_") - 1).drop("block_", "again_", "of_", "in_", "base_", "row_")


def sized(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size (UTF-8 bytes of the text, none if null, plus 16), text_crc32."""
    text = text_bytes(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 16).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32"))


def shard_documents(docs: DataFrame, n_shards: int = N_SHARDS, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs; the law is `rows`.

    Null texts have size 16 and the checksum 0; null ids and repeated rows are rows like any other; an empty table gives
    none.  Only ids and numbers are shuffled, never texts.  Where a row goes depends on the seed and its place in docs.
    """
    rows = materialize(sized(docs, id_col, text_col).withColumn("row_", F.monotonically_increasing_id()), "shard-rows")
    out = shuffle_into_shards(rows, n_shards, seed)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write docs (unique ids) as one Parquet folder a shard, each file in slot order."""
    at = placed.select(F.col("doc_id").alias("placed_id"), F.col("shard").alias("shard_"), F.col("slot").alias("slot_"))
    both = docs.join(at, docs[id_col].eqNullSafe(at.placed_id)).drop("placed_id")
    both.repartitionByRange("shard_", "slot_").sortWithinPartitions("shard_", "slot_").write.partitionBy("shard_").parquet(path)
