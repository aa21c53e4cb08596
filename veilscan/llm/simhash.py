"""SimHash near-duplicates.

Fingerprints: 64-bit SimHash over word shingles.  Links: fingerprints at few differing bits.  Candidates come from an
embedding of a fingerprint as popcounts of its 32 two-bit segments: the Manhattan distance of two embeddings is never
over the Hamming distance.  A distance of at most 3 leaves at most 1 to one of the two halves of 16 segments, so the
grid with cells of one lattice point is joined within Manhattan radius 1, half by half.  What the grid brings together
is verified exactly; cells that hold too many are joined again on quarters.  Inside a cell a breadth-first search over the unvisited yields a spanning forest, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, give_back, materialize, slices, text_bytes
from .components import connected_components

SEED = 42
MAX_BITS = 3
#: Hashes whose bits are counted at a time.
CHUNK = 1 << 16
#: Fingerprints of one cell that are compared in one group; larger cells are dealt again, and then as pairs of blocks.
CELL = 20_000
SEGMENTS = 16


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of a text's word shingles; 0 without words, one shingle of all words where they are fewer."""
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)) if len(words) >= width else iter([b" ".join(words)])
    hashes = map(partial(xxhash.xxh64_intdigest, seed=SEED), shingles)
    counts = np.zeros(64, np.int64)
    for start in range(0, n, CHUNK):
        some = np.fromiter(hashes, np.dtype("<u8"), min(CHUNK, n - start))
        counts += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long), row_key.  One row for each row of docs; null texts count as empty (fp 0)."""
    frame = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_bytes(text_col).alias("text"), row_key(id_col, text_col).alias("row_key"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                fps = np.array([fingerprint(t) for t in part.column(1).to_pylist()], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps), part.column(2)], names=["doc_id", "fp", "row_key"])
        give_back()

    return frame.mapInArrow(run, "doc_id bigint, fp bigint, row_key binary")


def cell(half: Column) -> Column:
    """The popcounts of a 32-bit half's two-bit segments, each in two bits of the result."""
    return half - F.shiftrightunsigned(half, 1).bitwiseAND(F.lit(0x55555555))


def _half(fp: Column, which: int) -> Column:
    return F.shiftrightunsigned(fp, 32) if which else fp.bitwiseAND(F.lit(0xFFFFFFFF))


def grid_rows(nodes: DataFrame) -> DataFrame:
    """cell_key, home, fp: every fingerprint at its own cell and at the cells one step above in one segment, for both halves."""
    rows = []
    for which in (0, 1):
        own = cell(_half(F.col("fp"), which))
        steps = [F.when(F.shiftrightunsigned(F.col("own"), 2 * k).bitwiseAND(F.lit(3)) < 2, F.col("own") + F.lit(1 << 2 * k)) for k in range(SEGMENTS)]
        up = F.filter(F.array(F.lit(-1).cast("bigint"), *steps), lambda x: x.isNotNull())
        at = nodes.select("fp", own.alias("own")).select("fp", "own", F.explode(up).alias("step"))
        rows.append(at.select((F.when(F.col("step") < 0, F.col("own")).otherwise(F.col("step")) * 2 + which).alias("cell_key"), (F.col("step") < 0).alias("home"), "fp"))
    return rows[0].unionByName(rows[1])


def manhattan(x: np.ndarray, y: np.uint64) -> np.ndarray:
    """Distance of the embeddings: a segment's popcounts differ by 1 where exactly one bit differs, by 2 for 00 and 11."""
    one, odd = np.uint64(1), np.uint64(0x5555555555555555)
    d = x ^ y
    lone = (d ^ (d >> one)) & odd
    both = d & (d >> one) & odd
    level = (x ^ ~(x >> one)) & odd  # both bits of x alike: 00 against 11, not 01 against 10
    return np.bitwise_count(lone) + 2 * np.bitwise_count(both & level)


def spanning_forest(fps: np.ndarray, max_bits: int = MAX_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect whatever fingerprints at max_bits or fewer connect; at most len(fps)-1 of them."""
    left, right, rest = [], [], fps
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            near = manhattan(rest, at) <= max_bits
            if near.any():
                near[near] = np.bitwise_count(rest[near] ^ at) <= max_bits
                if near.any():
                    found, rest = rest[near], rest[~near]
                    queue.extend(found)
                    left.append(np.full(len(found), at))
                    right.append(found)
    none = np.empty(0, fps.dtype)
    return np.concatenate(left or [none]), np.concatenate(right or [none])


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches sorted by cell_key, block: edges of each cell's spanning forest.  Holds one group."""
    held: list[tuple[np.ndarray, ...]] = []

    def flush(keys: np.ndarray, homes: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        if not len(keys):
            return
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        edges = []
        for s, n in zip(starts[sizes > 1], sizes[sizes > 1], strict=True):
            if homes[s : s + n].any():
                edges.append(spanning_forest(np.unique(fps[s : s + n])))
        if edges:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([e[i] for e in edges]).view(np.int64)) for i in (0, 1)], names=["u", "v"])

    for batch in batches:
        keys = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)], axis=1).view([("k", np.int64), ("b", np.int64)]).ravel()
        homes, fps = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False).view(np.uint64)
        if not len(keys):
            continue
        last = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])
        if last or (held and held[-1][0][-1] != keys[0]):
            cut = last if last else 0
            held.append((keys[:cut], homes[:cut], fps[:cut]))
            yield from flush(*(np.concatenate([h[i] for h in held]) for i in range(3)))
            held = [(keys[cut:], homes[cut:], fps[cut:])]
        else:
            held.append((keys, homes, fps))
    if held:
        yield from flush(*(np.concatenate([h[i] for h in held]) for i in range(3)))


def finer(rows: DataFrame) -> DataFrame:
    """cell_key, sub, home, fp: rows of hot cells dealt again by the other half of the fingerprint.

    Where one half differs by at most 1, the other differs by at most 3, so one of its quarters does by at most 1: each
    row goes to its cell of either quarter and to those one step above.  Two rows that meet need not be home there.
    """
    other = cell(F.when(F.col("cell_key") % 2 == 0, _half(F.col("fp"), 1)).otherwise(_half(F.col("fp"), 0)))
    subs = []
    for quarter in (0, 1):
        own = F.shiftrightunsigned(other, SEGMENTS * quarter).bitwiseAND(F.lit((1 << SEGMENTS) - 1))
        steps = [F.when(F.shiftrightunsigned(own, 2 * k).bitwiseAND(F.lit(3)) < 2, own + F.lit(1 << 2 * k)) for k in range(SEGMENTS // 2)]
        subs += [x * 2 + quarter for x in (own, *steps)]
    return rows.select("cell_key", F.explode(F.filter(F.array(*subs), lambda x: x.isNotNull())).alias("sub"), F.lit(True).alias("home"), "fp")


def links(nodes: DataFrame, cell_limit: int = CELL) -> DataFrame:
    """u, v: links among distinct fingerprints (column fp) that connect all that any links connect.

    Cells over cell_limit rows are dealt again by the other half, into cells that are thousands of times smaller; such as
    are still over it are cut into blocks and every pair of blocks is its own group, so no cell is one task's.
    """
    rows = grid_rows(nodes)
    hot = materialize(rows.groupBy("cell_key").agg(F.count("*").alias("n")).where(F.col("n") > cell_limit).select(F.col("cell_key").alias("hot_key")), "hot-cells")
    if hot.isEmpty():
        grouped = rows.select("cell_key", F.lit(0).cast("bigint").alias("block"), "home", "fp")
    else:
        cool = rows.join(hot, rows.cell_key == hot.hot_key, "left_anti").select("cell_key", F.lit(-1).cast("bigint").alias("sub"), "home", "fp")
        every = materialize(cool.unionByName(finer(rows.join(hot, rows.cell_key == hot.hot_key, "left_semi"))), "grid")
        large = every.groupBy("cell_key", "sub").agg(F.count("*").alias("n")).where(F.col("n") > cell_limit).select(F.col("cell_key").alias("large_key"), F.col("sub").alias("large_sub"), F.ceil(F.col("n") / max(1, cell_limit // 2)).alias("blocks"))
        rows = every.join(large, (F.col("cell_key") == F.col("large_key")) & (F.col("sub") == F.col("large_sub")), "left").select("cell_key", "sub", "home", "fp", F.coalesce("blocks", F.lit(1)).cast("bigint").alias("blocks"))
        mine = F.pmod(F.xxhash64("fp"), F.col("blocks"))
        others = F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1), lambda o: F.least(mine, o) * F.col("blocks") + F.greatest(mine, o))
        grouped = rows.select("cell_key", "sub", F.explode(others).alias("pair"), "home", "fp").select("cell_key", ((F.col("sub") + 1) * (1 << 40) + F.col("pair")).alias("block"), "home", "fp")
    return grouped.repartition("cell_key", "block").sortWithinPartitions("cell_key", "block").mapInArrow(_forests, "u bigint, v bigint")


def _named(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp, row_key) of each row of docs, and (fp, least, root) of each fingerprint.

    least: (whether the id is null, id, row_key) of its first row; root: the component's smallest fingerprint.
    """
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key")).alias("least")), "fingerprint-nodes")
    roots = connected_components(links(nodes.select("fp")))
    return prints, nodes.join(roots, nodes.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that links reach, itself included.

    One row for each row of docs.  Texts null or without words share fingerprint 0.  Rows with equal texts are one node;
    a null doc_id takes part and gets its component's smallest id (null if that has none).  An empty table gives none.
    """
    prints, named = _named(docs, id_col, text_col)
    smallest = named.groupBy("root").agg(F.min("least.doc_id").alias("component_id")).withColumnRenamed("root", "of")
    names = named.join(smallest, named.root == smallest.of).select(F.col("fp").alias("named_fp"), "component_id")
    return prints.join(names, prints.fp == names.named_fp, "left").select("doc_id", "fp", "component_id")


def row_key(id_col: str, text_col: str) -> Column:
    """Equal for rows of equal id and equal text only, null a value of its own for both."""
    head = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.when(F.col(text_col).isNull(), ":0").otherwise(":1"))
    return F.unhex(F.sha2(F.concat(head.cast("binary"), text_bytes(text_col)), 256))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each component of near duplicates, with all columns: the one with the smallest id, ties to the smallest row key.

    Rows are told apart by id and text together, so unrelated texts under one id are rows of their own, and null ids are
    ids like any other, after all others.  Of rows alike in id and text one is left.  An empty table gives none.
    """
    _, named = _named(docs, id_col, text_col)
    first = named.groupBy("root").agg(F.min("least").alias("least"))
    own, kept_key = free_names(docs, "own_key_", "kept_key_")
    kept = materialize(first.select(F.col("least.row_key").alias(kept_key)), "kept-rows")
    # Joined and deduplicated by the same key, rows are exchanged once.
    found = docs.withColumn(own, row_key(id_col, text_col)).join(kept, F.col(own) == F.col(kept_key), "left_semi")
    return found.dropDuplicates([own]).select(*docs.columns)
