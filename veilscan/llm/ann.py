"""Approximate nearest neighbours by balanced posting lists.

Equal vectors are one class.  Centroids come from balanced k-means on a bounded sample; each class is put on the lists of
its nearest centroid and of those hardly farther (boundary classes are replicated), found by a beam search of a graph of
the centroids.  A query searches the same graph and reads the lists whose centroids are within a ratio of the nearest.
Lists hold codes of two bytes a component; the few classes that a query's codes rank first are then scored by their
original vectors, as exact cosines.

The driver's centroids are bounded, so in large tables their lists are long; long lists are cut again, by centroids of
their own, which are fitted and searched in tasks.  What a query reads so stays the same, whatever the table's size.
Vectors of unlike lengths have lists of their own and are never compared.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType

from .common import materialize

#: Classes of a list on average; the most lists whose centroids the driver fits; the bound of its sample.
LIST = 256
MOST_LISTS = 16_384
SAMPLE = 65_536
#: Lists that a class is on at most, and how much farther than the nearest their centroids may be.
COPIES, BOUNDARY = 3, 1.15
#: Lists that a query reads at most and at least, and how much farther than the nearest their centroids may be.
PROBES, LEAST_PROBES, REACH = 96, 8, 1.35
#: The same for the pieces of a long list.
PIECES, LEAST_PIECES = 32, 4
#: Neighbours in the graph; width of the beam when vectors are put on lists.
DEGREE, BEAM = 24, 24
#: Classes of a list that one task fits or cuts at a time; vectors of a piece that its centroids are fitted on.
PART = 4096
FITTED = 32
#: Classes of each query that are scored by their original vectors; classes beyond k and the query's own that a list gives.
REFINED, SPARE = 16, 2
#: Scale of codes: components of unit vectors to two bytes.
SCALE = 32_767
#: Bytes of vectors in a partition.
PARTITION_BYTES = 64 << 20


def _valid(vectors: DataFrame, id_col: str, vector_col: str) -> tuple[DataFrame, str]:
    """id, v of the rows that take part, and the numpy type of v's components."""
    single = isinstance(vectors.schema[vector_col].dataType.elementType, FloatType)
    v = vectors.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).where(~bad & F.exists("v", lambda x: x != 0)), "<f4" if single else "<f8"


def _bytes(column: pa.Array, kind: str) -> list[bytes]:
    """Each vector's components as bytes; -0 becomes 0, so that equal vectors are equal bytes."""
    raw = (column.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0).astype(kind).tobytes()
    at = (column.offsets.to_numpy() - column.offsets[0].as_py()) * np.dtype(kind).itemsize
    return [raw[a:b] for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)]


def _by_length(vectors: list[bytes], kind: str):
    """(length, places, matrix of doubles) for the vectors of each length."""
    places: dict[int, list[int]] = {}
    for i, v in enumerate(vectors):
        places.setdefault(len(v), []).append(i)
    for n, at in places.items():
        yield n // np.dtype(kind).itemsize, np.array(at), np.frombuffer(b"".join([vectors[i] for i in at]), kind).reshape(len(at), -1).astype(np.float64)


def classes(valid: DataFrame, kind: str, keep: int, parts: int) -> DataFrame:
    """h (a hash of vec), vec (bytes), ids: the `keep` smallest ids of each distinct vector.

    Copies are reduced before the exchange, which is by h, so what is joined by h meets them there.
    """

    def reduce(batches):
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            for i, v in sorted(zip(batch.column(0).to_pylist(), _bytes(batch.column(1), kind), strict=True)):
                ids = found.setdefault(v, [])
                if len(ids) < keep and (not ids or ids[-1] != i):
                    ids.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.list_(pa.int64()))], names=["vec", "ids"])

    reduced = valid.mapInArrow(reduce, "vec binary, ids array<bigint>").select(F.xxhash64("vec").alias("h"), "vec", "ids").repartition(parts, "h")
    return reduced.groupBy("h", "vec").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))


def scaled(x: np.ndarray) -> np.ndarray:
    """Rows times powers of two that bring their largest components near 1: squares neither overflow nor vanish, and nothing is rounded."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])


def unit(x: np.ndarray) -> np.ndarray:
    x = scaled(x)
    return (x / np.linalg.norm(x, axis=1, keepdims=True)).astype(np.float32)


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of each row of x with that of y, in doubles."""
    x, y = scaled(x), scaled(y)
    return (x * y).sum(axis=1) / (np.sqrt((x * x).sum(axis=1)) * np.sqrt((y * y).sum(axis=1)))


def codes(x: np.ndarray) -> list[bytes]:
    return [c.tobytes() for c in np.rint(x * SCALE).astype("<i2")]


def _decoded(column: pa.ChunkedArray) -> np.ndarray:
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, "<i2").reshape(len(column), -1).astype(np.float32) / SCALE


@dataclass
class Index:
    """Centroids (unit vectors) and their graph; entry: where searches begin."""

    centroids: np.ndarray
    graph: np.ndarray
    entry: np.ndarray

    def nearest(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """For each unit vector the ids of the nearest centroids that a beam search finds, and distances, nearest first (id -1: none)."""
        c, b, k = self.centroids, len(x), len(self.centroids)
        beam = min(beam, k)
        seen = np.zeros((b, k + 1), bool)
        rows = np.arange(b)[:, None]
        ids = np.broadcast_to(self.entry, (b, len(self.entry))).copy()
        seen[rows, ids] = True
        dist = 1 - x @ c[self.entry].T
        order = np.argsort(dist, axis=1, kind="stable")[:, :beam]
        ids, dist = ids[rows, order], dist[rows, order]
        if ids.shape[1] < beam:
            pad = beam - ids.shape[1]
            ids, dist = np.pad(ids, ((0, 0), (0, pad)), constant_values=-1), np.pad(dist, ((0, 0), (0, pad)), constant_values=np.inf)
        done = ids < 0
        for _ in range(4 * k):
            best = np.where(done, np.inf, dist).argmin(axis=1)
            live = ~done[rows[:, 0], best]
            if not live.any():
                break
            r = np.flatnonzero(live)
            done[r, best[r]] = True
            near = self.graph[ids[r, best[r]]]
            fresh = ~seen[r[:, None], near]
            seen[r[:, None], near] = True
            d = np.where(fresh, 1 - np.einsum("bd,bmd->bm", x[r], c[near], optimize=False), np.inf)
            all_d = np.concatenate([dist[r], d], axis=1)
            top = np.argpartition(all_d, beam - 1, axis=1)[:, :beam]
            pick = np.arange(len(r))[:, None]
            dist[r] = all_d[pick, top]
            ids[r] = np.where(np.isfinite(dist[r]), np.concatenate([ids[r], near], axis=1)[pick, top], -1)
            done[r] = np.concatenate([done[r], np.zeros_like(near, bool)], axis=1)[pick, top] | (ids[r] < 0)
        order = np.argsort(dist, axis=1, kind="stable")
        return ids[rows, order], np.sqrt(np.maximum(0, 2 * dist[rows, order]))


def balanced_centroids(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """Spherical k-means whose large clusters repel, so that lists come out of like size."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    load = np.zeros(k, np.float32)
    for _ in range(rounds):
        near = np.empty(len(x), np.int64)
        for at in range(0, len(x), 4096):
            near[at : at + 4096] = (x[at : at + 4096] @ c.T - load).argmax(axis=1)
        n = np.bincount(near, minlength=k)
        load = np.clip(load + 0.05 * (n / (len(x) / k) - 1), 0, 0.5).astype(np.float32)
        sums = np.zeros_like(c)
        np.add.at(sums, near, x)
        empty = (n == 0) | (np.linalg.norm(sums, axis=1) == 0)
        sums[empty] = x[rng.choice(len(x), int(empty.sum()))]
        c = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    return c.astype(np.float32)


def build(sample: np.ndarray, n: int, dim: int) -> Index:
    """Index for n classes from a sample of their vectors; without a sample one list."""
    if not len(sample):
        return Index(np.eye(1, dim, dtype=np.float32), np.zeros((1, 1), np.int64), np.zeros(1, np.int64))
    x = unit(sample)
    k = int(max(1, min(MOST_LISTS, len(x) // 4 or 1, -(-n // LIST))))
    c = balanced_centroids(x, k)
    degree = min(DEGREE, k)
    graph = np.empty((k, degree), np.int64)
    half = max(1, degree // 2)
    rng = np.random.default_rng(11)
    for at in range(0, k, 1024):
        near = np.argsort(-(c[at : at + 1024] @ c.T), axis=1, kind="stable")
        graph[at : at + 1024, :half] = near[:, 1 : half + 1] if k > half else near[:, :half]
    # Half nearest, half random: the far edges keep the graph in one piece and short.
    graph[:, half:] = rng.integers(0, k, (k, degree - half))
    return Index(c, graph, rng.choice(k, min(k, 32), replace=False))


def spread(index: Index, ids: np.ndarray, dist: np.ndarray, keep: np.ndarray, most: int) -> np.ndarray:
    """Of the centroids to keep, nearest first, at most `most` for each row (else -1), without those nearer to one already taken."""
    taken, n = np.full((len(ids), most), -1), np.zeros(len(ids), np.int64)
    for j in range(ids.shape[1]):
        good = keep[:, j] & (n < most)
        if not good.any():
            break
        apart = 2 - 2 * np.einsum("bd,bmd->bm", index.centroids[ids[:, j]], index.centroids[taken])
        good &= ((taken < 0) | (apart >= dist[:, j, None] ** 2)).all(axis=1)
        r = np.flatnonzero(good)
        taken[r, n[r]] = ids[r, j]
        n[r] += 1
    return taken


@dataclass
class Lists:
    """What all tasks know: for each length its index and the number of its first list; for each list its parts and pieces."""

    kind: str
    indexes: dict[int, Index]
    first: dict[int, int]
    parts: np.ndarray
    pieces: np.ndarray

    def of(self, dim: int, x: np.ndarray, beam: int, ratio: float, most: int, least: int, spread_out: bool) -> np.ndarray:
        """Lists of unit vectors, -1 where there are no more: centroids within ratio of the nearest one's distance."""
        index, out = self.indexes[dim], []
        for at in range(0, len(x), 512):
            ids, dist = index.nearest(x[at : at + 512], beam)
            keep = (ids >= 0) & ((dist <= ratio * dist[:, :1] + 1e-6) | (np.arange(ids.shape[1]) < least))
            if spread_out:
                own = spread(index, ids, dist, keep, most)
            else:
                own = np.where(keep & (np.cumsum(keep, axis=1) <= most), ids, -1)
            out.append(np.pad(own, ((0, 0), (0, max(0, most - own.shape[1]))), constant_values=-1)[:, :most])
        out = np.concatenate(out)
        return np.where(out >= 0, out + self.first[dim], -1)


def fit(packed: DataFrame, sizes: dict[int, int], kind: str) -> Lists:
    """Lists for packed (vec) with so many vectors of each length, from a sample of at most SAMPLE distinct ones, chosen by hash."""
    n = sum(sizes.values())
    some = packed.select("vec").where(F.pmod(F.xxhash64(F.lit(5), "vec"), F.lit(1_000_000)) < F.lit(min(1.0, 0.8 * SAMPLE / n) * 1e6)).distinct().limit(SAMPLE)
    samples = {dim: x for dim, _, x in _by_length(some.toArrow().column(0).to_pylist(), kind)}
    lists = Lists(kind, {}, {}, np.empty(0, np.int64), np.empty(0, np.int64))
    shares, first = [], 0
    for dim, count in sorted(sizes.items()):
        x = samples.get(dim, np.empty((0, dim)))
        index = lists.indexes[dim] = build(x, count, dim)
        lists.first[dim] = first
        first += len(index.centroids)
        # How long each list will be, by the sample.
        put = np.ones(len(index.centroids)) if not len(x) else np.bincount((lambda f: f[f >= 0])(lists.of(dim, unit(x), BEAM, BOUNDARY, COPIES, 1, True).ravel()) - lists.first[dim], minlength=len(index.centroids))
        shares.append(put * count / max(1, len(x)) if len(x) else put * count)
    size = np.concatenate(shares)
    lists.parts = np.maximum(1, np.ceil(size / PART)).astype(np.int64)
    lists.pieces = np.where(size > 4 * LIST, np.ceil(size / LIST), 1).astype(np.int64)
    return lists


def posted(own: DataFrame, lists) -> DataFrame:
    """list, part, h, code of each class on each of its lists."""

    def run(batches):
        known = lists.value
        for batch in batches:
            hs = batch.column(0).to_numpy()
            for dim, at, x in _by_length(batch.column(1).to_pylist(), known.kind):
                u = unit(x)
                on = known.of(dim, u, BEAM, BOUNDARY, COPIES, 1, True)
                row, col = np.nonzero(on >= 0)
                number, h, code = on[row, col], hs[at][row], codes(u)
                part = (h >> 7) % known.parts[number]
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(part), pa.array(h), pa.array([code[r] for r in row], pa.binary())], names=["list", "part", "h", "code"])

    return own.select("h", "vec").mapInArrow(run, "list bigint, part bigint, h bigint, code binary")


def probed(queries: DataFrame, lists) -> DataFrame:
    """list, part, qid, code of each query (qid, vec) and each part of each list that it reads."""

    def run(batches):
        known = lists.value
        for batch in batches:
            qids = batch.column(0).to_numpy()
            for dim, at, x in _by_length(batch.column(1).to_pylist(), known.kind):
                if dim not in known.indexes:
                    continue
                u = unit(x)
                on = known.of(dim, u, PROBES, REACH, PROBES, LEAST_PROBES, False)
                row, col = np.nonzero(on >= 0)
                times = known.parts[on[row, col]]
                row, number = np.repeat(row, times), np.repeat(on[row, col], times)
                part = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                code = codes(u)
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(part), pa.array(qids[at][row]), pa.array([code[r] for r in row], pa.binary())], names=["list", "part", "qid", "code"])

    return queries.select("qid", "vec").mapInArrow(run, "list bigint, part bigint, qid bigint, code binary")


def piece_centroids(postings: DataFrame, lists) -> DataFrame:
    """list, parts, centroids (bytes) of each list that is cut: fitted on about FITTED of its classes for each piece."""

    def chosen(batches):
        known = lists.value
        for batch in batches:
            number, h = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            # A list's size is about LIST times its pieces, so this share of it is FITTED for each.
            yield batch.filter(pa.array((known.pieces[number] > 1) & (((h >> 3) & 0xFFFF) < 65536 * FITTED / LIST)))

    def fitted(key: tuple, rows: pa.Table) -> pa.Table:
        x = _decoded(rows.column("code"))
        k = int(min(lists.value.pieces[key[0].as_py()], max(1, len(x) // 4)))
        c = balanced_centroids(x / np.maximum(1e-9, np.linalg.norm(x, axis=1, keepdims=True)), k)
        return pa.table({"list": [key[0].as_py()], "parts": [int(lists.value.parts[key[0].as_py()])], "centroids": pa.array([c.astype("<f4").tobytes()], pa.binary())})

    shape = "list bigint, part bigint, h bigint, code binary"
    return postings.mapInArrow(chosen, shape).groupBy("list").applyInArrow(fitted, "list bigint, parts bigint, centroids binary")


def _nearest_pieces(x: np.ndarray, blob: bytes, ratio: float, most: int, least: int) -> np.ndarray:
    """Pieces of each row, -1 where there are no more."""
    c = np.frombuffer(blob, "<f4").reshape(-1, x.shape[1])
    out = []
    for at in range(0, len(x), 1024):
        dist = np.sqrt(np.maximum(0, 2 - 2 * x[at : at + 1024] @ c.T))
        order = np.argsort(dist, axis=1, kind="stable")[:, :most]
        near = np.take_along_axis(dist, order, axis=1)
        own = np.where((near <= ratio * near[:, :1] + 1e-6) | (np.arange(order.shape[1]) < least), order, -1)
        out.append(np.pad(own, ((0, 0), (0, max(0, most - own.shape[1]))), constant_values=-1))
    return np.concatenate(out)


def _cut(columns: tuple[str, ...], ratio: float, most: int, least: int):
    """Rows of one list (or a part of it) to the pieces of that list; a list without pieces is one."""

    def run(rows: pa.Table, pieces: pa.Table) -> pa.Table:
        if not rows.num_rows:
            return rows.select(columns).append_column("piece", pa.array([], pa.int64()))
        blobs = pieces.column("centroids").to_pylist()
        on = _nearest_pieces(_decoded(rows.column("code")), blobs[0], ratio, most, least) if blobs else np.zeros((rows.num_rows, 1), np.int64)
        row, col = np.nonzero(on >= 0)
        return rows.select(columns).take(pa.array(row)).append_column("piece", pa.array(on[row, col].astype(np.int64)))

    return run


def in_pieces(postings: DataFrame, probes: DataFrame, lists) -> tuple[DataFrame, DataFrame]:
    """postings and probes with the pieces of their lists.  Each part of a list is cut by itself, with all centroids of the list."""
    centres = materialize(piece_centroids(postings, lists), "piece-centroids")
    each = centres.select("list", "centroids", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"))
    cut = postings.groupBy("list", "part").cogroup(each.groupBy("list", "part")).applyInArrow(_cut(("list", "h", "code"), BOUNDARY, 2, 1), "list bigint, h bigint, code binary, piece bigint")
    asked = probes.where("part = 0").groupBy("list").cogroup(centres.groupBy("list")).applyInArrow(_cut(("list", "qid", "code"), REACH, PIECES, LEAST_PIECES), "list bigint, qid bigint, code binary, piece bigint")
    return cut, asked


def _ranked(m: int):
    """Of one piece: for each of its queries the m classes whose codes are nearest."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        scores, found = [], []
        if left.num_rows and right.num_rows:
            q, x, h = _decoded(left.column("code")), _decoded(right.column("code")), right.column("h").to_numpy()
            n = min(m, len(x))
            for at in range(0, len(q), 256):
                rough = q[at : at + 256] @ x.T
                top = np.argpartition(-rough, n - 1, axis=1)[:, :n]
                scores += np.take_along_axis(rough, top, axis=1).tolist()
                found += h[top].tolist()
        qids = left.column("qid").to_pylist() if scores else []
        return pa.table({"qid": pa.array(qids, pa.int64()), "scores": pa.array(scores, pa.list_(pa.float32())), "found": pa.array(found, pa.list_(pa.int64()))})

    return run


def _exact(kind: str):
    """qid, qvec, vec, ids to qid, score, ids."""

    def run(batches):
        for batch in batches:
            q, x = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            score, good = np.zeros(len(q)), np.array([len(a) == len(b) for a, b in zip(q, x, strict=True)], bool)
            for _, at, a in _by_length(q, kind):
                at_good = good[at]
                if at_good.any():
                    at, a = at[at_good], a[at_good]
                    score[at] = cosines(a, np.frombuffer(b"".join([x[i] for i in at]), kind).reshape(len(at), -1).astype(np.float64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score), batch.column(3)], names=["qid", "score", "ids"]).filter(pa.array(good))

    return run


def _packed(frame: DataFrame, kind: str) -> DataFrame:
    """id, v to query_id, vec."""

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_bytes(batch.column(1), kind), pa.binary())], names=["query_id", "vec"])

    return frame.mapInArrow(run, "query_id bigint, vec binary")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: for each row of queries (same columns) its k nearest rows of vectors, itself left out.

    Cosine of the original vectors in double precision, ties to the smaller id.  Rows with a null id, and vectors that are
    null, empty, zero, or hold a null or non-finite component, take no part and give no rows.  Vectors of unlike lengths
    are not compared.  Fewer than k candidates give fewer rows; repeated rows of one id and vector count once.
    """
    spark: SparkSession = vectors.sparkSession
    valid, kind = _valid(vectors, id_col, vector_col)
    # Lengths of vectors: one, or few.
    sizes = {r[0]: r[1] for r in valid.groupBy(F.size("v")).count().collect()}
    if not sizes:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    size = sum(d * n for d, n in sizes.items()) * np.dtype(kind).itemsize
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))
    known = fit(_packed(valid, kind), sizes, kind)
    lists = spark.sparkContext.broadcast(known)
    # The exchange of classes is shared by the two plans that read them: postings and originals.
    own = classes(valid, kind, k + 1, parts)

    asked_rows, _ = _valid(queries, id_col, vector_col)
    asked = _packed(asked_rows.select("id", F.col("v").cast(valid.schema["v"].dataType).alias("v")), kind).distinct()
    qs = materialize(asked.groupBy("vec").agg(F.array_sort(F.collect_set("query_id")).alias("asking")).withColumn("qid", F.monotonically_increasing_id()), "queries")

    postings, probes = posted(own, lists), probed(qs, lists)
    if known.pieces.max() > 1:
        # Cut lists are written: their centroids are fitted on what is then cut by them.
        postings, probes = in_pieces(materialize(postings, "posting-lists"), probes, lists)
    else:
        postings, probes = postings.withColumnRenamed("part", "piece"), probes.withColumnRenamed("part", "piece")
    read = probes.groupBy("list", "piece").cogroup(postings.groupBy("list", "piece")).applyInArrow(_ranked(k + 1 + SPARE), "qid bigint, scores array<float>, found array<bigint>")
    pairs = F.transform(F.arrays_zip("scores", "found"), lambda x: F.struct((-x["scores"]).alias("minus"), x["found"].alias("h")))
    # A class is on several lists, at most so many times among a query's first.
    refined = max(REFINED, k + 1 + SPARE)
    best = F.slice(F.array_sort(F.flatten(F.collect_list("pairs"))), 1, refined * COPIES * 2)
    first = read.select("qid", pairs.alias("pairs")).groupBy("qid").agg(F.slice(F.array_distinct(F.transform(best, lambda x: x["h"])), 1, refined).alias("hs"))
    wanted = first.join(qs.select(F.col("qid").alias("of_"), F.col("vec").alias("qvec")), F.col("qid") == F.col("of_")).select("qid", "qvec", F.explode("hs").alias("wanted"))
    fetched = wanted.join(own, F.col("wanted") == F.col("h")).select("qid", "qvec", "vec", "ids").mapInArrow(_exact(kind), "qid bigint, score double, ids array<bigint>")
    near = fetched.select("qid", F.transform("ids", lambda i: F.struct((-F.col("score")).alias("minus"), i.alias("vec_id"))).alias("pairs"))
    merged = near.groupBy("qid").agg(F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("pairs")))), 1, k + 1).alias("pairs"))
    answers = merged.join(qs.select(F.col("qid").alias("of_"), F.explode("asking").alias("query_id")), F.col("qid") == F.col("of_"))
    listed = answers.select("query_id", F.slice(F.filter("pairs", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("pairs"))
    out = listed.select("query_id", F.posexplode("pairs").alias("pos", "pair"))
    return out.select("query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("pair.vec_id").alias("vec_id"), (-F.col("pair.minus")).alias("score"))
