"""Best-fit packing of documents into sequences, improved by a swap-based local search.

Documents are encoded where they lie; what is packed is a small table of pieces (id, place, length).  Pieces are dealt
by hash to groups of bounded size; a group is packed best-fit decreasing, then a local search moves a piece, or swaps one
for one or two for one, between underfull bins wherever that raises the sum of squared fills, until bins empty.  Bins
that are still underfull give their pieces to a next round with fewer groups, down to one small group.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import default_tokenizer, encoded
from .common import materialize

CAPACITY = 4096
SEPARATOR = 1
#: Pieces of a group, and how full a bin must be to be closed in a round before the last.
GROUP = 8_000
CLOSED = 0.998
ROUNDS = 4
#: Rounds of the local search over the underfull bins of a group, and how many of them it takes at a time.
SWEEPS = 6
POOL = 400
#: Bounds of the neighbourhood, which cost exchanges and never pieces: pieces tried for each piece that may leave, pieces of
#: a bin whose pairs are tried, emptiest bins that give two pieces.
PROBES = 6
PAIRED = 40
GIVERS = 12


def pieces_of(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, uid: each document's ids and a separator; longer ones cut at capacity.

    uid tells repeated rows apart; null and empty texts are the separator alone.
    """
    path = path or default_tokenizer()
    step = 4 * capacity
    shape = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())])

    def work(own: pa.Array, ends: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        out: list[tuple] = []
        raw, tail = memoryview(ids.astype("<u4").view(np.uint8)), np.array([SEPARATOR], "<u4").tobytes()
        for i, a, b in zip(own.to_pylist(), (ends * 4).tolist(), (ends[1:] * 4).tolist(), strict=False):
            for k, at in enumerate(range(a, b + 1, step)):  # the separator is one more
                part = raw[at : min(at + step, b)]
                crc, size = zlib.crc32(part), len(part)
                if at + step > b:
                    crc, size = zlib.crc32(tail, crc), size + 4
                out.append((i, k, (at - a) // 4, size // 4, crc))
        return pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(shape)], schema=shape)

    return encoded(docs, path, work, shape, id_col, text_col).withColumn("uid", F.monotonically_increasing_id())


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    """Best-fit decreasing: bins as lists of positions in lengths.  Bins by room are kept in one stack per room."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # the rooms that some open bin has, ascending
    bins: list[list[int]] = []
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        at = bisect.bisect_left(rooms, n)
        if at < len(rooms):
            room = rooms[at]
            b = stacks[room].pop()
            if not stacks[room]:
                del rooms[at]
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - n
        if left:
            if not stacks[left]:
                bisect.insort(rooms, left)
            stacks[left].append(b)
    return bins


def _gain(a: int, b: int, d: int) -> int:
    """Change of the sum of squared fills when d tokens go from fill b to fill a."""
    return 2 * d * (a - b + d)


def local_search(bins: list[list[int]], lengths: np.ndarray, capacity: int = CAPACITY, sweeps: int = SWEEPS) -> list[list[int]]:
    """Exchanges among underfull bins, each raising the sum of squared fills; emptied bins are dropped.

    The fullest bin that has room looks, among the emptier bins, for what fills it best: one piece to move, one to swap
    for a smaller one of its own, or one to swap for two of its own (and the other way round).
    """
    size = [int(x) for x in lengths]
    fill = [sum(size[i] for i in b) for b in bins]
    full = [k for k in range(len(bins)) if fill[k] >= capacity]
    pool = sorted((k for k in range(len(bins)) if fill[k] < capacity), key=lambda k: -fill[k])
    for _ in range(sweeps):
        changed = False
        for start in range(0, len(pool), POOL):
            part = pool[start : start + POOL]
            where = sorted((size[i], k, i) for k in part for i in bins[k])
            for k in sorted(part, key=lambda k: -fill[k]):
                room = capacity - fill[k]
                if not room or not bins[k]:
                    continue
                own = bins[k]
                gives: list[tuple[int, tuple[int, ...]]] = [(0, ())] + [(size[i], (i,)) for i in own]
                if len(own) <= PAIRED:
                    gives += [(size[i] + size[j], (i, j)) for x, i in enumerate(own) for j in own[x + 1 :]]
                best = (0, None)
                for out, items in gives:
                    # The largest piece elsewhere that fits when out leaves; a swap must make this bin fuller.
                    at = bisect.bisect_right(where, (out + room, len(bins), 0)) - 1
                    for probe in range(at, max(-1, at - PROBES), -1):
                        n, other, i = where[probe]
                        d = n - out
                        if d <= 0:
                            break
                        if other == k or i not in bins[other] or fill[other] - d > capacity:
                            continue
                        gain = _gain(fill[k], fill[other], d)
                        if gain > best[0]:
                            best = (gain, (items, other, (i,), d))
                        break
                # Two small pieces of one emptier bin for one or none of this one's.
                for out, items in gives[: 1 + len(own)]:
                    for other in part[-GIVERS:]:
                        theirs = bins[other]
                        if other == k or len(theirs) < 2 or len(theirs) > PAIRED:
                            continue
                        for x, i in enumerate(theirs):
                            for j in theirs[x + 1 :]:
                                d = size[i] + size[j] - out
                                if 0 < d <= room and (gain := _gain(fill[k], fill[other], d)) > best[0]:
                                    best = (gain, (items, other, (i, j), d))
                if best[1]:
                    items, other, got, d = best[1]
                    bins[k] = [i for i in own if i not in items] + list(got)
                    bins[other] = [i for i in bins[other] if i not in got] + list(items)
                    fill[k] += d
                    fill[other] -= d
                    changed = True
                    for i in got:  # the table names the bin that a piece is in
                        where.remove((size[i], other, i))
                        bisect.insort(where, (size[i], k, i))
                    for i in items:
                        where.remove((size[i], k, i))
                        bisect.insort(where, (size[i], other, i))
        pool = sorted((k for k in pool if bins[k] and fill[k] < capacity), key=lambda k: -fill[k])
        if not changed:
            break
    return [b for b in bins if b]


def pack_group(lengths: np.ndarray, capacity: int = CAPACITY) -> list[list[int]]:
    return local_search(best_fit(lengths, capacity), lengths, capacity)


PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, uid bigint, bin bigint, offset bigint, done boolean"


def _pack_sorted(capacity: int, last: bool):
    """Arrow batches sorted by group: packs each group; done marks the pieces of closed bins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if not held:
                return
            t = pa.concat_tables(held).combine_chunks()
            held.clear()
            group = t.column("group").to_numpy()
            for a, b in _runs(group):
                lengths = t.column("length").to_numpy()[a:b]
                n = b - a
                number, offset, done = np.empty(n, np.int64), np.empty(n, np.int64), np.zeros(n, bool)
                for k, items in enumerate(pack_group(lengths, capacity)):
                    at = 0
                    for i in items:
                        number[i], offset[i] = k, at
                        at += int(lengths[i])
                    if last or at >= CLOSED * capacity:
                        done[items] = True
                part = t.slice(a, n).drop_columns(["group"])
                part = part.append_column("bin", pa.array(number + (int(group[a]) << 32))).append_column("offset", pa.array(offset)).append_column("done", pa.array(done))
                yield from part.to_batches()

        for batch in batches:
            t = pa.Table.from_batches([batch])
            if not t.num_rows:
                continue
            group = t.column("group").to_numpy()
            cut = int(np.searchsorted(group, group[-1]))
            if cut or (held and held[-1].column("group")[-1].as_py() != int(group[0])):
                held.append(t.slice(0, cut))
                yield from flush()
                held.append(t.slice(cut))
            else:
                held.append(t)
        yield from flush()

    return run


def _runs(keys: np.ndarray) -> list[tuple[int, int]]:
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    return list(zip(starts.tolist(), [*starts[1:].tolist(), len(keys)], strict=True))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, start, length, ids_crc32, uid) with sequence_id and offset.

    Pieces as long as a sequence are one.  Groups grow in number with the pieces, not in size, so a task's work is
    bounded; an open remainder of about one bin in each group of a round meets others in the next.
    """
    cols = [c.split()[0] for c in PACKED.split(", ")]
    base = cols[:6]
    whole = pieces.where(F.col("length") >= capacity).select("*", F.col("uid").alias("bin"), F.lit(0).cast("bigint").alias("offset"))
    parts = [whole.select(*base, "bin", "offset", F.lit(0).alias("round_"))]
    rest = pieces.where(F.col("length") < capacity).select(*base)
    for k in range(ROUNDS):
        n = rest.count()
        if not n:
            break
        groups = -(-n // GROUP)
        last = groups == 1 or k == ROUNDS - 1
        dealt = rest.withColumn("group", F.pmod(F.xxhash64(F.lit(k), "doc_id", "piece", "uid"), F.lit(groups)).cast("int"))
        # By range, not by hash: few groups would meet in few tasks.
        packed = dealt.repartitionByRange(groups, "group").sortWithinPartitions("group", F.col("length").desc(), "doc_id", "piece", "uid").mapInArrow(_pack_sorted(capacity, last), PACKED)
        packed = materialize(packed, f"packed-{k}")
        parts.append(packed.where("done").select(*base, "bin", "offset", F.lit(k + 1).alias("round_")))
        if last:
            break
        rest = packed.where("not done").select(*base)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("sequence_id", F.col("bin") * (ROUNDS + 1) + F.col("round_")).drop("bin", "round_")


def pack_documents(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every row of docs.

    Null and empty texts, and those without tokens, are one piece, the separator; null ids and repeated rows are packed
    like any other; an empty table gives none.  A text of more than capacity tokens is several pieces, the last shorter.
    """
    pieces = materialize(pieces_of(docs, path, capacity, id_col, text_col), "pieces")
    return pack(pieces, capacity).select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
