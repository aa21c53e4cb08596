"""BPE encoding and decoding over a table of distinct words.

A text is cut at ASCII white space, which no token crosses; what is between is its words.  One pass over the texts makes
blocks of whole documents: a block's distinct words, dealt to buckets by hash, and its documents as places in the list
of those.  Words meet by bucket and become the table of distinct words, where each is encoded once; a join of the ids of
a bucket with the vocabulary gives the pieces they decode to.  Ids and texts go back to the blocks by word, and to the
documents by place.

    blocks (route, ...) --by bucket--> distinct words (route, word, ids) and ids (route, id) --join pieces by id-->
      --by bucket--> ids and texts of each block's words --by block--> documents

Blocks and buckets have about BLOCK_BYTES of text each, so their number grows with the input and their size does not.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, slices, text_bytes

#: Words whose ids a worker keeps between slices: a young and an old half, the old one goes when the young one is full.
KEPT_WORDS = 300_000
#: Text that is encoded at a time where it lies.
ENCODED_BYTES = 16 << 20
#: Text that is cut into words at a time, for blocks.
CUT_BYTES = 8 << 20
#: Text of a block, and of a bucket on average; the least number of buckets, partitions for each; places of documents, and words, in one row.
BLOCK_BYTES = 32 << 20
LEAST_BUCKETS, SPREAD = 8, 4
ROW_PLACES, ROW_WORDS = 1 << 18, 4096
_codecs: dict[str, Codec] = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def codec(path: str) -> Codec:
    """This worker's codec of a tokenizer file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _unsliced(texts: pa.Array) -> pa.Array:
    """texts as an array of its own: Arrow's functions on ASCII misread the offsets of slices."""
    return texts.cast(pa.large_string()).take(pa.array(np.arange(len(texts))))


class Codec:
    """Encodes words (without ASCII white space), whose ids, put together, are a text's."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.stops = {mark: self.ids([mark])[0] for mark in (",", ".")}

    def ids(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _kept(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, as bytes; those that were met lately are not encoded again."""
        new = [w for w in words if w not in self.young and w not in self.old]
        fresh = dict(zip(new, (np.array(i, "<u4").tobytes() for i in self.ids(new)), strict=True))
        out = [self.young[w] if w in self.young else self.old[w] if w in self.old else fresh[w] for w in words]
        self.young.update(zip(words, out, strict=True))
        if len(self.young) > KEPT_WORDS:
            self.old, self.young = self.young, {}
        return out

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the texts (from 0) in the ids of all, and those ids.  Distinct words are encoded once."""
        texts = _unsliced(texts)
        if not pc.any(pc.match_substring(texts, "<|")).as_py():
            texts = pc.ascii_lower(texts)  # special tokens alone tell cases apart
        kind = np.int32 if texts.nbytes < 1 << 31 else np.int64  # a token has a byte at least
        cut = pc.ascii_split_whitespace(texts)
        offsets, coded = cut.offsets.to_numpy() - cut.offsets[0].as_py(), cut.flatten().dictionary_encode()
        del cut, texts
        words, places = coded.dictionary, coded.indices.to_numpy()
        # A letter word before a comma or a full stop is the word and the mark.
        last, head = pc.utf8_slice_codeunits(words, -1), pc.utf8_slice_codeunits(words, 0, -1)
        marked = pc.and_(pc.is_in(last, pa.array(list(self.stops), pa.large_string())), pc.ascii_is_alpha(head))
        base = pc.if_else(marked, head, words).dictionary_encode()
        raw = self._kept(base.dictionary.to_pylist())
        of, flat = base.indices.to_numpy(), np.frombuffer(b"".join(raw), "<u4")
        each = np.fromiter(map(len, raw), kind, len(raw)) // 4
        marked = marked.to_numpy(zero_copy_only=False)
        size = each[of] + marked
        starts = np.cumsum(size, dtype=kind) - size
        ids = np.empty(int(size.sum(dtype=np.int64)), np.uint32)
        ids[_ranges(starts, each[of])] = flat[_ranges((np.cumsum(each, dtype=kind) - each)[of], each[of])]
        ids[(starts + size - 1)[marked]] = np.array([self.stops[m][0] for m in last.filter(pa.array(marked)).to_pylist()], np.uint32)
        size = size[places]
        ends = np.r_[0, np.cumsum(size, dtype=np.int64)][offsets]
        return ends, ids[_ranges(starts[places], size)]


def encoded(docs: DataFrame, path: str, work, shape: pa.Schema, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """work(ids, ends, token ids) -> record batch for slices of docs where they lie, no shuffle; null texts are empty."""
    from pyspark.sql.pandas.types import from_arrow_schema

    frame = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1, ENCODED_BYTES):
                yield work(part.column(0), *codec(path).encode(part.column(1)))
        give_back()

    return frame.mapInArrow(run, from_arrow_schema(shape))


#: Rows of a block (route: the block): which of its words each of its numbers is, then its documents as such numbers; and
#: of its words of one bucket (route: the bucket, negative), which begin at start in the order of all its words.
ROW = "route bigint, block bigint, start bigint, words bigint, doc_ids array<bigint>, sizes binary, payload binary"
ARROW_ROW = pa.schema([(k, pa.int64()) for k in ("route", "block", "start", "words")] + [("doc_ids", pa.list_(pa.int64())), ("sizes", pa.binary()), ("payload", pa.binary())])
#: Distinct words of a bucket by the ROW_WORDS, with their ids; and each distinct id.
WORDS = "route bigint, n bigint, words binary, sizes binary, ids binary, id int"
ARROW_WORDS = pa.schema([("route", pa.int64()), ("n", pa.int64())] + [(k, pa.binary()) for k in ("words", "sizes", "ids")] + [("id", pa.int32())])
#: What goes back to a block: ids of the words from start on, and what they decode to.
BACK = "route bigint, start bigint, sizes binary, ids binary, texts binary"
ARROW_BACK = pa.schema([("route", pa.int64()), ("start", pa.int64())] + [(k, pa.binary()) for k in ("sizes", "ids", "texts")])
DONE = "doc_id bigint, ids array<int>, text string"
ARROW_DONE = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("text", pa.string())])


def _pack(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _unpack(blob: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(blob)


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, compressed with all first bytes together, then all second ones, and so on."""
    return _pack(values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _numbers(blob: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(_unpack(blob), np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _lines(values: pa.Array) -> bytes:
    """Strings without line ends, compressed."""
    return _pack("\n".join(values.to_pylist()).encode())


def _strings(blob: bytes, n: int) -> pa.Array:
    return pa.array(_unpack(blob).decode().split("\n") if n else [], pa.large_string())


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one range after another."""
    ends = np.cumsum(sizes, dtype=np.int64)
    n = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if n < 1 << 31 and (not n or int(starts.max()) + int(sizes.max()) < 1 << 31) else np.int64
    out = np.arange(n, dtype=kind)
    out += np.repeat((starts - (ends - sizes)).astype(kind), sizes)
    return out


class Block:
    """Whole documents of a task: their ids, and their words as they come."""

    def __init__(self, number: int) -> None:
        self.number, self.size = number, 0
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.words: list[pa.Array] = []

    def add(self, ids: pa.Array, texts: pa.Array) -> None:
        cut = pc.ascii_split_whitespace(_unsliced(texts))
        flat, there = cut.flatten(), None
        there = pc.greater(pc.binary_length(flat), 0)  # blanks at the ends of a text leave empty words
        before = np.r_[0, np.cumsum(there.to_numpy(zero_copy_only=False))]
        self.counts.append(np.diff(before[cut.offsets.to_numpy() - cut.offsets[0].as_py()]))
        self.words.append(flat.filter(there))
        self.ids.append(ids)
        self.size += texts.nbytes

    def rows(self, buckets: int) -> Iterator[pa.RecordBatch]:
        """The words of each bucket, sorted; then the documents.  Frequent words get small numbers."""
        coded = pa.chunked_array(self.words, pa.large_string()).combine_chunks().dictionary_encode()
        self.words.clear()
        places, words = coded.indices.to_numpy(), coded.dictionary
        often = np.argsort(-np.bincount(places, minlength=len(words)), kind="stable")
        rank = np.empty(len(words), np.uint32)
        rank[often] = np.arange(len(words), dtype=np.uint32)
        order = pc.sort_indices(words).to_numpy()
        bucket = np.fromiter((zlib.crc32(w.as_buffer()) % buckets for w in words), np.int64, len(words))
        order = order[np.argsort(bucket[order], kind="stable")]
        starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0]).tolist() if len(order) else []
        for a, b in zip(starts, [*starts[1:], len(order)], strict=True):
            yield self._row(-1 - int(bucket[order[a]]), a, b - a, None, None, _lines(words.take(pa.array(order[a:b]))))
        at = np.empty(len(words), np.uint32)
        at[order] = np.arange(len(words), dtype=np.uint32)
        yield self._row(self.number, 0, len(words), None, None, _planes(at[often]))
        places, counts, ids = rank[places], np.concatenate(self.counts), pa.concat_arrays(self.ids)
        ends = np.cumsum(counts)
        at = 0
        while at < len(counts):
            first = int(ends[at] - counts[at])
            end = max(at + 1, int(np.searchsorted(ends, first + ROW_PLACES, "right")))
            yield self._row(self.number, 0, len(words), ids[at:end].to_pylist(), _planes(counts[at:end]), _planes(places[first : int(ends[end - 1])]))
            at = end

    def _row(self, route: int, *values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((route, self.number, *values), ARROW_ROW, strict=True)], schema=ARROW_ROW)


def blocks(docs: DataFrame, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One pass over the texts: see ROW."""
    frame = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        block = Block(number)
        for batch in batches:
            for part in slices(batch, 1, CUT_BYTES):
                if block.ids and block.size + part.column(1).nbytes > BLOCK_BYTES:
                    yield from block.rows(buckets)
                    number += 1
                    block = Block(number)
                block.add(part.column(0), part.column(1))
        if block.ids:
            yield from block.rows(buckets)
        give_back()

    return frame.mapInArrow(run, ROW)


def distinct_words(dealt: DataFrame, path: str) -> DataFrame:
    """The table of distinct words of all blocks that have tokens, packed, see WORDS and unpacked(); a word is encoded once, in its bucket."""

    def encode_bucket(key: tuple, rows: pa.Table) -> pa.Table:
        route = key[0].as_py()
        if route >= 0:
            return ARROW_WORDS.empty_table()
        lists = [_strings(p, n) for p, n in zip(rows.column("payload").to_pylist(), rows.column("words").to_pylist(), strict=True)]
        words, own, out, used = pc.unique(pa.chunked_array(lists, pa.large_string())), codec(path), [], set()
        for at in range(0, len(words), ROW_WORDS):
            some = words[at : at + ROW_WORDS]
            ids = pa.array(own.ids(some.to_pylist()), pa.list_(pa.int32()))
            there = pc.greater(pc.list_value_length(ids), 0)
            some, ids = some.filter(there), ids.filter(there)
            flat = ids.flatten().to_numpy()
            used.update(np.unique(flat).tolist())
            out.append((route, len(some), _lines(some), _planes(pc.list_value_length(ids).to_numpy(zero_copy_only=False)), _planes(flat), None))
        out += [(route, 0, None, None, None, i) for i in sorted(used)]
        return pa.Table.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(ARROW_WORDS)], schema=ARROW_WORDS)

    return dealt.groupBy("route").applyInArrow(encode_bucket, WORDS)


def unpacked(words: DataFrame) -> DataFrame:
    """word, ids: a row for each distinct word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["words"] is not None:
                    ends = np.r_[0, np.cumsum(_numbers(row["sizes"]))]
                    yield pa.RecordBatch.from_arrays([_strings(row["words"], row["n"]).cast(pa.string()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(_numbers(row["ids"]).astype(np.int32)))], names=["word", "ids"])

    return words.select("n", "words", "sizes", "ids").mapInArrow(run, "word string, ids array<int>")


def with_pieces(words: DataFrame, table: DataFrame) -> DataFrame:
    """words with the piece of each row that is an id.  The vocabulary is broadcast: its size is the tokenizer file's."""
    named = table.select(F.col("id").alias("id_"), "piece")
    return words.join(F.broadcast(named), F.col("id") == F.col("id_"), "left").drop("id_")


def _give_back(key: tuple, rows: pa.Table, words: pa.Table) -> pa.Table:
    """A bucket: for each block's words in it their ids and texts.  Words without tokens have no ids."""
    out: list[tuple] = []
    if key[0].as_py() < 0 and rows.num_rows:
        packed = words.filter(pc.is_valid(words.column("words"))).select(["n", "words", "sizes", "ids"]).to_pylist()
        named = words.filter(pc.is_valid(words.column("id")))
        known = pa.chunked_array([_strings(p["words"], p["n"]) for p in packed], pa.large_string())
        sizes = np.concatenate([np.empty(0, np.uint32), *(_numbers(p["sizes"]) for p in packed)]).astype(np.int64)
        flat = np.concatenate([np.empty(0, np.uint32), *(_numbers(p["ids"]) for p in packed)])
        starts = np.cumsum(sizes) - sizes
        piece = named.column("piece").combine_chunks().cast(pa.large_string())
        said = piece.take(pc.index_in(pa.array(flat.astype(np.int32)), named.column("id").combine_chunks()))
        texts = pc.binary_join(pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)], pa.int64()), said), pa.scalar(" ", pa.large_string()))
        for row in rows.select(["block", "start", "words", "payload"]).to_pylist():
            at = pc.index_in(_strings(row["payload"], row["words"]), known.combine_chunks())
            here = at.is_valid().to_numpy(zero_copy_only=False)
            at = at.drop_null().to_numpy()
            size = np.zeros(len(here), np.int64)
            size[here] = sizes[at]
            out.append((row["block"], row["start"], _planes(size), _planes(flat[_ranges(starts[at], sizes[at])]), _lines(texts.take(pa.array(at)))))
    return pa.Table.from_arrays([pa.array([o[k] for o in out], f.type) for k, f in enumerate(ARROW_BACK)], schema=ARROW_BACK)


def _put_together(key: tuple, rows: pa.Table, lists: pa.Table) -> pa.Table:
    """A block: ids and texts of its words in order, then documents by number."""
    if key[0].as_py() < 0 or not rows.num_rows:
        return ARROW_DONE.empty_table()
    give_back()
    sizes, flat, texts = [np.empty(0, np.uint32)], [np.empty(0, np.uint32)], []
    for row in sorted(lists.to_pylist(), key=lambda r: r["start"]):
        sizes.append(_numbers(row["sizes"]))
        flat.append(_numbers(row["ids"]))
        texts.append(_strings(row["texts"], int((sizes[-1] > 0).sum())))
    sizes, flat = np.concatenate(sizes).astype(np.int64), np.concatenate(flat).astype(np.int32)
    if len(sizes) != rows.column("words")[0].as_py():
        raise RuntimeError(f"block {key[0]} has {rows.column('words')[0]} words but got {len(sizes)}: its input came out differently when it was read again")
    texts = pa.chunked_array(texts, pa.large_string()).combine_chunks()
    starts, at_text = np.cumsum(sizes) - sizes, np.cumsum(sizes > 0) - 1
    whose = _numbers(next(r for r in rows.filter(pc.is_null(rows.column("doc_ids"))).column("payload").to_pylist()))
    out = []
    for row in rows.filter(pc.is_valid(rows.column("doc_ids"))).to_batches(max_chunksize=1):
        (row,) = row.to_pylist()
        counts, places = _numbers(row["sizes"]), whose[_numbers(row["payload"])]
        size = sizes[places]
        with_tokens = size > 0  # words without tokens leave no gap
        before = np.r_[0, np.cumsum(with_tokens)][np.r_[0, np.cumsum(counts, dtype=np.int64)]]
        places, size = places[with_tokens], size[with_tokens]
        ends = np.r_[0, np.cumsum(size)][before]
        said = pa.LargeListArray.from_arrays(pa.array(before, pa.int64()), texts.take(pa.array(at_text[places])))
        ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat[_ranges(starts[places], size)]))
        out.append(pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), ids, pc.binary_join(said, pa.scalar(" ", pa.large_string())).cast(pa.string())], schema=ARROW_DONE))
    return pa.Table.from_batches(out, ARROW_DONE)


def encode_by_words(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, text (what the ids decode to) of each whole text, by way of the table of distinct words.

    One row for each row of docs; null and empty texts have no ids and the text ''; a null doc_id stays null; repeated
    rows stay; an empty table gives none.  Blocks are exchanged once and read three times from there: for the distinct
    words, to give ids to each block's words, and to put documents together.
    """
    path = path or default_tokenizer()
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_bytes(text_col)))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BLOCK_BYTES))
    dealt = blocks(docs, buckets, id_col, text_col).repartition(SPREAD * buckets, "route")
    words = with_pieces(distinct_words(dealt, path), pieces(spark, path))
    back = dealt.groupBy("route").cogroup(words.groupBy("route")).applyInArrow(_give_back, BACK)
    return dealt.groupBy("route").cogroup(back.groupBy("route")).applyInArrow(_put_together, DONE)


def piece_table(path: str) -> list[str]:
    """Pieces by id, added tokens included; as many as the tokenizer file has, whatever the corpus."""
    t = codec(path).tokenizer
    return [t.id_to_token(i) or "" for i in range(codec(path).size)]


def pieces(spark, path: str | None = None) -> DataFrame:
    """id, piece: the vocabulary as a table."""
    return spark.createDataFrame(list(enumerate(piece_table(path or default_tokenizer()))), "id int, piece string")


def encode(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of each whole text, encoded where it lies; null texts have none."""
    shape = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def work(own: pa.Array, ends: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([own, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int32)))], schema=shape)

    return encoded(docs, path or default_tokenizer(), work, shape, id_col, text_col)


def decode(coded: DataFrame, table: DataFrame) -> DataFrame:
    """key (unique), ids -> key, text: each place's id joined with its piece (the vocabulary is broadcast: its size is the file's)."""
    places = coded.select("key", F.posexplode("ids").alias("place_", "id_"))
    named = places.join(F.broadcast(table), F.col("id_") == F.col("id"))
    texts = named.groupBy("key").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place_", "piece"))), lambda x: x["piece"]), " ").alias("text"))
    return coded.select(F.col("key").alias("key_")).join(texts, F.col("key_") == F.col("key"), "left").select(F.col("key_").alias("key"), F.coalesce("text", F.lit("")).alias("text"))
