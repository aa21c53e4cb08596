"""Media columns in ISO media containers.

A payload is stored as the samples of one track of an ISO base media file: 8-bit unsigned mono samples in frames of
FRAME bytes, every tenth frame marked as a sync sample.  Reading walks the nested boxes and decodes the sample tables
(sizes, chunks, offsets, times, sync samples) of each track, and the runs of fragments; codec, duration and keyframe byte
ranges come from there alone, and the payload is gathered by byte ranges, never decoded.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from .common import arrow_schema, map_texts, slices

UNIT = 192
RATE = 8000
FRAME = 192
CHUNK_FRAMES = 16
KEY_EVERY = 10
#: Boxes that hold boxes, with the bytes of their own before those (fixed by the format).
CONTAINERS = {b"moov": 0, b"trak": 0, b"mdia": 0, b"minf": 0, b"dinf": 0, b"stbl": 0, b"edts": 0, b"udta": 0, b"mvex": 0, b"moof": 0, b"traf": 0, b"stsd": 8, b"dref": 8}
#: Boxes inside one another that are walked; deeper ones are no media file's.
DEPTH = 16
MATRIX = struct.pack(">9I", 0x10000, 0, 0, 0, 0x10000, 0, 0, 0, 0x40000000)


def pad(text: bytes) -> bytes:
    """text with spaces up to a positive multiple of UNIT."""
    return text.ljust(max(UNIT, -(-len(text) // UNIT) * UNIT), b" ")


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    if len(body) + 8 >= 1 << 32:
        return struct.pack(">I4sQ", 1, kind, len(body) + 16) + body
    return struct.pack(">I4s", len(body) + 8, kind) + body


def _full(kind: bytes, *parts: bytes, version: int = 0, flags: int = 0) -> bytes:
    return _box(kind, struct.pack(">I", version << 24 | flags), *parts)


def _u32s(*values: int) -> bytes:
    return struct.pack(f">{len(values)}I", *values)


def mux(payload: bytes) -> bytes:
    """The container of a payload that is a positive multiple of FRAME bytes long."""
    frames = len(payload) // FRAME
    chunks = -(-frames // CHUNK_FRAMES)
    head = _box(b"ftyp", b"isom", _u32s(512), b"isommp41")
    sync = range(1, frames + 1, KEY_EVERY)
    full, rest = divmod(frames, CHUNK_FRAMES)
    runs = ([(1, CHUNK_FRAMES, 1)] if full else []) + ([(full + 1, rest, 1)] if rest else [])
    entry = _box(b"raw ", bytes(6), struct.pack(">HHHIHHHHI", 1, 0, 0, 0, 1, 8, 0, 0, RATE << 16))

    def movie(first: int) -> bytes:
        offsets = [first + i * CHUNK_FRAMES * FRAME for i in range(chunks)]
        wide = offsets[-1] >= 1 << 32
        table = _box(
            b"stbl",
            _full(b"stsd", _u32s(1), entry),
            _full(b"stts", _u32s(1, frames, FRAME)),
            _full(b"stss", _u32s(len(sync), *sync)),
            _full(b"stsc", _u32s(len(runs), *(x for r in runs for x in r))),
            _full(b"stsz", _u32s(FRAME, frames)),
            _full(b"co64", _u32s(chunks), struct.pack(f">{chunks}Q", *offsets)) if wide else _full(b"stco", _u32s(chunks, *offsets)),
        )
        data = _box(b"dinf", _full(b"dref", _u32s(1), _full(b"url ", flags=1)))
        media = _box(b"mdia", _full(b"mdhd", struct.pack(">QQIQHH", 0, 0, RATE, len(payload), 0x55C4, 0), version=1), _full(b"hdlr", bytes(4), b"soun", bytes(12), b"samples\0"), _box(b"minf", _full(b"smhd", bytes(4)), data, table))
        track = _box(b"trak", _full(b"tkhd", struct.pack(">QQIIQ", 0, 0, 1, 0, len(payload)), bytes(8), struct.pack(">hhhH", 0, 0, 0x100, 0), MATRIX, bytes(8), version=1, flags=7), media)
        return _box(b"moov", _full(b"mvhd", struct.pack(">QQIQIH", 0, 0, RATE, len(payload), 0x10000, 0x100), bytes(10), MATRIX, bytes(24), _u32s(2), version=1), track)

    size = 16 if len(payload) + 8 >= 1 << 32 else 8
    index = movie(len(head) + len(movie(0)) + size)
    if len(index) != len(movie(0)):  # 64-bit offsets turned out to be needed
        index = movie(len(head) + len(index) + size)
    return head + index + _box(b"mdat", payload)


def boxes(data: bytes, start: int, end: int, path: tuple = ()):
    """(path of kinds, start, body start, end) of every box, outer before inner; ValueError where sizes do not nest."""
    at = start
    while at < end:
        if end - at < 8:
            raise ValueError("a box is cut off")
        size, kind = struct.unpack_from(">I4s", data, at)
        body = at + 8
        if size == 1:
            if end - at < 16:
                raise ValueError("a box is cut off")
            (size,) = struct.unpack_from(">Q", data, body)
            body += 8
        stop = end if size == 0 else at + size
        if stop < body or stop > end:
            raise ValueError(f"box {kind!r} does not fit")
        yield (*path, kind), at, body, stop
        if kind in CONTAINERS:
            if len(path) >= DEPTH:
                raise ValueError("boxes nest too deep")
            yield from boxes(data, body + CONTAINERS[kind], stop, (*path, kind))
        at = stop


@dataclass
class Track:
    """A track as its sample tables and fragments tell: byte ranges (start, end) of its chunks and of its sync samples."""

    number: int = 0
    kind: str = ""
    codec: str = ""
    timescale: int = 1
    duration: float = 0.0
    samples: int = 0
    chunks: list[tuple[int, int]] = field(default_factory=list)
    keyframes: list[tuple[int, int]] = field(default_factory=list)


def _table(data: bytes, box: tuple[int, int], form: str, skip: int = 0) -> tuple:
    """The entries of a counted table, as one flat tuple."""
    start, end = box
    (n,) = struct.unpack_from(">I", data, start + 4 + skip)
    whole = struct.Struct(f">{n * len(form)}{form[0]}")
    if start + 8 + skip + whole.size > end:
        raise ValueError("a table does not fit its box")
    return whole.unpack_from(data, start + 8 + skip)


def _sampled(data: bytes, found: dict[bytes, tuple[int, int]], codec: bytes) -> Track:
    """A track from its boxes (body start, end)."""
    track = Track(codec=codec.decode("latin-1").strip())
    at = found[b"tkhd"][0]
    (track.number,) = struct.unpack_from(">I", data, at + (20 if data[at] == 1 else 12))
    track.kind = data[found[b"hdlr"][0] + 8 : found[b"hdlr"][0] + 12].decode("latin-1")
    at = found[b"mdhd"][0]
    track.timescale, units = struct.unpack_from(">IQ", data, at + 20) if data[at] == 1 else struct.unpack_from(">II", data, at + 12)
    fixed, track.samples = struct.unpack_from(">II", data, found[b"stsz"][0] + 4)
    sums = None if fixed else [0, *accumulate(_table(data, found[b"stsz"], "I", 4))]
    times = _table(data, found[b"stts"], "II")
    if sum(times[::2]) != track.samples:
        raise ValueError("sample tables disagree")
    track.duration = (units or sum(n * d for n, d in zip(times[::2], times[1::2], strict=True))) / max(1, track.timescale)
    offsets = _table(data, found[b"co64"], "Q") if b"co64" in found else _table(data, found[b"stco"], "I")
    runs = _table(data, found[b"stsc"], "III")
    # First sample of each chunk, by the runs of chunks with as many samples.
    first, firsts = 0, []
    for k in range(0, len(runs), 3):
        last = runs[k + 3] if k + 3 < len(runs) else len(offsets) + 1
        if not runs[k] == len(firsts) + 1 <= last <= len(offsets) + 1:
            raise ValueError("sample tables disagree")
        for _ in range(runs[k], last):
            firsts.append(first)
            first += runs[k + 1]
    if first != track.samples or len(firsts) != len(offsets):
        raise ValueError("sample tables disagree")

    def extent(a: int, b: int) -> int:
        return (b - a) * fixed if sums is None else sums[b] - sums[a]

    track.chunks = [(o, o + extent(a, b)) for o, a, b in zip(offsets, firsts, [*firsts[1:], first], strict=False)]
    if any(b > len(data) for _, b in track.chunks):
        raise ValueError("samples lie beyond the file")
    for s in _table(data, found[b"stss"], "I") if b"stss" in found else range(1, track.samples + 1):
        if not 1 <= s <= track.samples:
            raise ValueError("sample tables disagree")
        c = bisect_right(firsts, s - 1) - 1
        a = offsets[c] + extent(firsts[c], s - 1)
        track.keyframes.append((a, a + extent(s - 1, s)))
    return track


#: Flags of fragments (fixed by the format): of a header, of a run, of a sample.
BASE_OFFSET, DESCRIPTION, OWN_DURATION, OWN_SIZE, OWN_FLAGS = 0x1, 0x2, 0x8, 0x10, 0x20
DATA_OFFSET, FIRST_FLAGS, EACH_DURATION, EACH_SIZE, EACH_FLAGS, EACH_SHIFT = 0x1, 0x4, 0x100, 0x200, 0x400, 0x800
NO_SYNC = 0x10000


def _fragment(data: bytes, moof: int, ended: int, header: int, runs: list[int], tracks: dict[int, Track], defaults: dict[int, tuple]) -> int:
    """Add a fragment's runs to its track; where its data end."""
    bits, number = struct.unpack_from(">II", data, header)
    track, at = tracks[number], header + 8
    _, usual_duration, usual_size, usual_flags = defaults.get(number, (1, 0, 0, 0))
    base = ended
    if bits & BASE_OFFSET:
        (base,) = struct.unpack_from(">Q", data, at)
        at += 8
    elif bits & 0x20000:
        base = moof
    at += 4 * bool(bits & DESCRIPTION)
    values = []
    for flag, usual in ((OWN_DURATION, usual_duration), (OWN_SIZE, usual_size), (OWN_FLAGS, usual_flags)):
        values.append(struct.unpack_from(">I", data, at)[0] if bits & flag else usual)
        at += 4 * bool(bits & flag)
    place = base
    for run in runs:
        bits, n = struct.unpack_from(">II", data, run)
        at = run + 8
        if bits & DATA_OFFSET:
            place = base + struct.unpack_from(">i", data, at)[0]
            at += 4
        head = struct.unpack_from(">I", data, at)[0] if bits & FIRST_FLAGS else None
        at += 4 * bool(bits & FIRST_FLAGS)
        first = place
        for i in range(n):
            duration, size, flags = values
            if i == 0 and head is not None:
                flags = head
            for flag in (EACH_DURATION, EACH_SIZE, EACH_FLAGS, EACH_SHIFT):
                if bits & flag:
                    (value,) = struct.unpack_from(">I", data, at)
                    at += 4
                    duration, size, flags = (value, size, flags) if flag == EACH_DURATION else (duration, value, flags) if flag == EACH_SIZE else (duration, size, value) if flag == EACH_FLAGS else (duration, size, flags)
            if not flags & NO_SYNC:
                track.keyframes.append((place, place + size))
            place += size
            track.duration += duration / max(1, track.timescale)
        if place > len(data):
            raise ValueError("samples lie beyond the file")
        track.samples += n
        if n:
            track.chunks.append((first, place))
    return place


def probe(data: bytes) -> list[Track]:
    """The tracks of a container, in its order; ValueError where it has none or its boxes and tables make no sense."""
    try:
        return _probe(data)
    except (struct.error, KeyError, IndexError, OverflowError, MemoryError) as e:
        raise ValueError(f"{type(e).__name__}: {e}") from e


def _probe(data: bytes) -> list[Track]:
    parts: list[tuple[dict, list[bytes]]] = []
    defaults: dict[int, tuple] = {}
    fragments: list[tuple[int, list]] = []
    for path, at, body, stop in boxes(data, 0, len(data)):
        kind = path[-1]
        if kind == b"trak":
            parts.append(({}, []))
        elif b"trak" in path and path[-2] == b"stsd":
            parts[-1][1].append(kind)
        elif b"trak" in path:
            parts[-1][0].setdefault(kind, (body, stop))
        elif kind == b"trex":
            number, *rest = struct.unpack_from(">5I", data, body + 4)
            defaults[number] = tuple(rest)
        elif kind == b"moof":
            fragments.append((at, []))
        elif kind == b"traf":
            fragments[-1][1].append([0, []])
        elif kind == b"tfhd":
            fragments[-1][1][-1][0] = body
        elif kind == b"trun":
            fragments[-1][1][-1][1].append(body)
    if not parts:
        raise ValueError("no track")
    tracks = [_sampled(data, found, codecs[0] if codecs else b"") for found, codecs in parts]
    by_number = {t.number: t for t in tracks}
    for moof, trafs in fragments:
        ended = moof
        for header, runs in trafs:
            ended = _fragment(data, moof, ended, header, runs, by_number, defaults)
    return tracks


def main_track(tracks: list[Track]) -> Track:
    """The first track of pictures, else the first."""
    return next((t for t in tracks if t.kind == "vide"), tracks[0])


def payload_of(data: bytes, track: Track) -> bytes:
    """The samples' bytes in order, by the chunks' byte ranges."""
    view = memoryview(data)
    return b"".join(view[a:b] for a, b in track.chunks)


def store(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each whole text (null: empty) as a container."""

    def work(ids: list, texts: list) -> dict:
        return {"doc_id": ids, "n_bytes": [len(t) for t in texts], "media": [mux(pad(t)) for t in texts]}

    return map_texts(docs, work, "doc_id bigint, n_bytes bigint, media binary", id_col, text_col)


COLUMNS = "payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, codec string, duration double, keyframe_ranges array<bigint>, tracks int, error string"
NAMES = [c.split()[0] for c in COLUMNS.split(", ")]


def features(data: bytes | None) -> dict:
    """What a row keeps of a container: digests, and codec, duration and keyframe byte ranges (start, end, start, ...) of its main track.

    What is no container, null included, has an error and no features.
    """
    if data is None:
        return dict.fromkeys(NAMES) | {"error": "no container"}
    own = {"media_bytes": len(data), "media_sha256": hashlib.sha256(data).hexdigest()}
    try:
        tracks = probe(data)
    except ValueError as e:
        return dict.fromkeys(NAMES) | own | {"error": str(e)}
    track = main_track(tracks)
    payload, keys = payload_of(data, track), track.keyframes
    ranges = ",".join(f"{a}-{b}" for a, b in keys)
    ends = f"first={keys[0][0]}-{keys[0][1]};last={keys[-1][0]}-{keys[-1][1]}" if keys else "first=;last="
    return own | {
        "payload_bytes": len(payload), "payload_sha256": hashlib.sha256(payload).hexdigest(), "tail_crc32": zlib.crc32(payload[-16:]),
        "feature": f"codec={track.codec};duration={track.duration:.6f};samples={track.samples};keyframes={len(keys)};{ends};ranges={hashlib.sha256(ranges.encode()).hexdigest()[:16]}",
        "codec": track.codec, "duration": track.duration, "keyframe_ranges": [x for k in keys for x in k], "tracks": len(tracks), "error": None,
    }


def inspect(media: DataFrame, media_col: str = "media") -> DataFrame:
    """media with the features of stored containers, read from their bytes, in place of media_col; a broken or null one is a row with an error.

    Columns of media that are called like a feature are left out.
    """
    kept = [c for c in media.columns if c != media_col and c.lower() not in NAMES]
    frame = media.select(*kept, F.col(media_col).cast("binary").alias("media"))
    arrow, last = arrow_schema(media.sparkSession, COLUMNS), len(kept)
    shape = StructType([*frame.schema.fields[:last], *_parse_datatype_string(COLUMNS).fields])

    def run(batches):
        for batch in batches:
            for part in slices(batch, last):
                rows = [features(b) for b in part.column(last).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:last], *(pa.array([r[f.name] for r in rows], f.type) for f in arrow)], names=[*kept, *NAMES])

    return frame.mapInArrow(run, shape)


def media_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, and the features read back from the stored container of each text.  Equal texts have equal values.

    One row for each row of docs, repeated ones included; null ids stay null; null and empty texts hold UNIT spaces.
    """
    return inspect(store(docs, id_col, text_col))
