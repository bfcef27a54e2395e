"""ISO base media files: writing byte payloads as 8-bit samples, and reading structure back without decoding.

``write_media`` makes a file of nested boxes (ftyp, moov with full sample tables, mdat) whose samples are 64-byte
packets of 8-bit mono sound. ``read_media`` walks the boxes of any such file, decodes the sample tables (stts, stsc,
stsz, stco or co64, stss; trex, tfhd and trun of fragments) and returns codec, duration and the byte ranges of samples
and keyframes; payload bytes aren't looked at.

Defined results: a null text is empty; an empty payload is 64 zero bytes; equal texts give equal values; an empty table
gives no rows. Extra columns are ignored. Malformed boxes raise ValueError.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkloom.llm.common import spread

UNIT = 64
PACKETS_A_CHUNK = 64
KEY_EVERY = 16
RATE = 8000
CONTAINERS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts", b"dinf", b"udta", b"mvex", b"moof", b"traf"}
#: Boxes within boxes. The standard's containers nest to a sixth of it.
DEEPEST = 64


def _box(kind: bytes, *parts: bytes) -> bytes:
    body = b"".join(parts)
    size = len(body) + 8
    return (struct.pack(">I4s", size, kind) if size < 2**32 else struct.pack(">I4sQ", 1, kind, size + 8)) + body


def _full(kind: bytes, *parts: bytes) -> bytes:
    return _box(kind, b"\0\0\0\0", *parts)


def pad(data: bytes, unit: int = UNIT) -> bytes:
    """Zero bytes appended up to a positive multiple of ``unit``."""
    return data + bytes(-len(data) % unit if data else unit)


def write_media(payload: bytes) -> bytes:
    """A file that holds ``payload`` (a multiple of 64 bytes) as packets of 8-bit samples."""
    n = len(payload) // UNIT
    chunks = -(-n // PACKETS_A_CHUNK)
    last = n - (chunks - 1) * PACKETS_A_CHUNK
    keys = np.arange(1, n + 1, KEY_EVERY, dtype=">u4")
    runs = [(1, PACKETS_A_CHUNK, 1)] if chunks > 1 else []
    if chunks == 1 or last != PACKETS_A_CHUNK:
        runs.append((chunks, last, 1))
    entry = _box(b"raw ", bytes(6), struct.pack(">H", 1), bytes(8), struct.pack(">HHHHI", 1, 8, 0, 0, RATE << 16))
    wide = len(payload) > 2**32 - 2**20

    def moov(start: int) -> bytes:
        at = start + np.arange(chunks, dtype=np.int64) * (PACKETS_A_CHUNK * UNIT)
        offsets = _full(b"co64", struct.pack(">I", chunks), at.astype(">u8").tobytes()) if wide else _full(b"stco", struct.pack(">I", chunks), at.astype(">u4").tobytes())
        stbl = _box(
            b"stbl",
            _full(b"stsd", struct.pack(">I", 1), entry),
            _full(b"stts", struct.pack(">III", 1, n, UNIT)),
            _full(b"stss", struct.pack(">I", len(keys)), keys.tobytes()),
            _full(b"stsc", struct.pack(">I", len(runs)), *(struct.pack(">III", *r) for r in runs)),
            _full(b"stsz", struct.pack(">II", UNIT, n)),
            offsets,
        )
        length = n * UNIT
        mdhd = _box(b"mdhd", b"\1\0\0\0", struct.pack(">QQIQHH", 0, 0, RATE, length, 0x55C4, 0))
        hdlr = _full(b"hdlr", bytes(4), b"soun", bytes(12), b"\0")
        minf = _box(b"minf", _full(b"smhd", bytes(4)), _box(b"dinf", _full(b"dref", struct.pack(">I", 1), _box(b"url ", b"\0\0\0\1"))), stbl)
        mvhd = _box(b"mvhd", b"\1\0\0\0", struct.pack(">QQIQ", 0, 0, RATE, length), struct.pack(">IH", 1 << 16, 256), bytes(10), _MATRIX, bytes(24), struct.pack(">I", 2))
        tkhd = _box(b"tkhd", b"\1\0\0\7", struct.pack(">QQIIQ", 0, 0, 1, 0, length), bytes(8), struct.pack(">HHHH", 0, 0, 256, 0), _MATRIX, bytes(8))
        return _box(b"moov", mvhd, _box(b"trak", tkhd, _box(b"mdia", mdhd, hdlr, minf)))

    ftyp = _box(b"ftyp", b"isom", struct.pack(">I", 512), b"isomiso2")
    head = 16 if len(payload) + 8 >= 2**32 else 8
    start = len(ftyp) + len(moov(0)) + head
    return b"".join((ftyp, moov(start), _box(b"mdat", payload)))


_MATRIX = struct.pack(">9I", 1 << 16, 0, 0, 0, 1 << 16, 0, 0, 0, 1 << 30)


@dataclass
class Track:
    number: int = 0
    codec: str = ""
    timescale: int = 0
    duration: int = 0
    sizes: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    offsets: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))
    keys: np.ndarray = field(default_factory=lambda: np.empty(0, np.int64))

    @property
    def seconds(self) -> float:
        return self.duration / self.timescale if self.timescale else 0.0

    def ranges(self) -> np.ndarray:
        """(n, 2): begin and end of every sample's bytes."""
        return np.stack([self.offsets, self.offsets + self.sizes], axis=1)

    def key_ranges(self) -> np.ndarray:
        return self.ranges()[self.keys]


def walk(data: memoryview, start: int = 0, end: int | None = None) -> Iterator[tuple[tuple[bytes, ...], int, int]]:
    """(path, begin, end) of each box's body, outer boxes first; bodies that aren't containers aren't entered."""
    open_boxes = [((), start, len(data) if end is None else end)]
    while open_boxes:
        path, start, end = open_boxes.pop()
        if start >= end:
            continue
        if end - start < 8:
            raise ValueError(f"{end - start} bytes are too few for a box")
        size, kind = struct.unpack_from(">I4s", data, start)
        body = start + 8
        if size == 1:
            if end - start < 16:
                raise ValueError("a large box without its size")
            (size,) = struct.unpack_from(">Q", data, start + 8)
            body += 8
        stop = end if size == 0 else start + size
        if stop > end or stop < body:
            raise ValueError(f"box {kind!r} ends outside its parent")
        if len(path) == DEEPEST:
            raise ValueError(f"boxes within {DEEPEST} others")
        yield (*path, kind), body, stop
        open_boxes.append((path, stop, end))
        if kind in CONTAINERS:
            open_boxes.append(((*path, kind), body, stop))


class Fields:
    """Numbers from a box's body; ValueError where the body ends before them."""

    def __init__(self, data: memoryview, at: int, end: int) -> None:
        self.data, self.at, self.end = data, at, end

    def take(self, form: str) -> tuple:
        n = struct.calcsize(">" + form)
        if self.at + n > self.end:
            raise ValueError("a box ends within its fields")
        found = struct.unpack_from(">" + form, self.data, self.at)
        self.at += n
        return found

    def head(self) -> tuple[int, int]:
        """Version and flags."""
        (word,) = self.take("I")
        return word >> 24, word & 0xFFFFFF

    def table(self, n: int, kind: str, width: int) -> np.ndarray:
        if self.at + n * width * np.dtype(kind).itemsize > self.end:
            raise ValueError("a sample table ends outside its box")
        found = np.frombuffer(self.data, kind, n * width, self.at)
        if kind == ">u8" and n and int(found.max()) >= 1 << 63:
            raise ValueError("an offset beyond all files")
        return found.astype(np.int64).reshape(n, width)


def read_media(data: bytes) -> list[Track]:
    """Tracks of a file, from its boxes and sample tables alone; samples of movie fragments follow those of the movie."""
    view, tracks, tables = memoryview(data), [], []
    defaults: dict[int, tuple[int, int, int]] = {}
    fragments: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]] = {}
    moof = track_id = before = 0
    base = ahead = 0
    own = (0, 0, 0)
    for path, at, end in walk(view):
        kind, box = path[-1], Fields(view, at, end)
        if kind == b"moof":
            moof = at - 8 if view[at - 4 : at] == b"moof" else at - 16
            ahead, before = moof, 0
        elif kind == b"trex":
            box.head()
            number, _, *sample = box.take("IIIII")
            defaults[number] = tuple(sample)
        elif kind == b"tfhd":
            _, flags = box.head()
            (track_id,) = box.take("I")
            base = box.take("Q")[0] if flags & 1 else moof if flags & 0x20000 or not before else ahead  # behind the traf before
            before = 1
            if flags & 2:
                box.take("I")
            own = tuple(box.take("I")[0] if flags & bit else given for bit, given in zip((8, 0x10, 0x20), defaults.get(track_id, (0, 0, 0))))
            ahead = base
        elif kind == b"trun":
            _, flags = box.head()
            (n,) = box.take("I")
            if flags & 1:
                ahead = base + box.take("i")[0]
            first = box.take("I")[0] if flags & 4 else None
            columns = [bit for bit in (0x100, 0x200, 0x400, 0x800) if flags & bit]
            rows = box.table(n, ">u4", len(columns)) if columns else np.empty((_some(n, len(data)), 0), np.int64)
            durations, sizes, marks = (rows[:, columns.index(bit)] if bit in columns else np.full(n, given) for bit, given in zip((0x100, 0x200, 0x400), own))
            if first is not None and n:
                marks = np.r_[first, marks[1:]]
            starts = ahead + np.cumsum(sizes) - sizes
            ahead += int(sizes.sum())
            if n and not 0 <= int(starts[0]) <= ahead <= len(data):
                raise ValueError("a fragment's samples lie outside the file")
            fragments.setdefault(track_id, []).append((starts, sizes, np.flatnonzero(marks & 0x10000 == 0), int(durations.sum())))
        elif kind == b"trak":
            tracks.append(Track())
            tables.append({})
        elif not tracks or b"trak" not in path:
            continue
        elif kind == b"tkhd":
            version, _ = box.head()
            tracks[-1].number = box.take("QQI" if version == 1 else "III")[-1]
        elif kind == b"mdhd":
            version, _ = box.head()
            *_, tracks[-1].timescale, tracks[-1].duration = box.take("QQIQ" if version == 1 else "IIII")
        elif kind == b"stsd":
            box.head()
            (n,) = box.take("I")
            if n:
                _, codec = box.take("I4s")
                tracks[-1].codec = codec.decode("latin-1").strip()
        elif kind in (b"stts", b"stsc", b"stss", b"stco", b"co64"):
            box.head()
            tables[-1][kind] = box.table(box.take("I")[0], ">u8" if kind == b"co64" else ">u4", {b"stts": 2, b"stsc": 3}.get(kind, 1))
        elif kind == b"stsz":
            box.head()
            each, n = box.take("II")
            tables[-1][kind] = np.full(_some(n, len(data)), each, np.int64) if each else box.table(n, ">u4", 1)[:, 0]
    for track, t in zip(tracks, tables):
        _lay_out(track, t)
        for starts, sizes, keys, duration in fragments.get(track.number, []):
            track.keys = np.r_[track.keys, keys + len(track.sizes)]
            track.offsets, track.sizes = np.r_[track.offsets, starts], np.r_[track.sizes, sizes]
            track.duration += duration
    return tracks


def _some(n: int, most: int) -> int:
    """A count of samples; each has a byte at least."""
    if n > most:
        raise ValueError(f"{n} samples in {most} bytes")
    return n


def _lay_out(track: Track, t: dict[bytes, np.ndarray]) -> None:
    """Offsets, sizes and keyframes of a track from its tables."""
    sizes = t.get(b"stsz", np.empty(0, np.int64))
    chunk_at = t.get(b"co64", t.get(b"stco", np.empty((0, 1), np.int64)))[:, 0]
    runs = t.get(b"stsc", np.empty((0, 3), np.int64))
    track.sizes = sizes
    if len(sizes):
        chunks = np.diff(np.r_[runs[:, 0], len(chunk_at) + 1])
        if not len(runs) or runs[0, 0] != 1 or (chunks <= 0).any() or runs[:, 1].max() > len(sizes) or int((runs[:, 1] * chunks).sum()) != len(sizes) or (runs[:, 1] <= 0).any():
            raise ValueError("chunks and sample sizes disagree")
        each = np.repeat(runs[:, 1], chunks)
        before = np.cumsum(sizes) - sizes
        first = np.cumsum(each) - each
        track.offsets = before + np.repeat(chunk_at - before[first], each)
    elif len(chunk_at) and len(runs):
        raise ValueError("chunks and sample sizes disagree")
    track.keys = t[b"stss"][:, 0] - 1 if b"stss" in t else np.arange(len(sizes))
    if len(track.keys) and not 0 <= track.keys.min() <= track.keys.max() < len(sizes):
        raise ValueError("a keyframe that is no sample")
    if b"stts" in t and not track.duration:
        track.duration = sum(n * each for n, each in t[b"stts"].tolist())


def read_payload(data: bytes, track: Track) -> bytes:
    """The samples' bytes in order; adjoining ranges are read as one."""
    r = track.ranges()
    starts = np.flatnonzero(np.r_[True, r[1:, 0] != r[:-1, 1]]) if len(r) else np.empty(0, np.int64)
    ends = np.r_[starts[1:], len(r)] - 1 if len(r) else starts
    return b"".join(data[r[s, 0] : r[e, 1]] for s, e in zip(starts, ends))


def feature_of(track: Track) -> str:
    keys = track.key_ranges()
    first, last = (tuple(map(int, keys[i])) if len(keys) else (0, 0) for i in (0, -1))
    return (
        f"codec={track.codec};seconds={track.seconds:.6f};samples={len(track.sizes)};keyframes={len(keys)};"
        f"first={first[0]}-{first[1]};last={last[0]}-{last[1]};ranges_crc32={zlib.crc32(keys.astype('<i8').tobytes()):08x}"
    )


SCHEMA = "n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, codec string, seconds double, key_begins array<long>, key_ends array<long>"


def media_columns(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Store each text as a media file and describe the file as read back, with the byte ranges of all its keyframes. A map over the scan: no shuffle."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def one(text: str | None) -> tuple:
        raw = (text or "").encode()
        stored = write_media(pad(raw))
        (track,) = read_media(stored)
        payload = read_payload(stored, track)
        return len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(stored), hashlib.sha256(stored).hexdigest(), feature_of(track), track.codec, track.seconds, *track.key_ranges().T

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(zip(*(one(t.as_py()) for t in batch.column(1)))) or [()] * 11
            types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))], ["doc_id", *(x.split()[0] for x in SCHEMA.split(", "))])

    return spread(source).mapInArrow(run, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, {SCHEMA}")
