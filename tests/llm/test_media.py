import hashlib
import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sparkloom.llm.media import KEY_EVERY, UNIT, media_columns, pad, read_media, read_payload, walk, write_media


@settings(max_examples=60, deadline=None)
@given(st.binary(max_size=20_000))
def test_round_trip(data):
    payload = pad(data)
    assert len(payload) % UNIT == 0 and payload.startswith(data) and len(payload) > 0
    stored = write_media(payload)
    (track,) = read_media(stored)
    assert read_payload(stored, track) == payload
    assert track.codec == "raw" and track.duration == len(payload) and track.timescale == 8000
    n = len(payload) // UNIT
    assert len(track.key_ranges()) == -(-n // KEY_EVERY)
    for k, (a, b) in enumerate(track.key_ranges()):
        assert stored[a:b] == payload[k * KEY_EVERY * UNIT :][:UNIT]


def test_boxes_nest():
    names = [b"/".join(p) for p, _, _ in walk(memoryview(write_media(bytes(64))))]
    assert names[:3] == [b"ftyp", b"moov", b"moov/mvhd"] and b"moov/trak/mdia/minf/stbl/stss" in names and names[-1] == b"mdat"


def test_malformed_files_fail_with_a_message():
    good = write_media(bytes(640))
    for bad in (good[:-5], good[:30], b"\0\0\0\4abcd", b"\0\0"):
        with pytest.raises(ValueError):
            read_media(bad)


def test_rows(docs, rows, empty):
    found = media_columns(docs).collect()
    by = {}
    for i, t, *_ in rows:
        payload = pad((t or "").encode())
        stored = write_media(payload)
        by[i] = (len((t or "").encode()), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(stored), hashlib.sha256(stored).hexdigest())
    assert len(found) == len(rows)
    for r in found:
        assert tuple(r)[1:7] == by[r.doc_id] and "codec=raw" in r.feature
    assert media_columns(empty).collect() == []


def test_plain_sample_sizes_and_missing_stss_are_read():
    stored = write_media(bytes(range(64)) * 5)
    (track,) = read_media(stored.replace(b"stss", b"free"))
    assert np.array_equal(track.keys, np.arange(5))


GOOD = write_media(bytes(range(256)) * 20)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.integers(0, len(GOOD) - 1), st.integers(0, 255)), min_size=1, max_size=6), st.integers(0, len(GOOD)))
def test_damaged_files_raise_value_errors_only(changes, cut):
    data = bytearray(GOOD)
    for at, value in changes:
        data[at] = value
    for damaged in (bytes(data), bytes(data[:cut])):
        try:
            for track in read_media(damaged):
                track.key_ranges(), track.seconds
        except ValueError:
            pass


def box(kind, *parts):
    body = b"".join(parts)
    return struct.pack(">I4s", len(body) + 8, kind) + body


def test_short_boxes_and_deep_nesting():
    deep = b""
    for _ in range(2000):
        deep = box(b"moov", deep)
    short = box(b"moov", box(b"trak", box(b"mdia", box(b"mdhd", bytes(6)))))
    entry = box(b"moov", box(b"trak", box(b"mdia", box(b"minf", box(b"stbl", box(b"stsd", bytes(4), struct.pack(">I", 1), b"\0\0"))))))
    for bad in (deep, short, entry):
        with pytest.raises(ValueError):
            read_media(bad)


def test_fragments():
    """Two fragments, one with own sizes and marks, one by defaults: ranges, keyframes and duration."""
    full = lambda kind, flags, *parts: box(kind, struct.pack(">I", flags), *parts)
    stbl = box(b"stbl", full(b"stsd", 0, struct.pack(">I", 1), box(b"avc1", bytes(8))), full(b"stsz", 0, struct.pack(">II", 0, 0)))
    trak = box(b"trak", full(b"tkhd", 0, struct.pack(">III", 0, 0, 7)), box(b"mdia", full(b"mdhd", 0, struct.pack(">IIII", 0, 0, 100, 0)), box(b"minf", stbl)))
    head = box(b"ftyp", b"isom") + box(b"moov", trak, box(b"mvex", full(b"trex", 0, struct.pack(">IIIII", 7, 1, 10, 5, 0x10000))))

    def moof(offset):
        run = full(b"trun", 0x605, struct.pack(">IiI", 3, offset, 0), *(struct.pack(">II", size, mark) for size, mark in ((4, 0x10000), (6, 0x10000), (2, 0))))
        return box(b"moof", box(b"traf", full(b"tfhd", 0x20000, struct.pack(">I", 7)), run))

    first = moof(0)
    first = moof(len(first) + 8) + box(b"mdat", b"aaaabbbbbbcc")
    plain = full(b"trun", 1, struct.pack(">Ii", 2, 0))
    second = box(b"moof", box(b"traf", full(b"tfhd", 0, struct.pack(">I", 7)), plain))
    plain = full(b"trun", 1, struct.pack(">Ii", 2, len(second) + 8))
    second = box(b"moof", box(b"traf", full(b"tfhd", 0, struct.pack(">I", 7)), plain)) + box(b"mdat", b"dddddeeeee")
    data = head + first + second
    (track,) = read_media(data)
    assert track.codec == "avc1" and track.duration == 50 and track.seconds == 0.5
    assert [data[a:b] for a, b in track.ranges()] == [b"aaaa", b"bbbbbb", b"cc", b"ddddd", b"eeeee"]
    assert [data[a:b] for a, b in track.key_ranges()] == [b"aaaa", b"cc"]
    assert read_payload(data, track) == b"aaaabbbbbbccdddddeeeee"


def test_all_keyframe_ranges_are_stored(spark):
    text = "keyframes " * 1000
    (r,) = media_columns(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    stored, payload = write_media(pad(text.encode())), pad(text.encode())
    assert [stored[a:b] for a, b in zip(r.key_begins, r.key_ends)] == [payload[k : k + UNIT] for k in range(0, len(payload), KEY_EVERY * UNIT)]
    assert r.codec == "raw" and r.seconds == len(payload) / 8000
