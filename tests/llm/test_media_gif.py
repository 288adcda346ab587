from __future__ import annotations

import struct
import zlib
from hashlib import sha256

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kontora.llm import media_gif as M


@settings(max_examples=60, deadline=None)
@given(st.binary(min_size=1, max_size=3000))
def test_streams_round_trip(data):
    assert M.lzw_decode(M.compressed_stream(data), 8, len(data)).tobytes() == data


def slow_decode(stream, n):
    """A plain decoder, bit by bit."""
    bits, at, out = int.from_bytes(stream, "little"), 0, b""
    table, width, last = None, 9, None
    while len(out) < n:
        code, at = bits >> at & (1 << width) - 1, at + width
        if code == 256:
            table, width, last = [bytes([i]) for i in range(256)] + [b"", b""], 9, None
            continue
        if code == 257:
            break
        text = table[code] if code < len(table) else last + last[:1]
        if last is not None and len(table) < 4096:
            table.append(last + text[:1])
        if len(table) == 1 << width and width < 12:
            width += 1
        out, last = out + text, text
    return out


def test_streams_are_read_by_a_plain_decoder():
    r = np.random.default_rng(4)
    for data in (b"a", b"ab" * 4000, r.integers(0, 256, 9000, dtype=np.uint8).tobytes(), r.integers(97, 101, 60_000, dtype=np.uint8).tobytes()):
        stream = M.compressed_stream(data)
        assert slow_decode(stream, len(data)) == data
    assert len(M.compressed_stream(b"ab" * 4000)) < 400


def test_frames_are_laid_over_each_other():
    """Later frames hold the transparent index where nothing changes."""
    text = b"".join(bytes([97 + i % 7]) * 64 for i in range(600))
    data = M.encode(text)
    got = list(M.decode(data))
    assert len(got) == 3 and b"".join(map(M.samples_of, got)) == text and [f.start_ms for f in got] == [0, 100, 200]
    full = bytes(range(256)) * 200  # no free index
    assert b"".join(map(M.samples_of, M.decode(M.encode(full)))) == full
    same = b"q" * 64 * 512
    assert len(M.encode(same)) < 2 * len(M.encode(same[: 64 * 256])) - len(M.CUBE.tobytes())


def test_long_streams_fill_the_table():
    r = np.random.default_rng(1)
    for data in (r.integers(0, 256, 60_000, dtype=np.uint8).tobytes(), b"ab" * 50_000, b"\0" * 100_000):
        assert M.lzw_decode(M.compressed_stream(data), 8, len(data)).tobytes() == data


def test_truncated_and_foreign_bytes(spark):
    assert M.lzw_decode(M.compressed_stream(bytes(range(100)))[:40], 8, 100).shape == (100,)
    df = spark.createDataFrame([(1, None), (2, b"no gif"), (3, M.encode(b"x" * 64))], "doc_id long, g binary")
    got = {r.doc_id: r.frame for r in M.frame_table(df, "doc_id", "g").collect()}
    assert got == {1: None, 2: None, 3: 0}


def frame(left, top, w, h, samples, disposal=0, clear=None, delay=5, interlaced=False):
    control = struct.pack("<BBBBHBB", 0x21, 0xF9, 4, disposal << 2 | (clear is not None), delay, clear or 0, 0)
    place = struct.pack("<BHHHHBB", 0x2C, left, top, w, h, 0x40 * interlaced, 8)
    return control + place + M._blocks(M.compressed_stream(bytes(samples)))


def gif(w, h, *frames):
    return b"GIF89a" + struct.pack("<HHBBB", w, h, 0xF7, 0, 0) + M.GREY.tobytes() + b"".join(frames) + b";"


def test_disposal_transparency_and_times():
    data = gif(2, 2, frame(0, 0, 2, 2, [1, 2, 3, 4]), frame(0, 0, 1, 1, [9], 3, delay=7), frame(1, 1, 1, 1, [8], 2), frame(0, 0, 2, 1, [0, 7], clear=0))
    got = list(M.decode(data))
    seen = [f.canvas[..., 0].ravel().tolist() for f in got]
    assert seen == [[1, 2, 3, 4], [9, 2, 3, 4], [1, 2, 3, 8], [1, 7, 3, 0]]
    assert got[3].canvas[1, 1, 3] == 0 and [(f.start_ms, f.delay_ms) for f in got] == [(0, 50), (50, 70), (120, 50), (170, 50)]


def test_interlaced_rows():
    rows = [0, 8, 4, 2, 6, 1, 3, 5, 7]
    (f,) = M.decode(gif(1, 9, frame(0, 0, 1, 9, rows, interlaced=True)))
    assert f.canvas[:, 0, 0].tolist() == list(range(9))


def test_text_columns(spark):
    texts = [None, "", "é" * 32, "x" * 63, "x" * 64, "long " * 300_000, "x" * 63]
    df = spark.createDataFrame([(i, t, "z") for i, t in enumerate(texts)], "doc_id long, text string, feature string")
    got = {r.doc_id: r for r in M.text_media(df, keep_media=True).collect()}
    for i, t in enumerate(texts):
        raw = (t or "").encode()
        payload = raw + bytes(-len(raw) % 64 or (0 if raw else 64))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]))
        assert r.media_bytes == len(r.media) and r.media_sha256 == sha256(bytes(r.media)).hexdigest()
        assert [sum(f[c][k] for f in r.frames) for c in ("red", "blue") for k in (0, 7)] == [int(x.split("=")[1].split("-")[k]) for x in r.feature.split(";")[2::2] for k in (0, 7)]
    assert got[3][1:] == got[6][1:] and got[5].feature.startswith("frames=92;ms=9200;") and len(got[5].frames) == 92
    table = M.frame_table(M.text_media(df, keep_media=True).withColumn("frame", F.lit("z")), "doc_id", "media").groupBy("doc_id").agg(F.count("frame").alias("n")).collect()
    assert {r.doc_id: r.n for r in table} == {i: len(got[i].frames) for i in got}
    assert M.frame_table(df.limit(0), "doc_id", "text").count() == 0
    assert M.text_media(df.limit(0)).count() == 0
