"""GIF columns: code streams, palettes, disposal, transparency, timed frames.

``encode`` stores 8-bit samples as an animated GIF, ``decode`` reads any GIF87a/89a
back into composed frames, and ``frame_table`` stores those as rows with colour
histograms.  Between two clear codes the width of a code depends only on how many
codes came before it, so codes are packed and unpacked in bulk, width by width.

The encoder searches a string table as LZW does.  A sample is the index of a colour
of the 3-3-2 cube, so colours give the samples back.  Long payloads are several
frames; a frame is laid over the one before it (disposal 1), and where a byte value
is free, samples that don't change are written as the transparent index.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import slices

#: Fixed values of the format.
HEADER, TRAILER, IMAGE, EXTENSION, CONTROL = b"GIF89a", 0x3B, 0x2C, 0x21, 0xF9
TABLE = 4096
#: Rows of a stored frame.
MAX_HEIGHT = 256
GREY = np.repeat(np.arange(256, dtype=np.uint8)[:, None], 3, axis=1)
#: Colours of the cube: three bits of red, three of green, two of blue.
CUBE = np.stack([np.arange(256) >> 5 << 5, (np.arange(256) >> 2 & 7) << 5, (np.arange(256) & 3) << 6], axis=1).astype(np.uint8)


class Frame(NamedTuple):
    index: int
    start_ms: int
    delay_ms: int
    canvas: np.ndarray  # height x width x 4, composed RGBA
    area: tuple[int, int, int, int] = (0, 0, 0, 0)  # left, top, width, height of the frame's own part


def _bits_of(codes: np.ndarray, width: int) -> np.ndarray:
    """The bits of codes of one width, least significant first."""
    return ((codes.astype(np.uint16)[:, None] >> np.arange(width, dtype=np.uint16)) & 1).astype(np.uint8).ravel()


def compressed_stream(samples: bytes) -> bytes:
    """LZW codes of 8-bit samples; the table is cleared when it is full."""
    runs, codes, table, after = [], [256], {}, 258
    find, prefix = table.get, samples[0]
    for byte in samples[1:]:
        pair = prefix << 8 | byte
        code = find(pair)
        if code is not None:
            prefix = code
            continue
        codes.append(prefix)
        if after == TABLE:
            runs.append(codes)
            codes, after = [256], 258
            table.clear()
        else:
            table[pair] = after
            after += 1
        prefix = byte
    codes += (prefix, 257)
    parts, starts = [], _STARTS
    for k, run in enumerate((*runs, codes)):
        # The first clear code has nine bits, a later one the width that was reached.
        own = np.array(run, np.uint16)
        if k:
            parts.append(_bits_of(own[:1], 12))
            own = own[1:]
        else:
            parts.append(_bits_of(own[:1], 9))
            own = own[1:]
        for width in range(9, 13):
            part = own[starts[width] : starts[width + 1]]
            if len(part):
                parts.append(_bits_of(part, width))
    return np.packbits(np.concatenate(parts), bitorder="little").tobytes()


def _blocks(data: bytes) -> bytes:
    """Sub-blocks of at most 255 bytes, each after its length."""
    full = len(data) // 255
    head = np.empty((full, 256), np.uint8)
    head[:, 0] = 255
    head[:, 1:] = np.frombuffer(data, np.uint8, full * 255).reshape(full, 255)
    rest = data[full * 255 :]
    return head.tobytes() + (bytes([len(rest)]) + rest if rest else b"") + b"\0"


def encode(payload: bytes, width: int = 64, delay_cs: int = 10) -> bytes:
    """A GIF of ``payload``, whose length must be a positive multiple of ``width``.

    Frames hold up to ``MAX_HEIGHT`` rows; longer payloads make several.
    """
    samples = np.frombuffer(payload, np.uint8)
    rows = len(samples) // width
    height = min(rows, MAX_HEIGHT)
    parts, shown = [HEADER, struct.pack("<HHBBB", width, height, 0xF7, 0, 0), CUBE.tobytes()], None
    for top in range(0, rows, MAX_HEIGHT):
        h = min(MAX_HEIGHT, rows - top)
        own, free = samples[top * width : (top + h) * width], None
        if shown is not None:
            unused = np.flatnonzero(np.bincount(own, minlength=256) == 0)
            free = int(unused[-1]) if len(unused) else None
        stored = own if free is None else np.where(own == shown[: len(own)], np.uint8(free), own)
        parts.append(struct.pack("<BBBBHBB", EXTENSION, CONTROL, 4, 1 << 2 | (free is not None), delay_cs, free or 0, 0))
        parts.append(struct.pack("<BHHHHBB", IMAGE, 0, 0, width, h, 0, 8))
        parts.append(_blocks(compressed_stream(stored.tobytes())))
        shown = own if shown is None else np.append(own, shown[len(own) :])
    return b"".join([*parts, bytes([TRAILER])])


def samples_of(frame: Frame) -> bytes:
    """The samples that ``encode`` stored as colours, from what is seen of a frame."""
    left, top, w, h = frame.area
    seen = frame.canvas[top : top + h, left : left + w]
    return (seen[..., 0] | seen[..., 1] >> 3 | seen[..., 2] >> 6).tobytes()


def _schedule(least: int, most: int) -> np.ndarray:
    """Width of each code after a clear: the table grows by one with every code
    but the first, and codes widen when it no longer fits."""
    k = np.arange(most)
    table = np.minimum((1 << least) + 2 + np.maximum(k - 1, 0), TABLE)
    return np.minimum(np.maximum(np.ceil(np.log2(table + 1)).astype(int), least + 1), 12)


_WIDTHS = {n: _schedule(n, TABLE + 1) for n in range(1, 12)}
#: First code after a clear, of 8-bit samples, that has so many bits.
_STARTS = {w: int(np.searchsorted(_WIDTHS[8], w)) for w in range(9, 13)} | {13: TABLE * 2}


def _string_table(least: int) -> list[bytes]:
    return [bytes([i & 255]) for i in range(1 << least)] + [b"", b""]


def lzw_decode(data: bytes, least: int, n: int) -> np.ndarray:
    """``n`` samples of a code stream; a stream that ends early leaves zeros."""
    clear, end = 1 << least, (1 << least) + 1
    bits = np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")
    out, have, at, widths = [], 0, 0, _WIDTHS[least]
    while have < n and at + least + 1 <= len(bits):
        run, table, before = 0, None, b""
        while True:  # codes up to the next clear, width by width
            width = int(widths[min(run, len(widths) - 1)])
            same = int(np.searchsorted(widths, width, side="right")) - run if width < 12 else (len(bits) - at) // width
            count = min(same, (len(bits) - at) // width)
            if count <= 0:
                at = len(bits)
                break
            part = bits[at : at + count * width].reshape(count, width)
            codes = part @ (1 << np.arange(width)) if width <= 12 else part
            stops = np.flatnonzero((codes == clear) | (codes == end))
            used = int(stops[0]) if len(stops) else count
            own = codes[:used]
            if table is None and (own < clear).all():
                if used:
                    out.append(own.astype(np.uint8))
                    have += used
                if not len(stops) and width < 12:
                    table, before = _replayed(out[-1].tobytes(), least), bytes([int(own[-1])])
            else:
                table = table if table is not None else _string_table(least)
                before, made = _strings(own.tolist(), table, before)
                out.append(np.frombuffer(made, np.uint8))
                have += len(made)
            at += (used + bool(len(stops))) * width
            run += used
            if len(stops):
                if codes[used] == end:
                    at = len(bits)
                break
            if have >= n:
                at = len(bits)
                break
    got = np.concatenate(out)[:n] if out else np.zeros(0, np.uint8)
    return got if len(got) == n else np.append(got, np.zeros(n - len(got), np.uint8))


def _strings(codes: list[int], table: list[bytes], before: bytes) -> tuple[bytes, bytes]:
    """The last string and all strings of codes; the table grows."""
    found, after = [], len(table)
    for c in codes:
        if c < after:
            text = table[c]
        elif before:
            text = before + before[:1]
        else:
            raise ValueError("a code before its string")
        if before and after < TABLE:
            table.append(before + text[:1])
            after += 1
        found.append(text)
        before = text
    return before, b"".join(found)


def _replayed(literals: bytes, least: int) -> list[bytes]:
    """The table after a run of literal codes."""
    return _string_table(least) + [literals[i : i + 2] for i in range(min(len(literals) - 1, TABLE - (1 << least) - 2))]


def _deinterlaced(rows: np.ndarray) -> np.ndarray:
    out, at = np.empty_like(rows), 0
    for first, step in ((0, 8), (4, 8), (2, 4), (1, 2)):
        n = len(range(first, len(rows), step))
        out[first::step] = rows[at : at + n]
        at += n
    return out


def decode(data: bytes) -> Iterator[Frame]:
    """Composed frames of a GIF, in order; raises ValueError on what isn't one."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    width, height, flags, _, _ = struct.unpack_from("<HHBBB", data, 6)
    at = 13
    shared = None
    if flags & 0x80:
        size = 2 << (flags & 7)
        shared = np.frombuffer(data, np.uint8, size * 3, at).reshape(-1, 3)
        at += size * 3
    canvas = np.zeros((height, width, 4), np.uint8)
    delay, disposal, clear_index, index, clock = 0, 0, None, 0, 0
    while at < len(data) and data[at] != TRAILER:
        if data[at] == EXTENSION:
            if data[at + 1] == CONTROL:
                packed, delay, key = struct.unpack_from("<BHB", data, at + 3)
                disposal, clear_index = packed >> 2 & 7, key if packed & 1 else None
            at = _skipped(data, at + 2)[0]
            continue
        if data[at] != IMAGE:
            raise ValueError("an unknown block")
        left, top, w, h, own = struct.unpack_from("<HHHHB", data, at + 1)
        at += 10
        palette = shared
        if own & 0x80:
            size = 2 << (own & 7)
            palette = np.frombuffer(data, np.uint8, size * 3, at).reshape(-1, 3)
            at += size * 3
        least = data[at]
        at, stream = _skipped(data, at + 1, True)
        samples = lzw_decode(stream, least, w * h).reshape(h, w)
        if own & 0x40:
            samples = _deinterlaced(samples)
        if palette is None:
            palette = GREY
        kept = canvas.copy() if disposal == 3 else None
        y, x = min(h, height - top), min(w, width - left)
        seen = samples[:y, :x]
        area = canvas[top : top + y, left : left + x]
        full = np.full((max(256, len(palette)), 4), 255, np.uint8)
        full[: len(palette), :3] = palette
        if clear_index is None:
            area[:] = full[seen]
        else:
            solid = seen != clear_index
            area[solid] = full[seen[solid]]
        yield Frame(index, clock, delay * 10, canvas.copy(), (left, top, x, y))
        index, clock = index + 1, clock + delay * 10
        if disposal == 2:
            area[:] = 0
        elif disposal == 3:
            canvas = kept
        delay, disposal, clear_index = 0, 0, None


def _skipped(data: bytes, at: int, collect: bool = False) -> tuple[int, bytes]:
    """The place after a chain of sub-blocks, and what is in them."""
    n = 0
    while at + n * 256 < len(data) and data[at + n * 256] == 255:
        n += 1
    head = b""
    if collect and n:
        head = np.frombuffer(data, np.uint8, n * 256, at).reshape(n, 256)[:, 1:].tobytes()
    at += n * 256
    parts = [head]
    while at < len(data) and data[at]:
        if collect:
            parts.append(data[at + 1 : at + 1 + data[at]])
        at += 1 + data[at]
    return at + 1, b"".join(parts)


def histogram(canvas: np.ndarray, bins: int = 8) -> list[list[int]]:
    """Counts of solid pixels by value, for red, green and blue."""
    solid = canvas[..., 3] > 0
    return [np.bincount(canvas[..., k][solid] // (256 // bins), minlength=bins).tolist() for k in range(3)]


FRAME_SCHEMA = "frame int, start_ms bigint, delay_ms bigint, width int, height int, rgba binary, red array<bigint>, green array<bigint>, blue array<bigint>"
_FRAME_NAMES = [c.split()[0] for c in FRAME_SCHEMA.split(", ")]


def described(frame: Frame) -> tuple:
    """A frame as a row of ``FRAME_SCHEMA``."""
    h, w = frame.canvas.shape[:2]
    return (frame.index, frame.start_ms, frame.delay_ms, w, h, frame.canvas.tobytes(), *histogram(frame.canvas))


def frame_table(df: DataFrame, id_col: str, gif_col: str) -> DataFrame:
    """One row per frame: ``doc_id``, times, size, composed RGBA and histograms.

    Null values and bytes that aren't a GIF give one row with a null frame.
    Repeated rows give their frames each, other columns are ignored, an empty table
    gives no rows.  Frames are made one at a time, so a long film is never held.
    """
    kind = df.schema[id_col].dataType.simpleString()
    kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), *[pa.list_(pa.int64())] * 3)

    def rows_of(data: bytes | None) -> Iterator[tuple]:
        """A null row at the end if there is none, or what is left can't be read."""
        n = 0
        try:
            for n, f in enumerate(decode(data or b""), 1):
                yield described(f)
        except (ValueError, struct.error, IndexError):
            n = 0
        if not n:
            yield (None,) * len(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 64):
            for i, data in enumerate(batch.column(1).to_pylist()):
                for row in rows_of(data):
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), *(pa.array([x], k) for x, k in zip(row, kinds, strict=True))], ["doc_id", *_FRAME_NAMES])

    return df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{gif_col}`").cast("binary").alias("g")).mapInArrow(run, f"doc_id {kind}, {FRAME_SCHEMA}")


def payload_of(text: bytes | None) -> bytes:
    raw = text or b""
    return raw + bytes(-len(raw) % 64 if raw else 64)


def text_media(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_media: bool = False) -> DataFrame:
    """Store every text as a GIF, read it back and describe it; one row per row.

    Null text is empty text.  Columns: ``doc_id``, ``n_bytes``, ``payload_bytes``,
    ``payload_sha256`` and ``tail_crc32`` (of the bytes read back),
    ``media_bytes``, ``media_sha256``, ``feature`` (frames, milliseconds and the
    colours of all frames), ``frames`` (start, duration and colour histograms of
    each) and with ``keep_media`` ``media``.  Texts of any length are stored whole.
    Repeated rows are stored each; other columns are ignored, whatever their names;
    an empty table gives no rows.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    counts = pa.list_(pa.int64())
    frame = pa.struct([("start_ms", pa.int64()), ("delay_ms", pa.int64()), ("red", counts), ("green", counts), ("blue", counts)])
    fields = [("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string()), ("frames", pa.list_(frame))]
    fields += [("media", pa.binary())] * keep_media

    def stored(text: bytes | None) -> tuple:
        media = encode(payload_of(text))
        back, bins, frames = [], np.zeros((3, 8), int), []
        for f in decode(media):
            back.append(samples_of(f))
            own = histogram(f.canvas)
            bins += np.array(own)
            frames.append({"start_ms": f.start_ms, "delay_ms": f.delay_ms, **dict(zip(("red", "green", "blue"), own, strict=True))})
        payload = b"".join(back)
        feature = f"frames={len(frames)};ms={frames[-1]['start_ms'] + frames[-1]['delay_ms']};" + ";".join(f"{c}=" + "-".join(map(str, x)) for c, x in zip(("red", "green", "blue"), bins, strict=True))
        out = (len(text or b""), len(payload), sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), sha256(media).hexdigest(), feature, frames)
        return (*out, media) if keep_media else out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 128):
            rows = [stored(t) for t in batch.column(1).to_pylist()]
            arrays = [pa.array(x, k) for x, (_, k) in zip(zip(*rows, strict=True), fields, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *(n for n, _ in fields)])

    types = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary", pa.list_(frame): "array<struct<start_ms:bigint,delay_ms:bigint,red:array<bigint>,green:array<bigint>,blue:array<bigint>>>"}
    schema = f"doc_id {kind}, " + ", ".join(f"{n} {types[k]}" for n, k in fields)
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("binary").alias("t")).mapInArrow(run, schema)


def op7_media_columns(spark, sf_dir: str) -> DataFrame:
    return text_media(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
