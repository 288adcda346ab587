"""Line dedup with two Bloom filters.

One pass sets, for the hash of every long line, bits in a filter of lines seen
once and, if they are there already, in a filter of lines seen twice.  Filters
of different tasks merge by chunk: ``twice`` is the union of the parts' twice
bits and of those bits that two once-filters share, so a line met in two tasks
is never missed.  The second pass lets only lines in ``twice`` leave their task:
their 128-bit digests are counted exactly, which removes the filter's false
positives and chooses the occurrence that stays.

The filters are sized by the bytes of text, up to ``MAX_BITS``, which bounds what
the driver broadcasts (32 MB) and what a task holds (twice that).  Too few bits for
a corpus only mean more suspects to count; the result never changes.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import PRIVATE, SPACE_BYTES, cut, extended, slices

#: Bits of each filter at least and at most, bytes of text a bit, positions set
#: for a hash, bytes of a chunk of a filter.
MIN_BITS, MAX_BITS, TEXT_A_BIT, POSITIONS, CHUNK = 1 << 20, 1 << 28, 16, 3, 4096


def key_of(line: bytes, min_chars: int) -> bytes | None:
    """The key of a line, or None where it has fewer code points."""
    key = line.strip(SPACE_BYTES).lower()
    if len(key) < min_chars or not key.isascii() and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return key


def keys_of(text: bytes | None, min_chars: int) -> set[bytes]:
    return {k for x in (text or b"").split(b"\n") if (k := key_of(x, min_chars)) is not None}


def digest(key: bytes) -> bytes:
    return blake2b(key, digest_size=16).digest()


def _positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    low, high = hashes & np.uint64(0xFFFFFFFF), (hashes >> np.uint64(32)) | np.uint64(1)
    return np.stack([(low + np.uint64(i) * high) % np.uint64(bits) for i in range(POSITIONS)], axis=1).astype(np.int64)


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a packed filter, and the bit of each."""
    at = _positions(hashes, bits)
    return at >> 3, (128 >> (at & 7)).astype(np.uint8)


def _hashes(keys: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(k) for k in keys), np.uint64, len(keys))


def _build(min_chars: int, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for batch in slices(batches):
            keys: list[bytes] = []
            for text in batch.column(0).to_pylist():
                keys += keys_of(text, min_chars)
            found, counts = np.unique(_hashes(keys), return_counts=True)
            at, mask = _places(found, bits)
            again = ((once[at] & mask) > 0).all(axis=1) | (counts > 1)
            np.bitwise_or.at(twice, at[again], mask[again])
            np.bitwise_or.at(once, at, mask)
        a, b = (x.reshape(-1, CHUNK) for x in (once, twice))
        for i in range(0, len(a), 256):
            full = i + np.flatnonzero(a[i : i + 256].any(axis=1))
            if len(full):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(full, pa.int32()), *(pa.array([x[j].tobytes() for j in full], pa.binary()) for x in (a, b))],
                    ["chunk", "once", "twice"],
                )

    return run


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for c, o, t in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            one, two = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
            if c in parts:
                old = parts[c]
                old[1] |= two | (old[0] & one)
                old[0] |= one
            else:
                parts[c] = [one.copy(), two.copy()]
    found = [(c, x[1].tobytes()) for c, x in parts.items() if x[1].any()]
    if found:
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in found], pa.int32()), pa.array([x for _, x in found], pa.binary())], ["chunk", "twice"]
        )


def twice_filter(docs: DataFrame, text_col: str, min_chars: int, bits: int) -> bytes:
    """The packed filter of line hashes seen twice or more: bits / 8 bytes."""
    parts = docs.select(F.col(text_col).cast("binary")).mapInArrow(_build(min_chars, bits), "chunk int, once binary, twice binary")
    merged = parts.repartition("chunk").mapInArrow(_merge, "chunk int, twice binary")
    packed = np.zeros((bits // 8 // CHUNK, CHUNK), np.uint8)
    for c, x in merged.collect():  # at most bits / 8 bytes
        packed[c] = np.frombuffer(bytes(x), np.uint8)
    return packed.tobytes()


def _suspected(keys: list[bytes], packed: np.ndarray, bits: int) -> np.ndarray:
    at, mask = _places(_hashes(keys), bits)
    return ((packed[at] & mask) > 0).all(axis=1)


def filter_bits_for(docs: DataFrame, text_col: str) -> int:
    """A power of two that follows the bytes of text."""
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    return min(MAX_BITS, max(MIN_BITS, 1 << (size // TEXT_A_BIT).bit_length()))


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, filter_bits: int | None = None
) -> DataFrame:
    """Drop lines that many documents share, but for the largest id with them.

    A line's key is the line stripped of ASCII white space, A-Z in lower case.
    Keys of ``min_chars`` code points or more in ``min_docs`` rows or more lose
    all their lines except those of the largest id holding the key.

    Returns every input row with ``text_col`` replaced by the lines kept, joined
    by a newline, and ``n_lines``, ``n_dropped`` (these replace input columns of
    the same name).  Null or empty text is one empty line and comes back empty.
    Each row counts as a document; rows that repeat an id count each, and share
    their decisions.  A null id never is the largest.  Whole texts are read, of any
    length.  ``filter_bits`` is a power of two from 2**15 on; left out, it follows
    the table.  An empty table gives none.
    """
    spark, inner = docs.sparkSession, PRIVATE
    filter_bits = filter_bits or filter_bits_for(docs, text_col)
    packed = spark.sparkContext.broadcast(twice_filter(docs, text_col, min_chars, filter_bits))
    key_id, key_text, key_drop = inner + "id", inner + "text", inner + "drop"

    def suspects_of(texts: list[bytes | None]) -> list[list[bytes]]:
        bits = np.frombuffer(packed.value, np.uint8)
        each = [list(keys_of(t, min_chars)) for t in texts]
        flat = [k for x in each for k in x]
        hit = iter(_suspected(flat, bits, filter_bits)) if flat else iter(())
        return [[k for k in x if next(hit)] for x in each]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = suspects_of(batch.column(1).to_pylist())
            at = np.repeat(np.arange(len(found)), [len(x) for x in found])
            if len(at):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(at)), pa.array([digest(k) for x in found for k in x], pa.binary())], ["id", "key"]
                )

    def divide(want: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in slices(batches):
                found = suspects_of(batch.column(batch.schema.get_field_index(key_text)).to_pylist())
                out = batch.filter(pa.array([bool(x) == want for x in found]))
                if out.num_rows:
                    yield out

        return run

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            kept, n, lost = [], [], []
            drops = batch.column(key_drop).to_pylist() if key_drop in batch.schema.names else [None] * batch.num_rows
            for text, drop in zip(batch.column(key_text).to_pylist(), drops, strict=True):
                lines, gone = (text or b"").split(b"\n"), set(drop or ())
                if gone:
                    stay = [x for x in lines if (k := key_of(x, min_chars)) is None or digest(k) not in gone]
                else:
                    stay = lines
                kept.append(b"\n".join(stay).decode("utf-8", "replace"))
                n.append(len(lines))
                lost.append(len(lines) - len(stay))
            values = {key_text: pa.array(kept, pa.string()), "n_lines": pa.array(n, pa.int64()), "n_dropped": pa.array(lost, pa.int64())}
            cols = [c for c in batch.schema.names if c not in (key_text, key_drop)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in cols), *values.values()], [*cols, *values])

    id_type = docs.schema[id_col].dataType.simpleString()
    suspects = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("t")).mapInArrow(emit, f"id {id_type}, key binary"))
    repeated = suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("id").alias("keep")).filter(F.col("n") >= min_docs)
    # Cut, so that both sides of the join are plain shuffles, which may be split for a frequent line.
    repeated = cut(repeated)
    dropped = suspects.join(repeated, "key").filter(~F.col("id").eqNullSafe(F.col("keep")))
    lists = dropped.groupBy(F.col("id").alias(key_id)).agg(F.collect_set("key").alias(key_drop))

    names = docs.columns
    rest = [c for c in names if c not in (text_col, "n_lines", "n_dropped")]
    base = docs.select(*(F.col(f"`{c}`") for c in rest), F.col(text_col).cast("binary").alias(key_text))
    schema = extended(base.schema)
    body = ", ".join(f"`{c}` {base.schema[c].dataType.simpleString()}" for c in rest)
    final = f"{body}, `{key_text}` string, n_lines bigint, n_dropped bigint"
    # Rows without a suspect are finished in the pass that finds them: one worker a task.
    clean = base.mapInArrow(lambda batches: apply(divide(False)(batches)), final)
    dirty = base.mapInArrow(divide(True), schema).join(lists, F.col(f"`{id_col}`").eqNullSafe(F.col(key_id)), "left").drop(key_id)
    done = clean.unionByName(dirty.mapInArrow(apply, final))
    order = [F.col(key_text).alias(c) if c == text_col else F.col(f"`{c}`") for c in names if c not in ("n_lines", "n_dropped")]
    return done.select(*order, "n_lines", "n_dropped")


def op2_line_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH lines AS (
  SELECT r, doc_id, i, line, translate(trim(line, E'\x20\x09\x0A\x0B\x0C\x0D'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT r, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
    FROM (SELECT *, row_number() OVER () AS r FROM documents))
), repeated AS (
  SELECT k, max(doc_id) AS keep FROM lines WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT r) >= 5
), judged AS (
  SELECT l.r, l.doc_id, l.i, l.line, x.k IS NOT NULL AND l.doc_id IS DISTINCT FROM x.keep AS gone FROM lines l LEFT JOIN repeated x ON l.k = x.k
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY r, doc_id
"""
