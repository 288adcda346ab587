"""MinHash near-duplicate detection by an inverted join of signature coordinates.

Every document has a signature of ``COORDINATES`` coordinates, each a hash of
``ROWS`` minima, and a finer sketch: the least hash of each of ``BINS`` equal
bins of the hash range, four bits of it (one-permutation hashing).  A document is posted
under each coordinate-value pair of its prefix: two documents that agree on at
least ``MATCHES`` coordinates must meet within the first
``COORDINATES - MATCHES + 1`` of them, so the others are never posted.

Exact copies collapse to one representative first.  Links are then found in two
rounds, neither of which emits all pairs of a posting list:

* merge round: the postings, sorted over all partitions, are read as a stream.
  Each document meets the first and the previous document of its list; meetings
  are counted over the coordinates and the best of each kind is verified.  This
  is linear in the postings, and ties lists of true copies together.
* rest round: lists whose documents are still in several components are compared
  across components only, in blocks.  A pair is skipped when it shares an
  earlier coordinate, when the set sizes rule it out, or when too few bins of
  the sketches match.  The largest component of a list is never compared with
  itself, so the work follows what the first round left open.

All links are confirmed on the full shingle sets, rebuilt from both texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import cut, slices, small_enough

COORDINATES, ROWS, MATCHES = 20, 3, 2
#: Bins of the sketch.  Pairs are confirmed if their bins allow the similarity
#: within so many standard deviations of its estimate.
BINS, DEVIATIONS = 1024, 5.5
#: Side of a block of the rest round.
BLOCK = 512
#: Most ids that may be broadcast (8 bytes each) to pick texts for confirming.
BROADCAST_IDS = 1_000_000
#: Most rows (of at most four numbers) that the rest round broadcasts; more are joined by a shuffle.
BROADCAST_ROWS = 200_000
#: Most links (16 bytes each) whose components are found by one task; more take rounds over all.
LINKS_AT_ONCE = 1_000_000
#: Word hashes kept by a worker.
CACHE = 150_000


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Words()


def words_of(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case."""
    return (text or b"").lower().split()


def shingle_set(words: list[bytes], width: int) -> set[bytes]:
    """The set itself, for confirming: shingles as their joined words."""
    if len(words) < width:
        return {b" ".join(words)} if words else set()
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles."""
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, len(words))
    width = min(width, len(words))
    h = np.zeros(len(words) - width + 1, np.uint64)
    for i in range(width):
        h = _mix(h + w[i : len(words) - width + 1 + i] + np.uint64(0x9E3779B97F4A7C15))
    return np.unique(h)


@lru_cache
def _multipliers(n: int) -> np.ndarray:
    return np.random.default_rng(20_240_601).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def minima(hashes: np.ndarray, n: int) -> np.ndarray:
    """``n`` minima, under multiplications by odd numbers; in blocks, for long sets."""
    odd, out = _multipliers(n), np.full(n, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(hashes), 512):
        out = np.minimum(out, (hashes[at : at + 512, None] * odd).min(axis=0))
    return out


def sketch_of(hashes: np.ndarray) -> bytes:
    """A code of 1 to 15 for the least of the sorted hashes in each bin, 0 if none."""
    place = (hashes >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
    first = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
    codes = np.zeros(BINS, np.uint8)
    codes[place[first]] = _mix(hashes[first]) % np.uint64(15) + np.uint64(1)
    return (codes[::2] | codes[1::2] << 4).tobytes()


def agree(one: np.ndarray, many: np.ndarray, sizes: np.ndarray, similarity: float) -> np.ndarray:
    """Which rows of ``many`` may reach ``similarity`` with ``one``; ``sizes`` adds
    up the two sets of each pair.  The variance is that of one-permutation hashing
    (Li, Owen and Zhang 2012): small when the bins hold most of the union."""
    x = one ^ many
    either = one | many
    same = ((x & 15) == 0) & ((either & 15) > 0), ((x >> 4) == 0) & ((either >> 4) > 0)
    both = np.count_nonzero(either & 15, axis=1) + np.count_nonzero(either >> 4, axis=1)
    hits = np.count_nonzero(same[0], axis=1) + np.count_nonzero(same[1], axis=1)
    union = np.maximum(sizes / (1 + similarity), 2)
    spread = similarity * (1 - similarity) * np.maximum((1 + 1 / (union - 1)) / np.maximum(both, 1) - 1 / (union - 1), 1e-5)
    return hits >= both * (similarity - DEVIATIONS * np.sqrt(spread)) - 1


def signature(hashes: np.ndarray) -> tuple[np.ndarray, bytes]:
    own = minima(hashes, COORDINATES * ROWS).reshape(COORDINATES, ROWS)
    c = np.zeros(COORDINATES, np.uint64)
    for j in range(ROWS):
        c = _mix(c + own[:, j] + np.uint64(0x9E3779B97F4A7C15))
    return c.view(np.int64), sketch_of(hashes)


def _describe(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, own, coords, sketch = [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingle_hashes(words_of(text), width)
                c, s = signature(h) if len(h) else (None, None)
                n.append(len(h))
                own.append(blake2b(h.tobytes(), digest_size=16).digest() if len(h) else None)
                coords.append(c)
                sketch.append(s)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            arrays = [pa.array(x, k) for x, k in zip((n, own, coords, sketch), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["id", "n", "own", "coords", "sketch"])

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each posting with the first and the previous one of its list."""
    key, first, last = None, None, None
    for batch in batches:
        a, b, kind = [], [], []
        for k, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if k != key:
                key, first = k, doc
            else:
                for other, what in ((first, 0), (last, 1)) if last != first else ((first, 0),):
                    if other != doc:
                        a.append(other)
                        b.append(doc)
                        kind.append(what)
            last = doc
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(kind, pa.int32())], ["a", "b", "kind"])


def _cell(rows: list[tuple], similarity: float) -> tuple[list[int], list[int]]:
    """Pairs of one block: rows that ask (or None: all) against those that answer."""
    right = [r for r in rows if not r[0]]
    left = [r for r in rows if r[0] or r[0] is None and r[5]]
    found_a, found_b = [], []
    if not left or not right:
        return found_a, found_b
    _, _, doc, n, comp, open_ = (np.array(x) for x in zip(*(r[:6] for r in right), strict=True))
    coords = np.array([r[6] for r in right])
    sketch = np.frombuffer(b"".join(r[7] for r in right), np.uint8).reshape(len(right), -1)
    doc, n, comp, open_ = doc.astype(np.int64), n.astype(np.int64), comp.astype(np.int64), open_.astype(bool)
    for _, j, own, m, of, _, c, s in left:
        at = np.flatnonzero((comp != of) & (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9) & ((doc > own) | ~open_))
        if len(at):
            same = coords[at] == np.array(c)
            at = at[(same.argmax(axis=1) == j) & (same.sum(axis=1) >= MATCHES)]
        if len(at):
            at = at[agree(np.frombuffer(s, np.uint8), sketch[at], n[at] + m, similarity)]
            found_a += [own] * len(at)
            found_b += doc[at].tolist()
    return found_a, found_b


def _compare(similarity: float):
    """Reads blocks one after the other; their rows are sorted together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            a, b = [], []
            for k, u, v, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k, u, v) != key:
                    for out, new in zip((a, b), _cell(rows, similarity), strict=True):
                        out += new
                    key, rows = (k, u, v), []
                rows.append(tuple(row))
            if a:
                yield _pairs(a, b)
        a, b = _cell(rows, similarity)
        if a:
            yield _pairs(a, b)

    return run


def _pairs(a: list[int], b: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _confirm(width: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ok, held, own = [], None, set()
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if x != held:
                    held, own = x, shingle_set(words_of(x), width)
                other = shingle_set(words_of(y), width)
                both = len(own & other)
                ok.append(both > 0 and 100 * both >= percent * (len(own) + len(other) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok))

    return run


def _reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Least id reachable of each end: roots are hung under lesser ones until no link joins two."""
    ends = [np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]) for batch in batches]
    ids, at = np.unique(np.concatenate(ends, axis=1) if ends else np.zeros((2, 0), np.int64), return_inverse=True)
    u, v = at.reshape(2, -1)
    top = np.arange(len(ids))
    while True:
        x, y = top[u], top[v]
        live = x != y
        if not live.any():
            break
        u, v = u[live], v[live]
        np.minimum.at(top, np.maximum(x, y)[live], np.minimum(x, y)[live])
        while ((up := top[top]) != top).any():
            top = up
    comp = ids[top]
    for k in range(0, len(ids), 10_000):
        yield pa.RecordBatch.from_arrays([pa.array(ids[k : k + 10_000]), pa.array(comp[k : k + 10_000])], ["id", "comp"])


def components(links: DataFrame) -> DataFrame:
    """(id, comp) of the nodes of ``links`` (a, b): comp is the least id reachable.

    ``links`` is read more than once.  Up to ``LINKS_AT_ONCE`` of them go through
    one task.  More alternate large-star and small-star steps (logarithmic
    rounds), each a partial aggregation and a join that adaptive execution may
    split; every round is checkpointed and nothing but a count reaches the driver.
    """
    edges = links.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    if small_enough(edges, LINKS_AT_ONCE):
        return cut(edges.coalesce(1).mapInArrow(_reach, "id bigint, comp bigint"))
    before = None
    while True:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = cut(small.distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("id"), F.col("v").alias("comp"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """Classes of documents whose shingle sets reach ``percent`` / 100 Jaccard.

    Returns one row per input row: ``doc_id``, ``n_shingles`` (size of the set of
    distinct ``width``-word shingles; a shorter text is one shingle, a text
    without words or null has none), ``component_id`` (least id reachable over
    links), ``kept`` (the id is the component's). Texts without shingles link with
    nothing.  Ids must be whole numbers; rows that repeat an id are one document
    each with the same component, a null id stays alone with a null component.
    Rows with equal sets are linked through their least id.  Whole texts count, of
    any length.  Extra columns are ignored.  An empty table gives no rows.
    """
    base = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    known = cut(base.mapInArrow(_describe(width), "id bigint, n bigint, own binary, coords array<bigint>, sketch binary"))
    classes = cut(known.filter("own is not null and id is not null").groupBy("own").agg(F.min("id").alias("rep")))
    at = (known["own"] == classes["own"]) & (known["id"] == classes["rep"])
    signed = cut(known.join(classes, at).select("id", "n", "coords", "sketch"))
    comp = components(cut(_links(base, signed, width, percent)))
    labels = classes.join(comp, classes["rep"] == comp["id"], "left").select("own", F.coalesce("comp", "rep").alias("component_id"))
    out = known.select("id", "n", "own").join(labels, "own", "left")
    out = out.withColumn("component_id", F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")))
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return out.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id", kept.alias("kept"))


def _links(base: DataFrame, signed: DataFrame, width: int, percent: int) -> DataFrame:
    pairs = "a bigint, b bigint"
    met = _posts(signed).select("key", "id").repartitionByRange("key", "id").sortWithinPartitions("key", "id")
    met = met.mapInArrow(_meet, "a bigint, b bigint, kind int")
    counted = met.groupBy("a", "b", "kind").agg(F.count(F.lit(1)).alias("hits"))
    best = counted.groupBy("b", "kind").agg(F.max(F.struct("hits", (-F.col("a")).alias("a"))).alias("x"))
    first = cut(_confirmed(base, cut(best.select((-F.col("x.a")).alias("a"), "b").distinct()), width, percent, pairs))
    rest = cut(_rest(signed, components(first), percent / 100, pairs))
    return first.union(_confirmed(base, rest, width, percent, pairs))


def _posts(docs: DataFrame) -> DataFrame:
    """A row for each posting of ``docs``, with all columns but ``coords``."""
    rest = [c for c in docs.columns if c != "coords"]
    each = docs.select(*rest, F.posexplode(F.slice("coords", 1, COORDINATES - MATCHES + 1)).alias("j", "value"))
    return each.select(F.xxhash64("j", "value").alias("key"), "j", *rest)


def _handy(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if small_enough(df, BROADCAST_ROWS) else df


def _rest(signed: DataFrame, comp: DataFrame, similarity: float, pairs: str) -> DataFrame:
    """Pairs across components, of lists that hold several, worth confirming.

    Components are joined to documents, not to postings, and signatures only to
    the postings of such lists.
    """
    at = _posts(signed.select("id", "coords").join(_handy(comp), "id", "left").select("id", "coords", F.coalesce("comp", "id").alias("comp")))
    sizes = at.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("n"))
    lists = sizes.groupBy("key").agg(F.max(F.struct("n", "comp"))["comp"].alias("largest"), F.sum("n").alias("total"), F.max("n").alias("most"))
    lists = cut(lists.filter("total > most"))
    number = lambda c: F.ceil(c / BLOCK).cast("int")
    rows = at.join(_handy(lists), "key").select(
        "key", "j", "id", "comp", (F.col("comp") != F.col("largest")).alias("open"), number(F.col("total") - F.col("most")).alias("u_sides"), number(F.col("total")).alias("v_sides")
    )
    side = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    cell = lambda u, v, asks: F.struct(u.alias("u"), v.alias("v"), F.lit(asks).cast("boolean").alias("asks"))
    whole = F.array(cell(F.lit(0), F.lit(0), None))
    left = F.when(F.col("open"), F.transform(every("v_sides"), lambda v: cell(side("u_sides"), v, True))).otherwise(F.array().cast("array<struct<u:int,v:int,asks:boolean>>"))
    right = F.transform(every("u_sides"), lambda u: cell(u, side("v_sides"), False))
    one = (F.col("u_sides") == 1) & (F.col("v_sides") == 1)
    cells = rows.select("key", "j", "id", "comp", "open", F.explode(F.when(one, whole).otherwise(F.concat(left, right))).alias("cell"))
    cells = cells.join(signed, "id").select("key", "cell.u", "cell.v", "cell.asks", "j", "id", "n", "comp", "open", "coords", "sketch")
    return cells.repartition("key", "u", "v").sortWithinPartitions("key", "u", "v").mapInArrow(_compare(similarity), pairs).distinct()


def _confirmed(base: DataFrame, candidates: DataFrame, width: int, percent: int, pairs: str) -> DataFrame:
    text = base.filter("id is not null")
    ids = candidates.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    if small_enough(ids, BROADCAST_IDS):  # else the joins alone pick the texts
        text = text.join(F.broadcast(ids), "id", "left_semi")
    x = candidates.join(text.select(F.col("id").alias("a"), F.col("text").alias("x")), "a")
    both = x.join(text.select(F.col("id").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    return both.mapInArrow(_confirm(width, percent), pairs)


def op8_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, width=3, percent=85)


#: Exact similarities of all pairs that share a shingle, and what is reachable over links.
ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))) END AS s FROM w
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.b FROM reached r JOIN edges e ON r.c = e.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.c AS component_id, s.doc_id = m.c AS kept
FROM sets s JOIN (SELECT doc_id, min(c) AS c FROM reached GROUP BY doc_id) m ON s.doc_id = m.doc_id
"""
