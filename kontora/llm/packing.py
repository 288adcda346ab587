"""Packing of tokenised documents into sequences of at most ``capacity`` tokens.

Documents longer than a sequence are cut; what has to be packed is then fully
described by how many pieces have each length, a histogram of at most
``capacity`` numbers whatever the size of the corpus.  The driver reduces and
packs that histogram, with counts instead of items:

* Martello-Toth reduction: a set of up to three lengths is fixed for good when
  it provably dominates every other set that contains a given length.
* Best-fit decreasing packs what the reduction leaves.

The packing becomes a short table of slots, (length, ranks from .. to) -> first
sequence and offset, and each piece finds its slot by its rank among the pieces
of its length.  Ranks come from counts by (length, bucket), so a length that
half of all pieces share is still dealt over many tasks.
"""

from __future__ import annotations

import json
import zlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kontora.llm.common import cut

CAPACITY, END_ID = 1024, 2
#: Fixed value: the split pattern of byte-level vocabularies.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Buckets that all pieces would fill, and rows a bucket may hold beyond it.
BUCKETS, BUCKET_ROWS = 1024, 1_000_000
Pattern = tuple[int, ...]


def byte_pairs(path: str):
    """The vocabulary of a byte-level BPE file as a tiktoken encoding, or None.

    Only a file whose tokens are numbered in the order of their merges, with the
    usual split pattern and no normaliser, has the same ids in both libraries.
    """
    import tiktoken

    with open(path, encoding="utf-8") as f:
        whole = json.load(f)
    model, split = whole["model"], whole.get("pre_tokenizer") or {}
    plain = model.get("type", "BPE") == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
    usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
    added = whole.get("added_tokens") or []
    bare = not any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in added)
    if not (plain and usual and bare) or whole.get("normalizer") or whole.get("post_processor"):
        return None
    # Bytes that print stand for themselves, the others for characters from 256 on.
    printed = [b for b in range(256) if 33 <= b < 127 or 161 <= b and b != 173]
    sign = {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(sorted({*range(256)} - {*printed}))}
    vocabulary, merges = model["vocab"], [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    if any(vocabulary.get(c, 256) > 255 for c in sign) or any(vocabulary.get("".join(m)) != 256 + i for i, m in enumerate(merges)):
        return None
    extra = {t["content"]: t["id"] for t in added}
    ranks = {bytes(map(sign.__getitem__, t)): i for t, i in vocabulary.items() if t not in extra}
    return tiktoken.Encoding("vocabulary", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=extra) if len(ranks) == 256 + len(merges) else None


class Encoder:
    """Token ids as little-endian 32-bit bytes: those of ``Tokenizer.from_file(path)``.

    The same vocabulary is read by a faster library where both agree; texts that
    its pattern gives up on (a million spaces in a row) go to the tokenizer itself,
    as do all texts if the file is of another kind.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.fast = byte_pairs(path)

    def ids(self, text: str) -> np.ndarray:
        if self.fast:
            try:
                return self.fast.encode_to_numpy(text, allowed_special="all")
            except ValueError:  # the pattern's stack is full
                pass
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: list[str]) -> list[bytes]:
        return [self.ids(t).astype("<u4").tobytes() for t in texts]


@lru_cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def cut_points(n: int, capacity: int) -> list[int]:
    """Starts of the pieces of ``n`` ids; only the first may be shorter."""
    if n <= capacity:
        return [0]
    return [*([0] if n % capacity else []), *range(n % capacity, n, capacity)]


def _pieces(path: str, end_id: int, capacity: int, keep_ids: bool):
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        codec = encoder(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                rows, piece, start, length, crc, ids = [], [], [], [], [], []
                for i, own in enumerate(codec.encode([t or "" for t in batch.column(1).to_pylist()])):
                    own += end
                    n = len(own) // 4
                    points = cut_points(n, capacity)
                    for k, (a, b) in enumerate(zip(points, [*points[1:], n], strict=True)):
                        part = own[4 * a : 4 * b]
                        rows.append(i)
                        piece.append(k)
                        start.append(a)
                        length.append(b - a)
                        crc.append(zlib.crc32(part))
                        if keep_ids:
                            ids.append(part)
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, length, crc))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if keep_ids:
                    arrays.append(pa.array(ids, pa.binary()))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names)

    return run


class Packer:
    """Packs a histogram {length: count}; ``patterns`` counts sequences by content."""

    def __init__(self, histogram: dict[int, int], capacity: int):
        self.capacity = capacity
        self.left = {w: n for w, n in histogram.items() if n > 0}
        self.sizes = sorted(self.left)
        self.patterns: Counter[Pattern] = Counter()
        self.reduced = 0

    def largest(self, most: int, without: Pattern = ()) -> int:
        """Largest length of at most ``most`` still there, besides ``without``; 0 if none."""
        at = bisect_right(self.sizes, most)
        while at and self.left[self.sizes[at - 1]] <= without.count(self.sizes[at - 1]):
            at -= 1
        return self.sizes[at - 1] if at else 0

    def reach(self, room: int, without: int) -> int:
        """Largest sum of remaining pieces, besides one ``without``, within ``room``."""
        sums, mask = 1, (1 << (room + 1)) - 1
        for w in self.sizes[: bisect_right(self.sizes, room)]:
            n, step = min(self.left[w] - (w == without), room // w), 1
            while n > 0:
                take = min(step, n)
                sums |= sums << (take * w) & mask
                n -= take
                step *= 2
            if sums >> room & 1:
                return room
        return sums.bit_length() - 1

    def dominating(self, w: int) -> Pattern | None:
        """A set with ``w`` that dominates all feasible sets with ``w``, if one is proved.

        One set dominates another when the other's pieces can be split into groups
        that each fit into the place of a piece of the first.
        """
        room = self.capacity - w
        a = self.largest(room, (w,))
        if not a:
            return (w,)
        if a == room:
            return (w, a)
        if self.reach(room, w) == a:
            return (w, a)  # nothing that may join w weighs more than a alone
        least = [x for s in self.sizes[:3] for x in [s] * min(3, self.left[s] - (s == w))][:3]
        if len(least) == 3 and sum(least) <= room:
            return None  # three or more may join: not examined
        b = self.largest(room - a, (w, a))
        if not b:
            return None
        for y in self.sizes[bisect_right(self.sizes, b) :]:
            x = self.largest(room - y, (w, y))
            if self.left[y] > (y == w) and x and x + y > a and not (x <= a and y <= b or x <= b and y <= a):
                return None
        return (w, a, b)

    def fix(self, found: Pattern) -> None:
        need = Counter(found)
        times = min(self.left[w] // n for w, n in need.items())
        for w, n in need.items():
            self.left[w] -= n * times
            if not self.left[w]:
                del self.left[w]
                self.sizes.remove(w)
        self.patterns[tuple(sorted(found, reverse=True))] += times
        self.reduced += times * len(found)

    def reduce(self) -> None:
        changed = True
        while changed:
            changed = False
            for w in sorted(self.left, reverse=True):
                while w in self.left and (found := self.dominating(w)):
                    self.fix(found)
                    changed = True

    def best_fit(self) -> None:
        bins: dict[int, Counter[Pattern]] = {}
        for w in sorted(self.left, reverse=True):
            n = self.left[w]
            while n:
                room = min((r for r in bins if r >= w), default=0)
                if not room:
                    each = self.capacity // w
                    for size, k in ((each, n // each), (n % each, 1)):
                        if size and k:
                            bins.setdefault(self.capacity - size * w, Counter())[(w,) * size] += k
                    n = 0
                    continue
                content, k = next(iter(bins[room].items()))
                k = min(k, n)
                bins[room][content] -= k
                if not bins[room][content]:
                    del bins[room][content]
                if not bins[room]:
                    del bins[room]
                bins.setdefault(room - w, Counter())[(*content, w)] += k
                n -= k
        for x in bins.values():
            self.patterns.update(x)
        self.left, self.sizes = {}, []

    def pack(self) -> Counter[Pattern]:
        self.reduce()
        self.best_fit()
        return self.patterns


def slots(patterns: Counter[Pattern]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset), sorted."""
    used: Counter[int] = Counter()
    out, base = [], 0
    for content, n in sorted(patterns.items()):
        offset = 0
        for w in content:
            out.append((w, used[w], base, offset))
            used[w] += n
            offset += w
        base += n
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = table.value
        keys = (s[:, 0] << 48) + s[:, 1]
        for batch in batches:
            length, rank = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            at = np.searchsorted(keys, (length << 48) + rank, side="right") - 1
            names = [c for c in batch.schema.names if c != "rank"]
            arrays = [*(batch.column(batch.schema.get_field_index(c)) for c in names), pa.array(s[at, 2] + rank - s[at, 1]), pa.array(s[at, 3])]
            yield pa.RecordBatch.from_arrays(arrays, [*names, "sequence_id", "offset"])

    return run


def pack_documents(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, keep_ids: bool = False
) -> DataFrame:
    """Tokenise, cut and pack ``docs``; one row per piece.

    Returns ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``,
    ``sequence_id``, ``offset`` and with ``keep_ids`` ``ids`` (little-endian
    32-bit ids).  Each document is its ids and then ``end_id``; null and empty
    text give one piece of one id.  Documents over ``capacity`` are cut into
    pieces of ``capacity`` ids, of which the first may be shorter.  Sequences are
    filled from offset 0 without gaps.  Repeated rows are packed each.  Extra
    columns are ignored, an empty table gives no rows.  Texts of any length are
    encoded whole; the strings of special tokens become those tokens.  The
    tokenizer's file must be at ``tokenizer_path`` on every executor.
    """
    spark = docs.sparkSession
    id_type = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * keep_ids
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    pieces = cut(base.mapInArrow(_pieces(tokenizer_path, end_id, capacity, keep_ids), schema))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most capacity rows
    patterns = Packer(histogram, capacity).pack()
    table = spark.sparkContext.broadcast(slots(patterns))
    # A length has as many buckets as its share of the pieces asks for, so there are
    # few buckets in all to number, and none holds much of a frequent length.
    share = min(BUCKET_ROWS, 1 + sum(histogram.values()) // BUCKETS)
    buckets = spark.createDataFrame([(w, 1 + n // share) for w, n in histogram.items()], "length bigint, buckets bigint")
    dealt = pieces.join(F.broadcast(buckets), "length").withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), "buckets"))
    sizes = dealt.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    # Cut, or the join would deal the pieces by length alone, as this window does.
    starts = cut(sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("from")))
    own = W.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = dealt.withColumn("at", F.row_number().over(own)).join(starts, ["length", "bucket"])
    ranked = ranked.withColumn("rank", F.col("from") + F.col("at") - 1).select(*pieces.columns, "rank")
    return ranked.mapInArrow(_place(table), f"{schema}, sequence_id bigint, offset bigint")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, default_tokenizer())
