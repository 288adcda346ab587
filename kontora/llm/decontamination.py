"""Benchmark decontamination by size-partitioned MinHash containment search.

An item is found in a document when at least ``similarity`` of the item's word
shingles are in the document, however long that is.  Jaccard similarity is
useless for a short item in a long text, so only the item is sketched: under a
random order of shingles (their hash), an item of n shingles keeps its
k = n - ceil(similarity * n) + 1 least ones.  A document that contains the item
misses at most k - 1 of its shingles, hence holds one of the k: the search loses
no document.

Sizes partition both sides.  Items are in a class by the power of two of the
shingles a document must have, and so are documents by those they have; a document
is searched for the sketches of its own and lower classes alone, so a short text is
never held against long items.

Documents without a sketched shingle are dropped inside their row, without a
shuffle.  Pairs of keys come out of the search; the texts of these documents are
read again and verified on the shingles themselves.  What is broadcast is sketch
hashes and keys of fixed size, never shingles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import PRIVATE, cut, let, small_enough

WIDTH, SIMILARITY = 5, 0.8
#: Sketch hashes that may be part of the plan (in-memory sets on every executor),
#: and rows of about 100 bytes that may be broadcast; beyond that joins shuffle.
LITERAL_ROWS, BROADCAST_ROWS = 20_000, 100_000
#: Words are runs of letters and digits in lower case.
BETWEEN = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Words of the whole text; null text has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), BETWEEN, -1), lambda w: w != "")


def shingle_hashes(own: Column, width: int) -> Column:
    """Hash of every run of ``width`` words, with repetitions."""

    def body(h: Column) -> Column:
        # Each word is hashed once; a shingle's hash is made of its words'.
        parts = lambda i: [F.get(h, i + k) for k in range(width)]
        return F.transform(F.sequence(F.lit(0), F.size(h) - width), lambda i: F.xxhash64(*parts(i)))

    short = F.array().cast("array<bigint>")
    return let(F.transform(own, lambda w: F.xxhash64(w)), lambda h: F.when(F.size(h) >= width, body(h)).otherwise(short))


def shingles(own: Column, width: int) -> Column:
    """Distinct runs of ``width`` words as text."""
    runs = F.transform(F.sequence(F.lit(1), F.size(own) - width + 1), lambda i: F.array_join(F.slice(own, i, width), " "))
    return F.when(F.size(own) >= width, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def row_key(given: Column, text: Column) -> Column:
    """A key of a row, never null: rows with the same key have the same id and text."""
    of = lambda c: F.sha2(F.coalesce(c.cast("string"), F.lit("")).cast("binary"), 256)
    return F.sha2(F.concat(given.isNull().cast("string"), of(given), of(text)), 256)


def doc_key(given: Column, text: Column) -> Column:
    """The id of a document as text, or what stands for it in a row without one: its text."""
    nameless = F.concat(F.lit("text "), F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256))
    return F.when(given.isNull(), nameless).otherwise(F.concat(F.lit("id "), given.cast("string")))


def sketches(items: DataFrame, item_col: str, text_col: str, width: int, similarity: float) -> DataFrame:
    """(item, row, w, own, need, size_class, sketch): one row per distinct item.

    ``row`` is the key of the item's id and text, ``w`` is the shingle width, less
    than ``width`` only for shorter items; ``own`` are the item's shingles, ``need``
    is how many must be found, ``sketch`` its least hashes.
    """
    given, text = F.col(f"`{item_col}`"), F.col(f"`{text_col}`")
    own = items.select(given.alias("item"), row_key(given, text).alias("row"), words(text).alias("words")).filter(F.size("words") > 0)
    own = own.dropDuplicates(["row"]).withColumn("w", F.least(F.size("words"), F.lit(width)))
    text = hashes = None
    for k in range(width, 0, -1):
        s, h = shingles(F.col("words"), k), shingle_hashes(F.col("words"), k)
        text = s if text is None else F.when(F.col("w") == k, s).otherwise(text)
        hashes = h if hashes is None else F.when(F.col("w") == k, h).otherwise(hashes)
    out = own.select("item", "row", "w", text.alias("own"), F.array_sort(F.array_distinct(hashes)).alias("hashes"))
    need = F.ceil(F.size("own") * F.lit(similarity) - F.lit(1e-9)).cast("int")
    out = out.withColumn("need", need).withColumn("k", F.size("hashes") - F.col("need") + 1)
    # The hash is the random order: the least hashes are the sketch.
    return out.select("item", "row", "w", "own", "need", size_class(F.col("need")).alias("size_class"), F.slice("hashes", F.lit(1), F.col("k")).alias("sketch"))


def size_class(n: Column) -> Column:
    """The power of two of a number of shingles; 0 for none."""
    return F.when(n > 0, F.floor(F.log2(n.cast("double")))).otherwise(0).cast("int")


def contained(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY
) -> DataFrame:
    """(doc_id, item_id, found, size, containment) of all items in documents.

    ``found`` of the item's ``size`` distinct shingles are in the document.  Items
    of fewer than ``width`` words are one shingle of all their words.  Null and
    empty texts contain nothing and items without words are in nothing.  Rows
    that repeat an id are tried each and joined: the best containment counts; null
    ids are an id of their own.  Texts of any length are searched whole.  Other
    columns are ignored; either table may be empty.
    """
    best = F.max(F.struct((F.col("found") / F.col("size")).alias("containment"), "found", "size")).alias("best")
    out = _found(docs, items, id_col, text_col, item_col, item_text_col, width, similarity).groupBy("doc_id", "item").agg(best)
    return out.select("doc_id", F.col("item").alias("item_id"), "best.found", "best.size", "best.containment")


def _found(docs: DataFrame, items: DataFrame, id_col: str, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", width: int = WIDTH, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, doc_key, item, found, size) by row of either table."""
    known = cut(sketches(items, item_col, item_text_col, width, similarity))
    doc, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    base = docs.select(doc.alias("doc_id"), doc_key(doc, text).alias("doc_key"), text.alias("text"))
    widths = sorted(r["w"] for r in known.select("w").distinct().collect()) or [width]  # at most width numbers
    pairs = None
    for w in widths:
        some = _candidates(base, known.filter(F.col("w") == w), w)
        pairs = some if pairs is None else pairs.unionByName(some)
    pairs = cut(pairs.distinct())
    hit = pairs.select("doc_key").distinct()
    if small_enough(hit, BROADCAST_ROWS):  # else the join alone picks the texts
        base = base.join(F.broadcast(hit), "doc_key", "left_semi")
    pairs = base.join(pairs, "doc_key").join(known, "row")

    def read(own: Column) -> Column:
        out = F.lit(None).cast("array<string>")
        for w in widths:
            out = F.when(F.col("w") == w, shingles(own, w)).otherwise(out)
        return out

    # Made once a row, also where the filter below is pushed under this projection.
    both = F.size(F.array_intersect("own", let(words(F.col("text")), read)))
    tried = pairs.select("doc_id", "doc_key", "item", "need", F.size("own").alias("size"), both.alias("found"))
    return tried.filter(F.col("found") >= F.col("need")).select("doc_id", "doc_key", "item", "found", "size")


def _those_of(hits: Column, wanted: set[int]) -> Column:
    return F.filter(hits, lambda h: h.isin(sorted(wanted)))


def _candidates(base: DataFrame, known: DataFrame, width: int) -> DataFrame:
    """(doc_key, row) of documents that hold a sketched shingle of an item of ``width``."""
    keys = known.select(F.explode("sketch").alias("h"), "row", "need", "size_class")
    by_class: dict[int, set[int]] = {}
    if few := small_enough(keys, LITERAL_ROWS):
        for h, c in keys.select("h", "size_class").distinct().collect():  # at most LITERAL_ROWS pairs of numbers
            by_class.setdefault(c, set()).add(h)

    def searched(hits: Column) -> Column:
        held, wanted = (F.array().cast("array<bigint>") if few else hits), set()
        for c in sorted(by_class):
            wanted = wanted | by_class[c]
            held = F.when(size_class(F.size(hits)) >= c, _those_of(hits, wanted)).otherwise(held)
        return F.struct(F.size(hits).alias("n"), held.alias("hits"))

    found = let(F.array_distinct(shingle_hashes(words(F.col("text")), width)), searched)
    # The outer form, and a filter above it: a filter below would hash each text twice.
    hit = base.select("doc_key", found.alias("x")).select("doc_key", "x.n", F.explode_outer("x.hits").alias("h")).filter("h is not null")
    keys = keys.select("h", "row", "need")
    keys = F.broadcast(keys) if small_enough(keys, BROADCAST_ROWS) else keys
    return hit.join(keys, "h").filter(F.col("n") >= F.col("need")).select("doc_key", "row")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """``docs`` without the documents that contain an item; rows that share an id go
    together, of those without an id the rows of equal text.  Nulls, empty texts and
    tables are as in ``contained``; all columns stay."""
    key, text = PRIVATE + "key", F.col(f"`{options.get('text_col', 'text')}`")
    gone = _found(docs, items, id_col, **options).select(F.col("doc_key").alias(PRIVATE + "gone")).distinct()
    keyed = docs.withColumn(key, doc_key(F.col(f"`{id_col}`"), text))
    return keyed.join(gone, F.col(key) == F.col(PRIVATE + "gone"), "left_anti").drop(key)


def op6_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return contained(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda w: w <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda w: w <> '') AS words FROM benchmark),
items AS (SELECT item_id, words, least(len(words), 5)::INT AS w FROM b WHERE len(words) > 0),
grams AS (SELECT DISTINCT item_id, w, array_to_string(words[i:i + w - 1], ' ') AS s FROM (SELECT *, unnest(range(1, len(words) - w + 2)) AS i FROM items)),
sizes AS (SELECT item_id, count(*)::INT AS size FROM grams GROUP BY item_id),
dgrams AS (SELECT DISTINCT doc_id, w, array_to_string(words[i:i + w - 1], ' ') AS s
  FROM (SELECT doc_id, words, w, unnest(range(1, len(words) - w + 2)) AS i FROM d, (SELECT DISTINCT w FROM items) WHERE len(words) >= w)),
hits AS (SELECT doc_id, item_id, count(*)::INT AS found FROM dgrams JOIN grams USING (w, s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, found, size, found::DOUBLE / size AS containment FROM hits JOIN sizes USING (item_id)
WHERE found >= ceil(size * 0.8 - 1e-9)
"""
