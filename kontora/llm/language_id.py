"""Language identification with error-correcting output codes.

Each language has a codeword; one binary classifier per bit, a logistic model on
hashed byte trigrams of the whole text, predicts that bit.  Decoding is weighted
by loss: the distance to a codeword sums each bit's logistic loss times how well
that bit was learned for the language.  The nearest codeword wins; a small
margin to the second flags the text as ambiguous.

Models are fitted on a bounded sample: of at most ``SAMPLE // LEAST`` languages,
the most frequent, ``SAMPLE`` rows in all.  The sample's trigram counts are made
where the rows are and the model is fitted in one task; the driver gets weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import slices

#: Rows a model is fitted on at most, rows of a language at least (as far as it
#: has so many), numbers per row, least margin.
SAMPLE, LEAST, FEATURES, MARGIN = 2400, 20, 1 << 13, 0.05
UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]")
_PLAIN = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))
_STEP = 1 << 20


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # languages x bits, -1 or 1
    reliance: np.ndarray  # languages x bits, rows sum to 1
    weights: np.ndarray  # FEATURES + 1 x bits


def has_letter(text: str | None) -> bool:
    """A character of Unicode category L; digits of other kinds, as in x², are none."""
    return any(m[0].isalpha() for m in _WORD.finditer(text or ""))


def features(text: str) -> np.ndarray:
    """Unit vector of hashed byte trigrams; what isn't a letter is a space."""
    raw = (" " + text.lower() + " ").encode("utf-8", "replace").translate(_PLAIN)
    out = np.zeros(FEATURES, np.float64)
    for at in range(0, len(raw), 1 << 20):
        a = np.frombuffer(raw, np.uint8, min(len(raw) - at, (1 << 20) + 2), at).astype(np.uint32)
        if len(a) > 2:
            h = (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA77) + a[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
            out += np.bincount(h >> np.uint32(19), minlength=FEATURES)
    norm = np.sqrt(out @ out)
    return (out / norm if norm else out).astype(np.float32)


def codewords(n: int) -> np.ndarray:
    """One row per language: all splits for up to 7 languages, else random ones
    with the best least distance of a few draws."""
    if n <= 1:
        return np.ones((n, 1))
    if n <= 7:
        splits = [c for k in range(1, n) for c in combinations(range(n), k) if 0 in c]
        return np.array([[1.0 if i in c else -1.0 for c in splits] for i in range(n)])
    bits, best = int(np.ceil(10 * np.log2(n))), None
    for seed in range(50):
        c = np.random.default_rng(seed).choice([-1.0, 1.0], (n, bits))
        least = min(np.sum(c[i] != c[j]) for i, j in combinations(range(n), 2))
        if (abs(c.sum(axis=0)) < n).all() and (best is None or least > best[0]):
            best = (least, c)
    return best[1]


def fit(x: np.ndarray, languages: list[str], steps: int = 150) -> Model:
    """Fit on rows of ``features`` (32-bit) and their languages."""
    names = sorted(set(languages))
    codes = codewords(len(names))
    if len(names) < 2:
        return Model(names, codes, np.ones((len(names), 1)), np.zeros((FEATURES + 1, 1), np.float32))
    own = np.array([names.index(y) for y in languages])
    target = codes[own].astype(np.float32)
    share = 1 / np.bincount(own, minlength=len(names))[own][:, None]
    pull = (target * (share / share.sum())).astype(np.float32)
    w = np.zeros((FEATURES + 1, codes.shape[1]), np.float32)
    held, rate, decay = w, np.float32(4.0), np.float32(4e-5)
    for i in range(steps):
        ahead = w + (w - held) * np.float32(i / (i + 3))
        force = pull / (1 + np.exp(np.clip(target * (x @ ahead[:-1] + ahead[-1]), -30, 30)))
        held, w = w, (1 - decay) * ahead
        w[:-1] += rate * (x.T @ force)
        w[-1] += rate * force.sum(axis=0)
    right = (np.sign(x @ w[:-1] + w[-1]) == target).astype(float)
    rely = np.array([right[own == k].mean(axis=0) for k in range(len(names))]) + 1e-6
    return Model(names, codes, rely / rely.sum(axis=1, keepdims=True), w)


def decode(model: Model, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the language, its share of exp(-distance), and if it is ambiguous."""
    f = (x @ model.weights[:-1] + model.weights[-1]).astype(float)
    losses = np.log1p(np.exp(-np.clip(f[:, None, :] * model.codes, -30, 30)))
    away = (losses * model.reliance).sum(axis=2)
    p = np.exp(-4 * (away - away.min(axis=1, keepdims=True)))
    p /= p.sum(axis=1, keepdims=True)
    order = np.sort(p, axis=1)
    second = order[:, -2] if p.shape[1] > 1 else np.zeros(len(p))
    return p.argmax(axis=1), order[:, -1], order[:, -1] - second < MARGIN


def held_out(id_col: Column) -> Column:
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == 2


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (place, y, t) as (place, y, at, x): the numbers that aren't 0, and where."""
    for batch in slices(batches):
        place, lang, at, x = [], [], [], []
        for p, y, t in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if has_letter(t):
                own = features(t)
                some = np.flatnonzero(own)
                place.append(p)
                lang.append(y)
                at.append(some.astype("<u2").tobytes())
                x.append(own[some].astype("<f2").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(place, pa.int64()), pa.array(lang, pa.string()), pa.array(at, pa.binary()), pa.array(x, pa.binary())], ["place", "y", "at", "x"])


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The model of all rows of (y, at, x), at most ``SAMPLE``."""
    rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    if rows:
        x = np.zeros((len(rows), FEATURES), np.float32)
        for own, (_, at, values) in zip(x, rows, strict=True):
            own[np.frombuffer(at, "<u2")] = np.frombuffer(values, "<f2")
        m = fit(x, [r[0] for r in rows])
        arrays = [pa.array([m.languages], pa.list_(pa.string())), *(pa.array([np.asarray(a, "<f4").tobytes()], pa.binary()) for a in m[1:])]
        yield pa.RecordBatch.from_arrays(arrays, ["languages", "codes", "reliance", "weights"])


def train(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE) -> Model:
    """Fit on a sample of the labelled rows that are not held out.

    Rows without a language or a letter teach nothing; a null id is never held
    out.  Rows are drawn by a hash of id and text, so repeated rows are drawn
    together; of equal rows some may be cut off at ``sample``.  Texts with
    several languages count for each.  Whole texts are read.  Without a row to
    learn from, the model knows no language.
    """
    base = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{lang_col}`").cast("string").alias("y"), F.col(f"`{text_col}`").alias("t"))
    base = base.filter(F.col("y").isNotNull() & ~F.coalesce(held_out(F.col("i")), F.lit(False)))
    sizes = base.groupBy("y").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "y").limit(max(1, sample // LEAST))
    counts = {r["y"]: r["n"] for r in sizes.collect()}  # at most sample / LEAST rows
    if not counts:
        return fit(np.zeros((0, FEATURES), np.float32), [])
    each = sample // len(counts)
    limits = F.create_map(*(F.lit(x) for y, n in counts.items() for x in (y, int(_STEP * min(1.0, each / n)))))
    place = F.xxhash64(F.col("i").cast("string"), "t", F.lit("language"))
    drawn = base.filter(F.pmod(place, F.lit(_STEP)) < F.try_element_at(limits, F.col("y"))).select(place.alias("place"), "y", "t")
    rows = drawn.mapInArrow(_featured, "place bigint, y string, at binary, x binary").orderBy("place", "y").limit(sample)
    fitted = rows.select("y", "at", "x").mapInArrow(_fitted, "languages array<string>, codes binary, reliance binary, weights binary").collect()
    if not fitted:
        return fit(np.zeros((0, FEATURES), np.float32), [])
    names = list(fitted[0]["languages"])
    codes, rely, weights = (np.frombuffer(bytes(b), "<f4") for b in fitted[0][1:])
    bits = len(codes) // len(names)
    return Model(names, codes.reshape(-1, bits).astype(float), rely.reshape(-1, bits).astype(float), weights.reshape(-1, bits))


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1) and ``ambiguous``.

    These replace input columns of the same name; other columns stay.  A text
    that is null or has no letter is ``und`` with score 0, as is every text when
    nothing could be learned.  Of codewords at the same distance the language that
    sorts first is taken, and the text is ambiguous.  Whole texts count, of any
    length.  Repeated rows are judged each; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)
    made = ("lang_pred", "score", "ambiguous")
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in made))
    place = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in slices(batches, 256):
            texts = batch.column(place).to_pylist()
            lang, score, doubt = [UNKNOWN] * len(texts), [0.0] * len(texts), [False] * len(texts)
            some = [i for i, t in enumerate(texts) if has_letter(t)] if m.languages else []
            if some:
                for i, k, s, d in zip(some, *decode(m, np.stack([features(texts[i]) for i in some])), strict=True):
                    lang[i], score[i], doubt[i] = m.languages[k], float(s), bool(d)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang), pa.array(score, pa.float64()), pa.array(doubt, pa.bool_())], [*batch.schema.names, *made])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{kinds}, lang_pred string, score double, ambiguous boolean")


def op5_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, "doc_id", "text", "lang")
    out = identify(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "ambiguous")
