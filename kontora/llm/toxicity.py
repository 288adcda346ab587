"""Toxicity categories predicted by a classifier chain.

Categories are predicted in order by logistic models on the words that a text
has.  Each model also gets the probabilities of the categories before it; in
training those are out-of-fold predictions, so a later model learns from
probabilities as wrong as it will meet.  The threshold of each category is the
one with the best F1 out of fold.

Models are fitted in one task on a bounded sample of labelled documents (``SAMPLE``
for each combination of labels); word sets are made where the texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kontora.llm.common import slices

#: Labelled rows of each combination of labels, words of a model, folds.
SAMPLE, WORDS, FOLDS = 1200, 2500, 5
#: Least chi-squared of a word, so that among 100,000 words few pass by chance.
LEAST_GAIN = 20.0
_PLAIN = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_STEP = 1 << 20


class Chain(NamedTuple):
    categories: list[str]
    words: dict[int, int]  # hash of a word -> row of weights
    weights: list[np.ndarray]  # words, then earlier probabilities, then bias
    thresholds: list[float]


def word_hashes(text: str | None) -> list[int]:
    """Signed 64-bit hashes of the distinct words of the whole text."""
    words = set((text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split())
    return [xxhash.xxh3_64_intdigest(w) - (1 << 63) for w in words]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def logistic(x: np.ndarray, y: np.ndarray, penalty: float = 3e-4, steps: int = 120) -> np.ndarray:
    """Weights with the bias last, by accelerated gradient steps."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    # Lipschitz bound of the mean loss: a quarter of the largest eigenvalue.
    v = np.ones(x.shape[1], np.float32)
    for _ in range(8):
        v = x.T @ (x @ v) / max(1, len(x))
        v /= np.sqrt(v @ v) + 1e-9
    top = float(np.sum((x @ v) ** 2) / max(1, len(x)))
    rate, w = 1 / (top / 4 + penalty), np.zeros(x.shape[1], np.float32)
    held = w
    for i in range(steps):
        ahead = w + (w - held) * (i / (i + 3))
        slope = x.T @ (_sigmoid(x @ ahead) - y).astype(np.float32) / max(1, len(x))
        held, w = w, (ahead - rate * (slope + penalty * ahead)).astype(np.float32)
    return w


def apply(w: np.ndarray, x: np.ndarray) -> np.ndarray:
    return _sigmoid(x @ w[:-1] + w[-1])


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    order = np.argsort(-p, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(p) + 1) + max(1, y.sum()))
    last = np.append(p[order][1:] != p[order][:-1], True)  # equal scores are cut together
    at = int(np.argmax(np.where(last, f1, -1)))
    here = p[order][at]
    below = p[order][at + 1] if at + 1 < len(p) else 0.0
    return float((here + below) / 2)


def select_words(sets: list[list[int]], labels: np.ndarray, most: int, least: int = 3) -> dict[int, int]:
    """The words whose presence moves the label rates most, by chi-squared, of
    those where this is no accident: others only teach a model its own sample."""
    known, index = np.unique(np.concatenate([np.array(s, np.int64) for s in sets] or [np.zeros(0, np.int64)]), return_inverse=True)
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    df = np.bincount(index, minlength=len(known)).astype(float)
    gain = np.zeros(len(known))
    for y in labels.T if len(labels) else ():
        rate = y.mean()
        if 0 < rate < 1:
            hits = np.bincount(index, weights=y[row], minlength=len(known))
            gain = np.maximum(gain, (hits - df * rate) ** 2 / (df * rate * (1 - rate) + 1e-9))
    gain[(df < least) | (gain < LEAST_GAIN)] = -1
    top = np.argsort(-gain, kind="stable")[:most]
    return {int(known[i]): k for k, i in enumerate(t for t in top if gain[t] >= 0)}


def matrix(sets: list[list[int]], words: dict[int, int]) -> np.ndarray:
    x = np.zeros((len(sets), len(words)), np.float32)
    for i, s in enumerate(sets):
        x[i, [words[h] for h in s if h in words]] = 1
    return x


def fit(ids: list[str], sets: list[list[int]], labels: np.ndarray, categories: list[str]) -> Chain:
    """Fit the chain; folds follow the ids, so equal inputs give equal models.

    Nothing of a fold's labels reaches its own predictions: the words of a model
    are selected without the fold it predicts.
    """
    fold = np.array([xxhash.xxh3_64_intdigest(i.encode()) % FOLDS for i in ids], int)
    own_words = [select_words([s for s, f in zip(sets, fold, strict=True) if f != k], labels[fold != k], WORDS) for k in range(FOLDS)]
    words = select_words(sets, labels, WORDS)
    x, before = matrix(sets, words), np.zeros((len(sets), 0), np.float32)
    weights, thresholds = [], []
    for k in range(len(categories)):
        y = labels[:, k].astype(np.float32)
        out = np.zeros(len(y), np.float32)
        for f in range(FOLDS):
            if (fold == f).any():
                part, rest = np.hstack([matrix(sets, own_words[f]), before]), fold != f
                out[~rest] = apply(logistic(part[rest], y[rest]), part[~rest])
        weights.append(logistic(np.hstack([x, before]), y))
        thresholds.append(best_threshold(out, y) if len(y) else 0.5)
        before = np.hstack([before, out[:, None]])
    return Chain(categories, words, weights, thresholds)


def predict(chain: Chain, x: np.ndarray) -> np.ndarray:
    for w in chain.weights:
        x = np.hstack([x, apply(w, x)[:, None]])
    return x[:, len(chain.words) :]


def _fitted(categories: list[str]):
    names = [f"y{k}" for k in range(len(categories))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        y = np.array([r[2:] for r in rows], np.float32).reshape(len(rows), len(names))
        c = fit([r[0] for r in rows], [r[1] for r in rows], y, categories)
        words = sorted(c.words, key=c.words.get)
        arrays = [pa.array([words], pa.list_(pa.int64())), pa.array([[w.astype("<f4").tobytes() for w in c.weights]], pa.list_(pa.binary())), pa.array([c.thresholds], pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(arrays, ["words", "weights", "thresholds"])

    return run


def train(docs: DataFrame, labels: DataFrame, categories: dict[str, str], id_col: str = "doc_id", text_col: str = "text", sample: int = SAMPLE) -> Chain:
    """Fit on labelled documents.  ``categories`` maps names to SQL over ``labels``.

    Labels that repeat an id are one, with the highest value of each category;
    those with a null and those of ids without a document teach nothing.  Rows
    that repeat an id in ``docs`` are a text each.  Null and empty texts have no
    words.  Rows are drawn by a hash of the id, at most ``sample`` for each
    combination of labels; of rows beyond that those of least hash count.  The
    models are fitted in one task; the driver gets weights.  With nothing to
    learn from they are 0.
    """
    own = [F.expr(sql).cast("int").alias(f"y{k}") for k, sql in enumerate(categories.values())]
    names = [f"y{k}" for k in range(len(categories))]
    marked = labels.select(F.col(f"`{id_col}`").alias("i"), *own).dropna().groupBy("i").agg(*(F.max(c).alias(c) for c in names))
    counts = marked.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()  # combinations of labels
    place = F.xxhash64(F.col("i").cast("string"), F.lit("toxicity"))
    rule = F.lit(False)
    for r in counts:
        same = F.lit(True)
        for c in names:
            same = same & (F.col(c) == r[c])
        rule = rule | (same & (F.pmod(place, F.lit(_STEP)) < int(_STEP * min(1.0, sample / r["n"]))))
    picked = marked.filter(rule)  # about sample rows a combination: small enough to broadcast
    texts = docs.select(F.col(f"`{id_col}`").alias("i"), F.col(f"`{text_col}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            words = [word_hashes(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(words, pa.list_(pa.int64())), *batch.columns[3:]], ["place", "i", "w", *names])

    joined = texts.join(F.broadcast(picked), "i").select(place.alias("place"), F.col("i").cast("string"), "t", *names)
    rows = joined.mapInArrow(run, "place bigint, i string, w array<bigint>, " + ", ".join(f"{c} int" for c in names)).orderBy("place").limit(sample * max(1, len(counts)))
    found = rows.drop("place").mapInArrow(_fitted(list(categories)), "words array<bigint>, weights array<binary>, thresholds array<double>").collect()
    if not found:
        return fit([], [], np.zeros((0, len(names)), np.float32), list(categories))
    words, weights, thresholds = found[0]
    return Chain(list(categories), {h: k for k, h in enumerate(words)}, [np.frombuffer(bytes(w), "<f4") for w in weights], list(thresholds))


def classify(docs: DataFrame, chain: Chain, text_col: str = "text") -> DataFrame:
    """``docs`` with ``p_<category>`` and the boolean ``<category>`` of each.

    These replace input columns of the same name; other columns stay.  Null and
    empty texts, and others without a word the models know, get the models' bias
    alone and are never flagged; with nothing to learn from that is every text.
    Whole texts count, of any length.  Repeated rows are judged each; an empty table
    gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(chain)
    names = chain.categories
    made = [*(f"p_{c}" for c in names), *names]
    base = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c not in made))
    place = base.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = held.value
        for batch in slices(batches):
            x = matrix([word_hashes(t) for t in batch.column(place).to_pylist()], c.words)
            p, known = predict(c, x), x.any(axis=1)
            flags = [pa.array((p[:, k] > t) & known) for k, t in enumerate(c.thresholds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array(p[:, k].astype(float)) for k in range(len(names))), *flags], [*batch.schema.names, *made])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in base.schema.fields]
    return base.mapInArrow(run, ", ".join([*kinds, *(f"`p_{c}` double" for c in names), *(f"`{c}` boolean" for c in names)]))


#: Low quality first: its probability informs the toxicity model.
CATEGORIES = {"low_quality": "1 - quality", "toxic": "toxic"}


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    chain = train(docs, labels, CATEGORIES)
    return classify(docs, chain).drop("text")
