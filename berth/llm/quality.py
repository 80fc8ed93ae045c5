"""Quality by a support vector machine over naive Bayes features.

A text's indicators say which n-grams it has: words, pairs of words, shapes of words (what kinds
of characters follow one another) and pairs of shapes, hashed to BUCKETS places. Each place is
scaled by its log-count ratio, taken over all labelled texts; a linear hinge-loss model on the
scaled indicators is fitted by dual coordinate descent on a bounded sample of them, and drawn
towards its mean weight. A logistic curve on sampled texts that were not fitted gives the score.

Bounds, all independent of the corpus: BUCKETS counts per class come to the driver, and the model
is fitted there on at most SAMPLE + 2 * LEAST texts (each at most BUCKETS places). Counts cover all labelled
texts outside the held-out fold.

Defined results: a null or empty text has no indicators and gets the score of the bias alone; a
null doc_id is scored and never learned from; several labels of one id count as 1 if one of them
does; repeated rows are scored as often as they stand there; without labels of both kinds all
texts get the score 1, so that nothing is thrown away unheard. Other columns are ignored by
``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm.common import (
    bounded,
    fit_logistic,
    fold,
    labels_of,
    logistic,
    record_batch,
    sole,
    stored,
    texts,
)

FOLDS, HELD_OUT = 3, 1
BUCKETS = 1 << 18
SAMPLE = 6_000
#: Texts of each class that are fitted at least, if there are so many.
LEAST = 200
#: One sampled text in so many fits the curve only.
CURVE_FOLDS = 5
SMOOTH = 1.0
COST = 0.1
#: How far each weight keeps to itself; the rest is the mean weight.
OWN_WEIGHT = 0.75
EPOCHS = 30
#: Words that a Python worker remembers in each generation.
MEMO = 100_000

SCORES = "doc_id long, held_out boolean, score double, predicted int"
_SCORE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)
_KINDS = [(re.compile(r"[^\W\d_]+"), None), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1\1")]
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """Kinds of characters: lower case a, capitals A, one capital first B, mixed M, digits 0,
    other signs as they are, twice if repeated."""

    def letters(m: re.Match) -> str:
        part = m.group()
        if part.islower():
            return "a"
        if part.isupper():
            return "A" if len(part) > 1 else "B"
        return "B" if part[1:].islower() else "M"

    found = _KINDS[0][0].sub(letters, word)
    found = _KINDS[1][0].sub("0", found)
    return _KINDS[2][0].sub(r"\1\1", found)[:12]


class Hashes(dict):
    """Word -> hash of its lower-case letters and digits, and behind it hash of its shape."""

    def __init__(self) -> None:
        self.older: dict[str, int] = {}

    def __missing__(self, word: str) -> int:
        found = self.older.get(word)
        if found is None:
            bare = "".join(c for c in word.lower() if c.isalnum())
            found = xxhash.xxh32_intdigest(bare) << 32 | xxhash.xxh32_intdigest(shape(word))
        if len(word) < 64:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found


def indicators(text: str) -> np.ndarray:
    """Sorted places that a whole text fills."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64)
    both = np.fromiter(map(sole("quality", Hashes).__getitem__, words), np.uint64, len(words))
    word, form = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    parts = [word * np.uint64(4), form * np.uint64(4) + np.uint64(1)]
    for kind, one in ((2, word), (3, form)):
        pair = (one[:-1] * np.uint64(0xD6E8FEB86659FD93)) ^ one[1:]
        parts.append(pair * np.uint64(4) + np.uint64(kind))
    keys = np.concatenate(parts) * _MIX
    filled = np.zeros(BUCKETS, dtype=bool)
    filled[(keys >> np.uint64(46)).astype(np.int64)] = True
    return np.flatnonzero(filled)


def place_counts(labelled: DataFrame) -> DataFrame:
    """(place, bad, good): in how many texts of either label each place is filled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("place", pa.int64()), ("bad", pa.int64()), ("good", pa.int64())])
        found = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            for text, y in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found[y][indicators(text)] += 1
        places = np.flatnonzero(found.any(axis=0))
        yield record_batch(schema, [pa.array(places), *(pa.array(f[places]) for f in found)])

    return (
        labelled.select("text", "y")
        .mapInArrow(count, "place long, bad long, good long")
        .groupBy("place")
        .agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    )


def log_ratios(counts: np.ndarray, smooth: float = SMOOTH) -> np.ndarray:
    """Log-count ratio of each place from (bad, good) counts; 0 where nothing was counted."""
    p, q = counts[1] + smooth, counts[0] + smooth
    ratios = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(counts.any(axis=0), ratios, 0.0)


def descend(
    rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """Weights and bias of min |w|^2 / 2 + C sum max(0, 1 - y (w x + b)), by dual coordinate
    descent; the bias is one more feature. ``y`` is -1 or 1; the classes weigh alike."""
    weight, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    upper = np.where(y > 0, len(y) / (2 * max((y > 0).sum(), 1)), len(y) / (2 * max((y < 0).sum(), 1))) * cost
    draw = np.random.default_rng(7)
    for _ in range(epochs):
        change = 0.0
        for i in draw.permutation(len(rows)):
            r, v = rows[i], values[i]
            gradient = y[i] * (weight[r] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            step = (new - alpha[i]) * y[i]
            if step:
                weight[r] += step * v
                bias += step
                change = max(change, abs(step))
                alpha[i] = new
        if change < 1e-4:
            break
    return weight, bias


@dataclass
class Model:
    weight: np.ndarray  # of an unscaled indicator
    bias: float
    curve: tuple[float, ...] = (1.0, 0.0)
    known: bool = True

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        return np.array([self.weight[r].sum() + self.bias for r in rows])


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Learn from the labelled rows of ``docs`` outside the held-out fold."""
    known = labels_of(labels, "quality").where(fold("doc_id", folds) != held_out)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = stored(place_counts(given.join(bounded(known), "doc_id")), "places").toArrow()
    counts = np.zeros((2, BUCKETS), dtype=np.int64)
    for k, name in enumerate(("bad", "good")):
        counts[k][counted.column("place").to_numpy()] = counted.column(name).to_numpy()
    ratios = log_ratios(counts)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("y", pa.int32()), ("curve", pa.bool_()), ("at", pa.list_(pa.int32()))])
        for batch in batches:
            found = [indicators(t) for t in texts(batch.column(2))]
            yield record_batch(schema, [batch.column(0), batch.column(1), found])

    # At most SAMPLE ids, drawn by a hash of the id, and the first LEAST ids of each class where
    # these are not among them.
    order = (F.xxhash64("doc_id"), "doc_id")
    drawn = known.orderBy(*order).limit(SAMPLE)
    for y in (0, 1):
        drawn = drawn.union(known.where(F.col("y") == y).orderBy(*order).limit(LEAST))
    drawn = drawn.distinct()
    drawn = drawn.withColumn("curve", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(CURVE_FOLDS)) == 0)
    sample = (
        given.join(F.broadcast(drawn), "doc_id")
        .select("y", "curve", "text")
        .mapInArrow(features, "y int, curve boolean, at array<int>")
        .limit(2 * (SAMPLE + 2 * LEAST))
        .toArrow()
    )
    y = sample.column("y").to_numpy() * 2 - 1
    curve = sample.column("curve").to_numpy(zero_copy_only=False)
    rows = [r.values.to_numpy() for r in sample.column("at")]
    if len(set(y.tolist())) < 2:
        return Model(np.zeros(BUCKETS), 0.0, known=False)
    fitted = ~curve if len(set(y[~curve].tolist())) == 2 else np.ones(len(y), dtype=bool)
    weight, bias = descend([r for r, c in zip(rows, fitted, strict=True) if c], y[fitted], ratios)
    used = weight != 0
    mean = np.abs(weight[used]).mean() if used.any() else 0.0
    blended = OWN_WEIGHT * weight + (1 - OWN_WEIGHT) * mean * used
    model = Model(blended * ratios, bias)
    at = curve if len(set(y[curve].tolist())) == 2 else fitted
    margins = model.margins([r for r, c in zip(rows, at, strict=True) if c])
    x = np.stack([margins, np.ones(len(margins))], axis=1)
    good = (y[at] + 1) // 2
    model.curve = tuple(fit_logistic(x, good, good.mean()))
    return model


def _scorer(model: Model, docs: DataFrame):
    """A function from a column of texts to their scores, for use in tasks."""
    if not model.known:
        return lambda column: np.ones(len(column))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(column: pa.Array) -> np.ndarray:
        own = shared.value
        margins = own.margins([indicators(t) for t in texts(column)])
        return logistic(margins * own.curve[0] + own.curve[1])

    return score


def score(docs: DataFrame, model: Model, folds: int = FOLDS, held_out: int = HELD_OUT) -> DataFrame:
    """(doc_id, held_out, score, predicted) of each whole text."""
    scores = _scorer(model, docs)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scores(batch.column(2))
            yield record_batch(
                _SCORE_SCHEMA, [batch.column(0), batch.column(1), found, (found >= 0.5).astype("int32")]
            )

    held = F.coalesce(fold("doc_id", folds) == held_out, F.lit(False))
    return docs.select(F.col("doc_id").cast("long"), held.alias("held_out"), "text").mapInArrow(
        rate, SCORES
    )


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is predicted good."""
    scores = _scorer(model, docs)
    at = docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.greater_equal(pa.array(scores(batch.column(at))), 0.5))

    return docs.mapInArrow(sift, docs.schema)
