"""Toxicity by class-conditional Kneser-Ney models.

Two models, of toxic and of ordinary texts, predict each character of an expression (a word
between non-word characters, with marks for its ends) from the characters before it. Their
upper orders are counted per class, by texts; the lower orders are continuation counts of both
classes together, so that rare expressions fall back on the same shared estimate and tell
little. The counts of all labelled texts but those drawn for the curve are gathered by a shuffle,
first per word, then per n-gram.

A text is compared passage by passage: the difference of the two log-likelihoods of a passage
is divided by its length. What is scored is the most toxic expression, the most toxic passage
of PASSAGE expressions and the whole text; a logistic curve through these three, fitted on a
bounded sample of labelled texts, gives the score. Only this sample, at most SAMPLE texts of each
class, is left out of the counts.

The models grow with the counted texts: every n-gram and context that changes an estimate is kept.
They are sorted by Spark and streamed into files that Spark brings to every node; workers map these
files and read the places they look up. Only the curve has a bound: at most SAMPLE texts of each
class.

Defined results: a null or empty text, and one without words, has the score of a text about
which nothing is known; a null doc_id is scored and never learned from; several labels of one
id count as toxic if one of them does; repeated rows are scored as often as they stand there;
without labels of both kinds all texts get the score 0. Other columns are ignored by ``score``
and kept by ``keep_ordinary``.
"""

from __future__ import annotations

import os
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
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
    words_of,
)

FOLDS, HELD_OUT = 5, 0
ORDER, SHARED = 6, 3
DISCOUNT = 0.75
PASSAGE = 4
#: What an n-gram that the models do not know gives to either class, and what it leaves as a context.
NOTHING = (0.0, 0.0, 1.0, 1.0)
#: Longer expressions are cut into pieces of so many characters.
LONGEST = 40
#: N-grams in a row of bytes on their way to the driver's file.
FILE_ROWS = 100_000
SAMPLE = 2_000
#: One labelled text in so many, but no more than SAMPLE of a class, is left out of the counts
#: and serves the curve.
CURVE_SHARE = 6
#: Expressions that a Python worker remembers in each generation.
MEMO = 100_000

SCORES = "doc_id long, held_out boolean, score double, predicted int"
_SCORE_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def pieces_of(words: list[bytes]) -> tuple[list[str], list[int]]:
    """Pieces of at most LONGEST characters of all words one behind another, and for each piece
    the number of its word."""
    pieces, rows = [], []
    for k, word in enumerate(words):
        text = word.decode()
        if len(text) <= LONGEST:
            pieces.append(text)
            rows.append(k)
        else:
            own = [text[i : i + LONGEST] for i in range(0, len(text), LONGEST)]
            pieces += own
            rows += [k] * len(own)
    return pieces, rows


def grams(pieces: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """The characters of all pieces one behind another, each piece between two end marks: for
    n = 0 ... order, a hash of the n characters that end at each place (0 where the piece is
    shorter); each place's distance from its piece's start; and the length of each piece.

    The characters are mixed so that 64 bits tell all n-grams apart."""
    joined = "\n" + "\n\n".join(pieces) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
    lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces)) + 2
    depth = np.arange(len(codes)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    mixed = (codes + np.uint64(1)) * _MIX
    mixed ^= mixed >> np.uint64(29)
    found = [np.full(len(codes), 7, dtype=np.uint64)]
    for n in range(1, order + 1):
        before = np.roll(found[-1], 1)
        value = (before * np.uint64(0xD6E8FEB86659FD93) ^ mixed) * _MIX + np.uint64(n)
        value ^= value >> np.uint64(31)
        value[depth < n - 1] = 0
        found.append(value)
    return found, depth, lengths


def word_counts(labelled: DataFrame) -> DataFrame:
    """(word, ordinary, toxic): in how many texts of either label each expression stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.binary()), ("ordinary", pa.int64()), ("toxic", pa.int64())])
        found = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            keys = list(found[0].keys() | found[1].keys())
            columns = [keys, *([c[k] for k in keys] for c in found)]
            for c in found:
                c.clear()
            return record_batch(schema, columns)

        for batch in batches:
            for text, y in zip(texts(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                found[y].update(set(words_of(text)))
                if len(found[0]) + len(found[1]) > 200_000:
                    yield flush()
        yield flush()

    return (
        labelled.select("text", "y")
        .mapInArrow(count, "word binary, ordinary long, toxic long")
        .groupBy("word")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    )


def gram_counts(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Upper orders: (n, context, gram, ordinary, toxic), counted per class. Lower orders:
    (n, context, gram, types): in how many different places of one character more it stands."""
    schema = pa.schema(
        [("n", pa.int32()), ("context", pa.int64()), ("gram", pa.int64()), ("longer", pa.int64()),
         ("ordinary", pa.int64()), ("toxic", pa.int64())]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pieces, rows = pieces_of(batch.column(0).to_pylist())
            if not pieces:
                continue
            hashes, depth, lengths = grams(pieces, ORDER)
            row = np.repeat(np.array(rows), lengths)
            counts = [batch.column(c).to_numpy()[row] for c in (1, 2)]
            place = np.arange(len(depth))
            for n in range(1, ORDER + 1):
                # The first mark of a word is given, not predicted.
                here = place[(depth >= max(n - 1, 1))]
                longer = hashes[n + 1][here] if n <= SHARED else np.zeros(len(here), np.uint64)
                # The longest of the three says what the others are.
                whole = np.where(longer != 0, longer, hashes[n][here])
                _, first, at = np.unique(whole, return_index=True, return_inverse=True)
                keys = [hashes[n - 1][here - 1], hashes[n][here], longer]
                sums = [np.bincount(at, c[here], len(first)).astype(np.int64) for c in counts]
                yield record_batch(
                    schema,
                    [
                        pa.array(np.full(len(first), n), pa.int32()),
                        *(pa.array(k[first].view(np.int64)) for k in keys),
                        *map(pa.array, sums),
                    ],
                )

    rows = words.mapInArrow(
        count, "n int, context long, gram long, longer long, ordinary long, toxic long"
    )
    summed = (
        rows.groupBy("n", "context", "gram", "longer")
        .agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    )
    summed = stored(summed, "grams")
    upper = summed.where(F.col("n") > SHARED).drop("longer")
    lower = (
        summed.where(F.col("n") <= SHARED)
        .groupBy("n", "context", "gram")
        .agg(F.count(F.lit(1)).alias("types"))
    )
    return upper, lower


class Table:
    """Sorted hashes with four values each, in files that Spark brings to every node. They are mapped
    where they are used, so that the workers of a node share what they read of them."""

    def __init__(self, stem: str, rows: int):
        self.stem, self.rows, self.mapped = stem, rows, None

    def __getstate__(self) -> tuple[str, int]:
        return self.stem, self.rows

    def __setstate__(self, state: tuple[str, int]) -> None:
        self.__init__(*state)

    def _open(self) -> tuple[np.ndarray, np.ndarray]:
        if self.mapped is None:
            self.mapped = tuple(
                np.asarray(np.memmap(SparkFiles.get(f"{self.stem}.{part}"), kind, "r", shape=shape))
                for part, kind, shape in (("keys", "<i8", self.rows), ("values", "<f8", (self.rows, 4)))
            )
        return self.mapped

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values of each key; NOTHING for those that are not in the table. Every key is looked
        up once, and in the table's order: places close by are then still in the processor's cache."""
        unique, back = np.unique(keys, return_inverse=True)
        found = np.tile(NOTHING, (len(unique), 1))
        if self.rows:
            table, values = self._open()
            at = np.minimum(np.searchsorted(table, unique), self.rows - 1)
            hit = table[at] == unique
            found[hit] = values[at[hit]]
        return found[back]


def filed(df: DataFrame) -> Table:
    """The rows (key and four values) as a Table. The driver holds one sorted partition at a time."""
    context = df.sparkSession.sparkContext
    schema = pa.schema([("keys", pa.binary()), ("p", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, FILE_ROWS):
                keys, *p = (c.to_numpy() for c in batch.slice(k, FILE_ROWS).columns)
                blobs = keys.astype("<i8").tobytes(), np.stack(p, axis=1).astype("<f8").tobytes()
                yield record_batch(schema, [[blob] for blob in blobs])

    stem, size = f"toxicity-{uuid.uuid4().hex}", 0
    # The folder of Spark's files on the driver goes when the session ends.
    paths = [os.path.join(SparkFiles.getRootDirectory(), f"{stem}.{part}") for part in ("keys", "values")]
    packed = df.orderBy("key").mapInArrow(pack, "keys binary, p binary")
    with open(paths[0], "wb") as keys, open(paths[1], "wb") as values:
        for row in packed.toLocalIterator():
            size += keys.write(row[0])
            values.write(row[1])
    if size:
        for path in paths:
            context.addFile(path)
    return Table(stem, size // 8)


@dataclass
class Model:
    """Hashes of n-grams with what they contribute to either class."""

    #: Of each n-gram, its discounted share of its context, per class, and what it leaves to the
    #: next lower order where it is itself the context, per class.
    gram: Table
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    known: bool = True

    def deltas(self, words: list[bytes]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each expression."""
        pieces, rows = pieces_of(words)
        hashes, depth, lengths = grams(pieces, ORDER)
        p = np.full((len(depth), 2), 1e-6)
        here = np.flatnonzero(depth > 0)
        backoff = np.repeat(self.gram.find(hashes[0][:1].view(np.int64))[:, 2:], len(here), axis=0)
        slot = np.zeros(len(depth), dtype=np.int64)
        for n in range(1, ORDER + 1):
            # A context of an upper order is kept only if the next shorter one is, where that is of
            # an upper order too; a share only if its context is.
            seen = (backoff[:, 0] < 1) | (backoff[:, 1] < 1)
            here, backoff = here[seen], backoff[seen]
            longer = np.flatnonzero(depth >= n) if n <= SHARED else here[depth[here] >= n]
            # The n characters are predicted here, and one place further they are the context.
            asked = np.zeros(len(depth), dtype=bool)
            asked[here] = True
            if n < ORDER:
                asked[longer - 1] = True
            places = np.flatnonzero(asked)
            slot[places] = np.arange(len(places))
            found = self.gram.find(hashes[n][places].view(np.int64))
            p[here] = np.maximum(backoff * p[here] + found[slot[here], :2], 1e-12)
            if n < ORDER:
                here, backoff = longer, found[slot[longer - 1], 2:]
        steps = np.where(depth > 0, np.log(p[:, 1] / p[:, 0]), 0.0)
        return np.bincount(np.repeat(np.array(rows), lengths), steps, len(words))


def fit_counts(words: DataFrame) -> Model:
    """The two models from counts of words. What changes no estimate is left out: n-grams without
    a share of their context, and contexts that leave everything to the lower order."""
    upper, lower = gram_counts(words)
    d = DISCOUNT

    def taken(value: str) -> F.Column:
        """What an n-gram gives to its backoff: all of a single count, else the discount."""
        return F.when(F.col(value) > 1, d).otherwise(F.col(value))

    def part(value: str, total: str) -> F.Column:
        return F.when(F.col(total) > 0, (F.col(value) - taken(value)) / F.col(total)).otherwise(0.0)

    def left(total: str, given: str) -> F.Column:
        return F.when(F.col(total) > 0, F.col(given) / F.col(total)).otherwise(1.0)

    contexts = upper.groupBy("n", "context").agg(
        F.sum("ordinary").alias("all0"), F.sum("toxic").alias("all1"),
        F.sum(taken("ordinary")).alias("given0"), F.sum(taken("toxic")).alias("given1"),
    )
    low_contexts = lower.groupBy("n", "context").agg(
        F.sum("types").alias("all0"), F.sum(taken("types")).alias("given0")
    )
    shares = upper.join(contexts, ["n", "context"]).select(
        F.col("gram").alias("key"), part("ordinary", "all0").alias("p0"), part("toxic", "all1").alias("p1")
    )
    low_shares = lower.join(low_contexts, ["n", "context"]).select(
        F.col("gram").alias("key"), part("types", "all0").alias("p0"), part("types", "all0").alias("p1")
    )
    backoffs = contexts.select(
        F.col("context").alias("key"), left("all0", "given0").alias("b0"), left("all1", "given1").alias("b1")
    )
    low_backoffs = low_contexts.select(
        F.col("context").alias("key"), left("all0", "given0").alias("b0"), left("all0", "given0").alias("b1")
    )
    both = (
        shares.unionByName(low_shares).where("p0 > 0 OR p1 > 0")
        .unionByName(backoffs.unionByName(low_backoffs).where("b0 < 1 OR b1 < 1"), allowMissingColumns=True)
    )
    # A key has at most one row of either kind.
    merged = both.groupBy("key").agg(
        *(F.coalesce(F.max(c), F.lit(none)).alias(c) for c, none in zip(("p0", "p1", "b0", "b1"), NOTHING, strict=True))
    )
    return Model(filed(merged), known=not words.isEmpty())


class Expressions(dict):
    """Expression -> difference of its log-likelihoods, filled batch by batch."""

    def __init__(self, model: Model):
        self.model = model
        self.older: dict[bytes, float] = {}

    def learn(self, words: set[bytes]) -> None:
        new = []
        for word in words - self.keys():
            value = self.older.get(word)
            if value is None:
                new.append(word)
            else:
                self[word] = value
        for k in range(0, len(new), 20_000):
            some = new[k : k + 20_000]
            self.update(zip(some, self.model.deltas(some).tolist(), strict=True))

    def age(self) -> None:
        if len(self) > MEMO:
            self.older = dict(self)
            self.clear()


def evidence(words: list[bytes], memo: Expressions) -> tuple[float, float, float]:
    """Of the most toxic expression, the most toxic passage and the whole text, each divided by
    its length."""
    if not words:
        return 0.0, 0.0, 0.0
    values = np.fromiter(map(memo.__getitem__, words), dtype=np.float64, count=len(words))
    sums = np.concatenate([[0.0], np.cumsum(values)])
    width = min(PASSAGE, len(words))
    return (
        float(values.max()),
        float((sums[width:] - sums[:-width]).max()) / width,
        float(sums[-1]) / len(words),
    )


def _evidence_rows(column: pa.Array, memo: Expressions) -> np.ndarray:
    """Evidence for each text of a batch; unseen expressions are looked up together."""
    rows, waiting, size = [], [], 0

    def finish() -> None:
        memo.learn(set().union(*waiting))
        rows.extend(evidence(words, memo) for words in waiting)
        waiting.clear()
        memo.age()

    for text in texts(column):
        words = words_of(text)
        waiting.append(words)
        size += len(words)
        if size > 100_000:
            finish()
            size = 0
    if waiting:
        finish()
    return np.array(rows, dtype=np.float64).reshape(-1, 3)


def _inputs(rows: np.ndarray) -> np.ndarray:
    """Evidence as the curve sees it, and a constant; very large values say no more than large ones."""
    return np.concatenate([np.clip(rows, -30.0, 30.0) / 10.0, np.ones((len(rows), 1))], axis=1)


def _drawn(labelled: DataFrame) -> DataFrame:
    """(doc_id, y, kept) of the texts for the curve: of each class one in CURVE_SHARE, SAMPLE at
    most, drawn by a hash of the id. A class of fewer texts than CURVE_SHARE lends all of them to
    the curve and keeps them in the counts, or it would have none in one of the two."""
    rows = []
    for y, n in labelled.groupBy("y").count().collect():
        of_class = labelled.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id")
        kept = n < CURVE_SHARE
        taken = of_class.select("doc_id", "y").limit(n if kept else min(SAMPLE, n // CURVE_SHARE))
        rows += [(*r, kept) for r in taken.collect()]
    return labelled.sparkSession.createDataFrame(rows, "doc_id long, y int, kept boolean")


def fit(docs: DataFrame, labels: DataFrame, folds: int = FOLDS, held_out: int = HELD_OUT) -> Model:
    """Learn from the labelled rows of ``docs`` outside the held-out fold."""
    known = labels_of(labels, "toxic").where(fold("doc_id", folds) != held_out)
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    labelled = stored(given.select("doc_id").join(bounded(known), "doc_id").distinct(), "labelled")
    drawn = _drawn(labelled)
    counted = labelled.join(F.broadcast(drawn.where("NOT kept")), "doc_id", "left_anti")
    model = fit_counts(stored(word_counts(given.join(bounded(counted), "doc_id")), "words"))
    if not model.known:
        return model
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("y", pa.int32()), *((n, pa.float64()) for n in "abc")])
        memo = Expressions(shared.value)
        for batch in batches:
            found = _evidence_rows(batch.column(0), memo)
            yield record_batch(schema, [batch.column(1), *map(pa.array, found.T.copy())])

    sample = (
        given.join(F.broadcast(drawn), "doc_id")
        .select("text", "y")
        .mapInArrow(measure, "y int, a double, b double, c double")
        .limit(8 * SAMPLE)
        .toArrow()
    )
    y = sample.column("y").to_numpy()
    if len(set(y.tolist())) == 2:
        found = np.stack([sample.column(n).to_numpy() for n in "abc"], axis=1)
        share = known.agg(F.avg("y")).first()[0]
        model.curve = tuple(fit_logistic(_inputs(found), y, share))
    else:
        model.known = False
    return model


def _scorer(model: Model, docs: DataFrame):
    """A function from a column of texts to their scores, for use in tasks."""
    if not model.known:
        return lambda column: np.zeros(len(column))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = ("toxicity", uuid.uuid4().hex)

    def score(column: pa.Array) -> np.ndarray:
        own = shared.value
        rows = _inputs(_evidence_rows(column, sole(key, lambda: Expressions(own))))
        return logistic((rows * np.array(own.curve)).sum(axis=1))

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


def keep_ordinary(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    scores = _scorer(model, docs)
    at = docs.columns.index("text")

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pc.less(pa.array(scores(batch.column(at))), 0.5))

    return docs.mapInArrow(sift, docs.schema)
