"""Ranked lexical search by the Best Position Algorithm.

Documents are read in shards. A shard keeps, for each term that is asked for, its impact list (the
shard's documents by falling impact, then rising id) and the place of each document in it. An
item reads its lists from the top, a block of positions of all lists at a time. Every document
found is looked up in all other lists at once, which gives its whole score and marks its
positions there as seen. A list's best position is the end of the run of seen positions from its
top: what stands behind it has no higher impact, so no document unseen so far can score more than
the impacts at the best positions add up to. A list whose every position is seen adds nothing. The
search of a shard stops when this is strictly below the k-th best score, so that all ties of the
k-th are found.

What a shard must beat is known before it is searched in depth: in a first round each shard
searches its first block only, and the k-th best score over all shards is a lower bound of the
final one. A shard sends k documents per item at most, and shards are merged by rank.

A shard is closed at SHARD_POSTINGS postings, whatever a source or a group of copies holds, and a
common term is dealt to all shards. Items are asked in blocks of about ITEM_BYTES of text, so what
is sent to the tasks (their terms with weights) is bounded.

Defined results: a null text has no terms; an item without terms, or whose terms no document has,
has no rows; repeated documents are ranked each for itself, equal ones one behind the other; a
null doc_id counts as a document and comes last among equals; equal item ids are answered row by
row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from berth.llm.common import record_batch, stored, texts, words_of

SHARD_POSTINGS = 4_000_000
ITEM_BYTES = 8 << 20
#: Positions of each list that a search reads first; each further block is twice as long.
FIRST_BLOCK = 32

RESULT = "item_id long, rank int, doc_id long, score long"
_NO_ID = np.iinfo(np.int64).max
_POSTINGS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n", pa.int64()),
        ("terms", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int64())),
    ]
)
_FOUND = pa.schema([("item", pa.int32()), ("doc_id", pa.int64()), ("score", pa.int64())])


def postings(docs: DataFrame, number_of: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, times): of each document how many terms it has, and which of the given
    ones how often."""
    shared = docs.sparkSession.sparkContext.broadcast(number_of)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number_of = shared.value
        asked = number_of.keys()
        for batch in batches:
            sizes, terms, times = [], [], []
            for text in texts(batch.column(1)):
                words = words_of(text)
                counts = Counter(words)
                own = counts.keys() & asked
                sizes.append(len(words))
                terms.append([number_of[w] for w in own])
                times.append([counts[w] for w in own])
            yield record_batch(_POSTINGS, [batch.column(0), sizes, terms, times])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        count, "doc_id long, n long, terms array<int>, times array<long>"
    )


class Shard:
    """Impact lists of some documents, with the way from a document to its place in a list."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, term: np.ndarray, doc: np.ndarray,
                 times: np.ndarray, docs: int, length: int):
        # Documents are numbered by id, so that equal impacts stand by rising id.
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), dtype=np.int64)
        place[order] = np.arange(len(ids))
        self.ids, doc = ids[order], place[doc]
        m = 100 - 75 + (75 * sizes[order] * docs) // max(length, 1)
        impact = (1_000_000_000 * times) // (1000 * times + 8 * m[doc])
        by_impact = np.lexsort((doc, -impact, term))
        self.doc, self.impact = doc[by_impact].astype(np.int32), impact[by_impact]
        self.terms, self.start = np.unique(term[by_impact], return_index=True)
        self.start = np.append(self.start, len(term))
        # Direct access: (list, document), ascending, and where it stands in the lists.
        listed = np.repeat(np.arange(len(self.terms)), np.diff(self.start))
        key = listed * len(ids) + self.doc
        self.position = np.argsort(key)
        self.key = key[self.position]

    def search(self, lists: np.ndarray, weights: np.ndarray, k: int, beat: int, blocks: int | None):
        """(documents, scores) of the best k, or of those that may be among the best of all shards
        if ``beat`` is a score that k documents reach. ``blocks`` ends the search early."""
        starts, ends = self.start[lists], self.start[lists + 1]
        first = starts.min()
        seen = np.zeros(ends.max() - first + 1, dtype=bool)  # position of the item's lists
        known = np.zeros(len(self.ids), dtype=bool)
        best = starts.copy()  # the first position of each list that is not seen
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        read, step = 0, FIRST_BLOCK
        while True:
            found = np.concatenate(
                [self.doc[s + read : min(s + read + step, e)] for s, e in zip(starts, ends, strict=True)]
            )
            found = np.unique(found[~known[found]]).astype(np.int64)
            known[found] = True
            keys = (lists * len(self.ids))[:, None] + found
            at = np.searchsorted(self.key, keys)
            hit = self.key[np.minimum(at, len(self.key) - 1)] == keys
            position = self.position[at[hit]]
            seen[position - first] = True
            gained = np.zeros(keys.shape, dtype=np.int64)
            gained[hit] = self.impact[position]
            docs = np.concatenate([docs, found])
            scores = np.concatenate([scores, weights @ gained])
            if len(docs) > k:
                keep = np.lexsort((docs, -scores))[:k]
                docs, scores = docs[keep], scores[keep]
            read, step = read + step, 2 * step
            if blocks is not None:
                blocks -= 1
                if not blocks:
                    break
            bound = 0
            for i, (b, e) in enumerate(zip(best, ends, strict=True)):
                if b < e:
                    run = seen[b - first : e - first]
                    unseen = int(run.argmin())
                    best[i] = b = e if run[unseen] else b + unseen
                    if b < e:
                        bound += int(weights[i] * self.impact[b - 1])
            if not bound or bound < max(beat, scores.min() if len(docs) == k else 0):
                break
        good = (scores >= max(beat, 1)) if blocks is None else scores > 0
        return docs[good], scores[good]


def _search(rows: DataFrame, items: list[list[tuple[int, int]]], docs: int, length: int, k: int,
            beat: dict[int, int] | None) -> DataFrame:
    """(item, doc_id, score): up to k documents of each item from each shard of the postings.
    An item is its terms with their weights, repeats included; without ``beat`` only the first
    block of each list is read."""
    shared = rows.sparkSession.sparkContext.broadcast((items, beat))

    def answer(shard: Shard) -> Iterator[pa.RecordBatch]:
        items, beat = shared.value
        of_term = {t: i for i, t in enumerate(shard.terms.tolist())}
        found: list[list] = [[], [], []]
        for number, asked in enumerate(items):
            own = [(of_term[t], w) for t, w in asked if t in of_term]
            if not own:
                continue
            lists, weights = (np.array(c, dtype=np.int64) for c in zip(*sorted(own), strict=True))
            at_least = beat.get(number, 0) if beat is not None else 0
            at, scores = shard.search(lists, weights, k, at_least, 1 if beat is None else None)
            found[0].append(np.full(len(at), number))
            found[1].append(shard.ids[at])
            found[2].append(scores)
        if found[0]:
            numbers, ids, scores = (np.concatenate(c) for c in found)
            named = pa.array(ids, mask=ids == _NO_ID)
            yield record_batch(_FOUND, [pa.array(numbers, pa.int32()), named, pa.array(scores, pa.int64())])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(len(b.column(2).flatten()) for b in held) >= SHARD_POSTINGS:
                yield from answer(shard_of(held))
                held = []
        if any(len(b.column(2).flatten()) for b in held):
            yield from answer(shard_of(held))

    def shard_of(held: list[pa.RecordBatch]) -> Shard:
        table = pa.Table.from_batches(held).combine_chunks()
        ids, sizes, terms, times = (c.combine_chunks() for c in table.columns)
        ids = ids.fill_null(_NO_ID).to_numpy()
        doc = np.repeat(np.arange(len(ids)), np.diff(terms.offsets.to_numpy()))
        flat = (c.flatten().to_numpy() for c in (terms, times))
        term, times = flat
        return Shard(ids, sizes.to_numpy(), term, doc, times, docs, length)

    return rows.where(F.size("terms") > 0).mapInArrow(gather, "item int, doc_id long, score long")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents (doc_id, text) of each item (item_id,
    text)."""
    asked = items.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = size // ITEM_BYTES + 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    found = None
    for b in range(blocks):
        own = _search_block(docs, asked.where(block == b).collect(), k)
        found = own if found is None else found.unionByName(own)
    return found


def _search_block(docs: DataFrame, asked: list, k: int) -> DataFrame:
    spark = docs.sparkSession
    terms = [Counter(words_of(text or "")) for _, text in asked]
    number_of = {t: i for i, t in enumerate(sorted(set().union(*terms)))}
    rows = stored(postings(docs, number_of), "postings")
    given = rows.where("n > 0").agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    docs_with_terms, length = given
    # One number per term of the block's items.
    df = dict(rows.select(F.explode("terms").alias("t")).groupBy("t").count().collect())
    weights = {t: weight(docs_with_terms, n) for t, n in df.items()}
    questions = [
        [(i, weights[i] * times) for t, times in own.items() if weights.get(i := number_of[t], 0) > 0]
        for own in terms
    ]
    first = _ranked(_search(rows, questions, docs_with_terms, length, k, None), k)
    beat = dict(first.where(F.col("rank") == k).select("item", "score").collect())
    best = _ranked(_search(rows, questions, docs_with_terms, length, k, beat), k)
    names = spark.createDataFrame(
        [(i, item_id) for i, (item_id, _) in enumerate(asked)], "item int, item_id long"
    )
    return best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
