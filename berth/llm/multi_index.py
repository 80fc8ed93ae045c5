"""Nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised separately, so a pair of centroids names a cell, and a
few hundred centroids make tens of thousands of cells. A query meets cells in the order of
falling summed inner product of its halves with the two centroids, by a heap over the two sorted
lists, until the cells hold enough entries; these are ranked by the exact inner product.

How many entries are enough is measured: for AUDIT queries the true neighbours are found by brute
force, the queries' traversals tell how many entries each neighbour costs, and the number is the
smallest that reaches RECALL of them.

Cells are laid out one behind another and cut into groups of GROUP entries (a larger cell into
several), so no task gets a cell whole that holds a third of the table; queries go to the groups
that hold their cells, and each returns at most ``nearest`` rows from a group. Equal vectors are
one entry with its smallest ids. Centroids are fitted on at most SAMPLE vectors; all are indexed.

Defined results: see ``vectors.usable`` for the vectors that take part; a query's own id is no
candidate; a query with fewer candidates gets all of them.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from berth.llm.common import record_batch, stored
from berth.llm.vectors import distinct_vectors, matrix, usable

NEAREST = 20
SAMPLE = 20_000
ROUNDS = 8
#: Entries that a cell has on average, and the most centroids for a half.
PER_CELL, MOST_CENTROIDS = 16, 1024
GROUP = 4_000
AUDIT, RECALL = 100, 0.97
#: Entries that any query ranks at least.
LEAST = 500

FOUND = "query_id long, vec_id long, score double"


def k_means(rows: np.ndarray, k: int, rounds: int = ROUNDS, seed: int = 5) -> np.ndarray:
    """Centroids of plain Lloyd rounds; an empty one is moved to a drawn row."""
    draw = np.random.default_rng(seed)
    centers = rows[draw.choice(len(rows), min(k, len(rows)), replace=False)].copy()
    for _ in range(rounds):
        at = nearest_center(rows, centers)
        sums = np.zeros_like(centers)
        np.add.at(sums, at, rows)
        counts = np.bincount(at, minlength=len(centers))
        full = counts > 0
        centers[full] = sums[full] / counts[full, None]
        if not full.all():
            centers[~full] = rows[draw.choice(len(rows), int((~full).sum()))]
    return centers


def nearest_center(rows: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(axis=1) - 2 * rows @ centers.T, axis=1)


@dataclass
class Index:
    """Centroids of both halves; where each cell begins in the layout, and its entries."""

    halves: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    starts: np.ndarray

    def cells(self, rows: np.ndarray) -> np.ndarray:
        cut = self.halves[0].shape[1]
        first = nearest_center(rows[:, :cut], self.halves[0])
        return first * len(self.halves[1]) + nearest_center(rows[:, cut:], self.halves[1])

    def visited(self, query: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cells that have entries, nearest first, each with the entries met so far."""
        cut = self.halves[0].shape[1]
        near = [self.halves[0] @ query[:cut], self.halves[1] @ query[cut:]]
        order = [np.argsort(-n, kind="stable").tolist() for n in near]
        ranked = [n[o].tolist() for n, o in zip(near, order, strict=True)]
        width = len(order[1])
        # A pair waits once its neighbours before it have been taken.
        heap = [(-ranked[0][0] - ranked[1][0], 0, 0)]
        taken = [0] * len(order[0])  # of each row, how many pairs have been taken
        met = 0
        while heap:
            _, i, j = heapq.heappop(heap)
            taken[i] = j + 1
            cell = order[0][i] * width + order[1][j]
            if self.counts[cell]:
                met += int(self.counts[cell])
                yield cell, met
            if j + 1 < width and (i == 0 or taken[i - 1] > j + 1):
                heapq.heappush(heap, (-ranked[0][i] - ranked[1][j + 1], i, j + 1))
            if i + 1 < len(order[0]) and taken[i + 1] == j:
                heapq.heappush(heap, (-ranked[0][i + 1] - ranked[1][j], i + 1, j))

    def groups(self, cell: int) -> range:
        first, size = int(self.starts[cell]), int(self.counts[cell])
        return range(first // GROUP, (first + size - 1) // GROUP + 1)


def fit_centers(classes: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray]:
    rows = classes.orderBy(F.xxhash64("class_id"), "class_id").limit(SAMPLE).select("embedding")
    sample = matrix(rows.toArrow().column(0))
    k = min(MOST_CENTROIDS, max(4, round(math.sqrt(total / PER_CELL))))
    cut = sample.shape[1] // 2
    return k_means(sample[:, :cut], k if cut else 1), k_means(sample[:, cut:], k)


def _top(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the best scores, ties to the smaller id."""
    if len(scores) > most:
        floor = np.partition(scores, len(scores) - most)[len(scores) - most]
        near = np.flatnonzero(scores >= floor)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))][:most]


def brute_force(classes: DataFrame, queries: DataFrame, most: int) -> DataFrame:
    """FOUND rows for a bounded number of queries (vec_id, embedding), against all entries."""
    given = queries.toArrow()
    ids, rows = given.column("vec_id").to_numpy(), matrix(given.column("embedding"))

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            if not batch.num_rows:
                continue
            entries, owners = matrix(batch.column(0)), batch.column(1)
            scores = rows @ entries.T
            out: list[tuple[int, int, float]] = []
            firsts = np.array([o[0].as_py() for o in owners])
            for q, own in enumerate(ids):
                # One entry more, as the query's own may drop out.
                for e in _top(scores[q], firsts, most + 1):
                    out += [(own, v, scores[q, e]) for v in owners[e].as_py() if v != own]
            yield record_batch(schema, list(zip(*out, strict=True)) or [[]] * 3)

    return best(classes.select("embedding", "ids").mapInArrow(rank, FOUND), most)


def best(found: DataFrame, most: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)


def enough(index: Index, entries: DataFrame, classes: DataFrame, queries: DataFrame, most: int, recall: float) -> int:
    """Entries to rank per query so that the audit queries find ``recall`` of their neighbours."""
    audit = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(AUDIT)
    audit = stored(audit, "audit")
    truth = stored(brute_force(classes, audit, most), "truth")
    places = entries.select(F.explode("ids").alias("vec_id"), "cell").join(
        F.broadcast(truth.select("query_id", "vec_id")), "vec_id"
    )
    wanted: dict[int, list[int]] = {}
    for row in places.select("query_id", "cell").collect():  # at most AUDIT * most rows
        wanted.setdefault(row["query_id"], []).append(row["cell"])
    costs: list[int] = []
    for row in audit.collect():
        left = wanted.get(row["vec_id"], [])
        cells = set(left)
        for cell, met in index.visited(np.array(row["embedding"], dtype=np.float64)):
            if not cells:
                break
            if cell in cells:
                cells.discard(cell)
                costs += [met] * left.count(cell)
    costs.sort()
    return max(LEAST, costs[math.ceil(recall * len(costs)) - 1] if costs else 0)


def search(
    table: DataFrame, every: int, most: int = NEAREST, recall: float = RECALL
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``most`` nearest rows by inner product of each row
    whose vec_id is divisible by ``every``."""
    rows = stored(usable(table), "vectors")
    classes = stored(distinct_vectors(rows, most + 1), "classes")
    total = classes.count()
    queries = rows.where(F.col("vec_id") % every == 0)
    if not total or not queries.limit(1).count():
        empty = rows.limit(0).select(F.col("vec_id").alias("query_id"), F.lit(1).alias("rank"), "vec_id", F.lit(0.0).alias("score"))
        return empty
    halves = fit_centers(classes, total)
    plain = Index(halves, np.zeros(0), np.zeros(0))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = pa.array(plain.cells(matrix(batch.column(1))), pa.int64())
                yield batch.append_column("cell", cells)

    entries = stored(
        classes.mapInArrow(assign, "class_id long, embedding array<float>, ids array<long>, cell long"),
        "entries",
    )
    # At most MOST_CENTROIDS squared rows.
    sizes = entries.groupBy("cell").count().toArrow()
    counts = np.zeros(len(halves[0]) * len(halves[1]), dtype=np.int64)
    counts[sizes.column(0).to_numpy()] = sizes.column(1).to_numpy()
    index = Index(halves, counts, np.cumsum(counts) - counts)
    target = enough(index, entries, classes, queries, most, recall)
    shared = table.sparkSession.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entries with the group that holds them: an even draw within the cell."""
        own = shared.value
        for batch in batches:
            if batch.num_rows:
                cells = batch.column(3).to_numpy()
                drawn = (batch.column(0).to_numpy().astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(20)
                at = own.starts[cells] + (drawn % own.counts[cells].astype(np.uint64)).astype(np.int64)
                yield batch.append_column("part", pa.array(at // GROUP, pa.int64()))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Queries with the cells they visit, once for each group."""
        own = shared.value
        schema = pa.schema(
            [("query_id", pa.int64()), ("query", pa.list_(pa.float32())), ("visit", pa.list_(pa.int64())), ("part", pa.int64())]
        )
        for batch in batches:
            vectors = matrix(batch.column(1))
            for k in range(0, batch.num_rows, 500):
                out: list[tuple] = []
                for q in range(k, min(k + 500, batch.num_rows)):
                    parts: dict[int, list[int]] = {}
                    for cell, met in own.visited(vectors[q]):
                        for g in own.groups(cell):
                            parts.setdefault(g, []).append(cell)
                        if met >= target:
                            break
                    query_id, vector = batch.column(0)[q].as_py(), vectors[q].astype(np.float32)
                    out += [(query_id, vector, cells, g) for g, cells in parts.items()]
                if out:
                    yield record_batch(schema, list(zip(*out, strict=True)))

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": [], "vec_id": [], "score": []}).astype(
            {"query_id": "int64", "vec_id": "int64", "score": "float64"}
        )
        if left.empty or right.empty:
            return none
        right = right.sort_values("cell", kind="stable")
        cells = right["cell"].to_numpy()
        vectors = np.stack(right["embedding"].to_numpy()).astype(np.float64)
        firsts, owners = right["class_id"].to_numpy(), right["ids"].to_numpy()
        out: list[tuple[int, int, float]] = []
        for own, query, visit in zip(left["query_id"], left["query"], left["visit"], strict=True):
            cut = [np.searchsorted(cells, visit, side=s) for s in ("left", "right")]
            at = np.concatenate([np.arange(a, b) for a, b in zip(*cut, strict=True)])
            if not len(at):
                continue
            scores = vectors[at] @ np.asarray(query, dtype=np.float64)
            rows = [
                (-scores[e], v)
                for e in _top(scores, firsts[at], most + 1)
                for v in owners[at[e]]
                if v != own
            ]
            out += [(own, v, -s) for s, v in sorted(rows)[:most]]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]) if out else none

    placed = entries.mapInArrow(
        place, "class_id long, embedding array<float>, ids array<long>, cell long, part long"
    )
    routed = queries.select("vec_id", "embedding").mapInArrow(
        route, "query_id long, query array<float>, visit array<long>, part long"
    )
    found = routed.groupBy("part").cogroup(placed.groupBy("part")).applyInPandas(rank, FOUND)
    return best(found, most).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
