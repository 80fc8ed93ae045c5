"""Near-duplicate vectors through hierarchical navigable small-world graphs, one for each shard.

Different vectors are dealt to shards by a hash. A task builds the graph of its shard and then
asks it for every vector of the table, in blocks, as they stream by; so memory is bounded by a
shard and a block. A block is searched with a beam. Beams that are still full of linked vectors
are widened until they are not; and each shard is audited before it is asked. Its own vectors,
drawn by a hash, are compared with the whole shard until AUDIT_PAIRS links without those to
themselves are known or all are compared; and beside AUDIT_PAIRS of its nodes an asking vector is
planted just within the threshold, so that shards with few links are measured too. The starting
beam is doubled until RECALL of either are found. A beam as wide as the shard is brute force, and
so is a wider beam that would cost more than that. Cosines of what was found are computed in double
precision, and only those of at least the threshold are links. Each link can be found from both of
its ends.

Equal vectors are one node that knows how many they are, so they are never paired. Groups are
the components of the links.

Defined results: see ``vectors.usable`` for the vectors that take part; any other row links with
nothing and is its own group; one row is returned for each row of the table, and rows that repeat
a vec_id get the same answer and do not count as links of each other; a null vec_id has a null
component_id and is not kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm.common import record_batch, stored
from berth.llm.components import connect
from berth.llm.vectors import distinct_vectors, matrix, usable

THRESHOLD = 0.95
#: Every shard is asked for every vector, so there are as few as keep the cores at work, as long as
#: they are not larger than SHARD_ROWS; small tables have shards of LEAST_ROWS.
SHARDS, SHARD_ROWS, LEAST_ROWS = 12, 200_000, 2_000
#: Neighbours of a node on an upper level; twice as many at the bottom.
NEIGHBOURS = 12
BUILD_BEAM, FIRST_BEAM = 32, 24
AUDIT, AUDIT_PAIRS, RECALL = 64, 1_000, 0.995
#: Nodes of an upper level up to which a search compares them all.
ENTRIES = 8_192
#: A place of a beam costs about as much as so many nodes in a product of matrices, so beams are
#: no longer widened where comparing all nodes is the lesser work.
PLACE = 3_000
TILE_ROWS, TILE_NODES = 256, 2_048
#: Pairs of vectors that are compared at a time.
AT_ONCE = 1_024
#: Cells of the table of visited nodes in a block of searches.
VISITED = 16_000_000


class Graph:
    """A small-world graph over unit vectors, built and searched for many vectors at a time."""

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        self.vectors = vectors.astype(np.float32)
        n = len(vectors)
        draw = np.random.default_rng(seed)
        levels = np.floor(-np.log(1 - draw.random(n)) / math.log(NEIGHBOURS)).astype(int)
        # Nodes of high levels first: then the first nodes are the entries of every level.
        order = np.argsort(-levels, kind="stable")
        self.order, self.vectors, self.levels = order, self.vectors[order], levels[order]
        self.marks = np.zeros(0, dtype=bool)
        self.links: list[np.ndarray] = []
        self.filled: list[np.ndarray] = []
        for level in range(int(self.levels[0]) + 1 if n else 0):
            members = int((self.levels >= level).sum())
            width = NEIGHBOURS * (1 if level else 2)
            self.links.append(np.full((members, width), -1, dtype=np.int32))
            self.filled.append(np.zeros(members, dtype=np.int32))
            self._build(level, members)

    def _build(self, level: int, members: int) -> None:
        """Levels hold a prefix of the nodes; each takes in its nodes in doubling batches."""
        start = 0
        while start < members:
            stop = min(members, max(2 * start, 64), start + 1024)
            new = np.arange(start, stop)
            given = self.vectors[new]
            among = given @ given.T
            np.fill_diagonal(among, -2.0)
            near = np.argsort(-among, axis=1)[:, : BUILD_BEAM // 2]
            ids, sims = new[near], np.take_along_axis(among, near, axis=1)
            if start:
                old, old_sims = self.beam(level, given, np.zeros(len(new), int), BUILD_BEAM, start)
                ids, sims = np.concatenate([ids, old], axis=1), np.concatenate([sims, old_sims], axis=1)
            chosen = self._diverse(ids, sims, NEIGHBOURS)
            for node, row in zip(new, chosen, strict=True):
                row = row[row >= 0]
                self.links[level][node, : len(row)] = row
                self.filled[level][node] = len(row)
            self._link_back(level, new, chosen)
            start = stop

    def _diverse(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of each row's candidates those that are nearer to it than to any chosen before, then
        the nearest of the others."""
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)
        rows, width = ids.shape
        points = self.vectors[np.maximum(ids, 0)]
        valid = (ids >= 0) & (sims > -1.5)
        picked = np.zeros((rows, width), dtype=bool)
        closest = np.full((rows, width), -2.0, dtype=np.float32)  # to any chosen one
        for k in range(width):
            take = valid[:, k] & (sims[:, k] > closest[:, k]) & (picked.sum(axis=1) < most)
            picked[:, k] = take
            at = np.flatnonzero(take)
            if len(at):
                to_new = np.einsum("rkd,rd->rk", points[at], points[at, k])
                closest[at] = np.maximum(closest[at], to_new)
        # Chosen ones first, then the nearest of the rest.
        rank = np.where(picked, 0, np.where(valid, 1, 2)) * width + np.arange(width)
        best = np.argsort(rank, axis=1, kind="stable")[:, :most]
        found = np.take_along_axis(ids, best, axis=1)
        return np.where(np.take_along_axis(valid, best, axis=1), found, -1)

    def _link_back(self, level: int, new: np.ndarray, chosen: np.ndarray) -> None:
        links, filled = self.links[level], self.filled[level]
        width = links.shape[1]
        targets, sources = chosen.ravel(), np.repeat(new, chosen.shape[1])
        keep = targets >= 0
        order = np.argsort(targets[keep], kind="stable")
        targets, sources = targets[keep][order], sources[keep][order]
        bounds = np.flatnonzero(np.diff(targets, prepend=-1, append=-1))
        full_ids, full_sets = [], []
        for a, b in zip(bounds, bounds[1:], strict=False):
            node, added = targets[a], sources[a:b]
            have = links[node, : filled[node]]
            every = np.unique(np.concatenate([have, added]))
            if len(every) <= width:
                links[node, : len(every)] = every
                filled[node] = len(every)
            else:
                full_ids.append(node)
                full_sets.append(every)
        if not full_ids:
            return
        # Lists that overflow are chosen anew, together.
        most = max(map(len, full_sets))
        ids = np.full((len(full_ids), most), -1)
        for k, every in enumerate(full_sets):
            ids[k, : len(every)] = every
        nodes = np.array(full_ids)
        for k in range(0, len(nodes), 512):
            own, some = nodes[k : k + 512], ids[k : k + 512]
            sims = np.einsum("rkd,rd->rk", self.vectors[np.maximum(some, 0)], self.vectors[own])
            sims[some < 0] = -2.0
            links[own] = self._diverse(some, sims, width)
            filled[own] = (links[own] >= 0).sum(axis=1)

    def beam(
        self, level: int, queries: np.ndarray, starts: np.ndarray, width: int, members: int | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found from the start nodes, with their cosines; -1 where
        fewer were found."""
        links = self.links[level]
        members = members or len(links)
        count = len(queries)
        seen = self._unseen(count, members)
        rows = np.arange(count)
        seen[rows, starts] = True
        visited = [rows * members + starts]
        ids = np.full((count, width), -1, dtype=np.int32)
        sims = np.full((count, width), -2.0, dtype=np.float32)
        done = np.ones((count, width), dtype=bool)
        ids[:, 0], done[:, 0] = starts, False
        sims[:, 0] = np.einsum("rd,rd->r", self.vectors[starts], queries)
        live = rows
        step = max(2, min(16, width // 8))
        while len(live):
            waiting = np.where(done[live], -3.0, sims[live])
            open_ = np.argpartition(-waiting, min(step, width - 1), axis=1)[:, :step]
            some = np.take_along_axis(waiting, open_, axis=1) > -3.0
            go = some.any(axis=1)
            live, open_, some = live[go], open_[go], some[go]
            if not len(live):
                break
            nodes = np.where(some, ids[live[:, None], open_], -1)
            done[live[:, None], open_] = True
            around = np.where(nodes[:, :, None] >= 0, links[np.maximum(nodes, 0)], -1).reshape(len(live), -1)
            around = np.sort(np.where(around < members, around, -1), axis=1)
            fresh = around >= 0
            fresh[:, 1:] &= around[:, 1:] != around[:, :-1]
            row, col = np.nonzero(fresh)
            node = around[row, col]
            cells = live[row] * members + node
            new = ~seen.ravel()[cells]
            row, node, cells = row[new], node[new], cells[new]
            if not len(row):
                continue
            seen.ravel()[cells] = True
            visited.append(cells)
            near = self._cosines(node, queries, live[row])
            counts = np.bincount(row)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            more = int(counts.max())
            new_ids = np.full((len(live), more), -1, dtype=np.int32)
            new_sims = np.full((len(live), more), -2.0, dtype=np.float32)
            new_ids[row, place], new_sims[row, place] = node, near
            all_ids = np.concatenate([ids[live], new_ids], axis=1)
            all_sims = np.concatenate([sims[live], new_sims], axis=1)
            all_done = np.concatenate([done[live], new_ids < 0], axis=1)
            best = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[live] = np.take_along_axis(all_ids, best, axis=1)
            sims[live] = np.take_along_axis(all_sims, best, axis=1)
            done[live] = np.take_along_axis(all_done, best, axis=1)
        seen.ravel()[np.concatenate(visited)] = False
        return ids, sims

    def _cosines(self, nodes: np.ndarray, queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Cosines of nodes and rows of the queries, so many at a time that they stay in a cache."""
        found = np.empty(len(nodes), dtype=np.float32)
        size = min(AT_ONCE, len(nodes))
        a, b = np.empty((2, size, self.vectors.shape[1]), dtype=np.float32)
        for k in range(0, len(nodes), size):
            some, own = nodes[k : k + size], rows[k : k + size]
            m = len(some)
            np.take(self.vectors, some, axis=0, out=a[:m], mode="clip")
            np.take(queries, own, axis=0, out=b[:m], mode="clip")
            np.einsum("nd,nd->n", a[:m], b[:m], out=found[k : k + size])
        return found

    def _unseen(self, count: int, members: int) -> np.ndarray:
        """A table of nodes that no query has visited. It is used again, as every beam takes back
        what it has marked, so its size costs nothing."""
        if len(self.marks) < count * members:
            self.marks = np.zeros(count * members, dtype=bool)
        return self.marks[: count * members].reshape(count, members)

    def search(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        # The search begins in the lowest level above the bottom that is compared as a whole.
        top = next((k for k in range(1, len(self.links)) if len(self.links[k]) <= ENTRIES), 0)
        starts = np.zeros(len(queries), dtype=np.int64)
        if top:
            starts = np.argmax(queries @ self.vectors[: len(self.links[top])].T, axis=1)
        for level in range(top - 1, 0, -1):
            ids, sims = self.beam(level, queries, starts, 2)
            starts = ids[np.arange(len(queries)), np.argmax(sims, axis=1)].astype(np.int64)
        return self.beam(0, queries, starts, width)

    def wider(self, width: int) -> int:
        """The width to go on with: the whole graph where comparing all nodes is the lesser work."""
        return len(self.vectors) if width * PLACE >= len(self.vectors) else width

    def compared(self, queries: np.ndarray, floor: float) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs at ``floor`` or more among all, by tiles that stay in a cache."""
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        tile = np.empty((TILE_ROWS, TILE_NODES), dtype=np.float32)
        for a in range(0, len(queries), TILE_ROWS):
            some = queries[a : a + TILE_ROWS]
            for b in range(0, len(self.vectors), TILE_NODES):
                nodes = self.vectors[b : b + TILE_NODES]
                sims = np.matmul(some, nodes.T, out=tile[: len(some), : len(nodes)])
                if sims.max() >= floor:
                    row, node = np.nonzero(sims >= floor)
                    pairs.append((row + a, node + b))
        if not pairs:
            return np.zeros(0, int), np.zeros(0, int)
        return tuple(map(np.concatenate, zip(*pairs, strict=True)))

    def within(self, queries: np.ndarray, floor: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs at ``floor`` or more; full beams are widened."""
        queries = queries.astype(np.float32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        left = np.arange(len(queries))
        width = min(width, max(len(self.vectors), 1))
        while len(left):
            block = max(1, VISITED // max(len(self.vectors), 1))
            again = []
            for k in range(0, len(left), block):
                some = left[k : k + block]
                if width >= len(self.vectors):
                    # Also nodes that no way leads to.
                    row, node = self.compared(queries[some], floor)
                    found.append((some[row], node))
                    continue
                ids, sims = self.search(queries[some], width)
                near = (sims >= floor) & (ids >= 0)
                full = near.all(axis=1)
                row, col = np.nonzero(near & ~full[:, None])
                found.append((some[row], ids[row, col]))
                again.append(some[full])
            left = np.concatenate(again) if again else left[:0]
            width = self.wider(4 * width)
        pairs = [np.concatenate(p) for p in zip(*found, strict=True)] if found else [np.zeros(0, int)] * 2
        return pairs[0], self.order[pairs[1]]


def unit(rows: np.ndarray) -> np.ndarray:
    # By the largest component first, so that no square leaves the range of doubles.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


class Shard:
    """The graph of a shard, with the beam that its audit asked for."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, floor: float):
        self.ids, self.vectors, self.floor = ids, unit(vectors), floor
        self.graph = Graph(self.vectors)
        self.width = 0

    def known_links(self, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asking, found) places of links among the shard's own vectors, by brute force."""
        pairs, count = [], 0
        vectors = self.vectors.astype(np.float32)
        for k in range(0, len(order), AUDIT):
            some = order[k : k + AUDIT]
            near = vectors[some] @ vectors.T >= self.floor
            near[np.arange(len(some)), some] = False
            row, node = np.nonzero(near)
            pairs.append((some[row], node))
            count += len(row)
            if count >= AUDIT_PAIRS:
                break
        return tuple(map(np.concatenate, zip(*pairs, strict=True)))

    def planted(self, nodes: np.ndarray) -> np.ndarray:
        """For each node a unit vector just within the threshold of it, in a random direction."""
        own = self.vectors[nodes]
        aside = np.random.default_rng(5).normal(size=own.shape)
        aside -= np.einsum("nd,nd->n", aside, own)[:, None] * own
        aside /= np.maximum(np.sqrt((aside**2).sum(axis=1, keepdims=True)), 1e-12)
        cosine = min(self.floor + 1e-5, 1.0)
        return cosine * own + math.sqrt(1 - cosine**2) * aside

    def audit(self) -> None:
        order = np.argsort(self.ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), kind="stable")
        asking, node = self.known_links(order)
        askers, row = np.unique(asking, return_inverse=True)
        drawn = order[:AUDIT_PAIRS]
        parts = [(self.vectors[askers], row, node)] if len(askers) else []
        parts.append((self.planted(drawn), np.arange(len(drawn)), drawn))
        self.width = FIRST_BEAM
        while self.width < len(self.vectors) and not all(self.finds(*p) for p in parts):
            self.width = self.graph.wider(2 * self.width)

    def finds(self, queries: np.ndarray, row: np.ndarray, node: np.ndarray) -> bool:
        """Whether the beam finds RECALL of the links of the queries."""
        found = self.graph.within(queries, self.floor - 1e-4, self.width)
        keys = [r.astype(np.int64) * len(self.vectors) + n for r, n in ((row, node), found)]
        return np.isin(*keys).mean() >= RECALL

    def links(self, ids: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        queries = unit(vectors)
        if not self.width:
            self.audit()
        row, node = self.graph.within(queries, self.floor - 1e-4, self.width)
        exact = np.einsum("nd,nd->n", queries[row], self.vectors[node]) >= self.floor
        a, b = ids[row[exact]], self.ids[node[exact]]
        other = a != b
        return np.maximum(a, b)[other], np.minimum(a, b)[other]


def shards_of(total: int, cores: int) -> int:
    return max(1, min(SHARDS, cores, -(-total // LEAST_ROWS)), -(-total // SHARD_ROWS))


def links(classes: DataFrame, total: int, threshold: float = THRESHOLD) -> DataFrame:
    """Links (a, b), a > b, between class_ids whose cosine is at least ``threshold``."""
    shards = shards_of(total, classes.sparkSession.sparkContext.defaultParallelism)
    held = classes.select(
        F.pmod(F.xxhash64("class_id"), F.lit(shards)).cast("int").alias("shard"),
        F.lit(0).alias("kind"), "class_id", "embedding",
    )
    asked = classes.select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"),
        F.lit(1).alias("kind"), "class_id", "embedding",
    )
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by shard, a shard's own vectors before those that ask."""
        shard, current = None, None
        own: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            numbers, kinds = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            cuts = np.flatnonzero(np.diff(numbers * 2 + kinds)) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
                if a == b:
                    continue
                ids, vectors = batch.column(2).to_numpy()[a:b], matrix(batch.column(3).slice(a, b - a))
                if numbers[a] != current:
                    current, shard, own = numbers[a], None, []
                if kinds[a] == 0:
                    own.append((ids, vectors))
                    continue
                if shard is None and own:
                    shard = Shard(*(np.concatenate(p) for p in zip(*own, strict=True)), threshold)
                    own = []
                if shard is not None:
                    yield record_batch(schema, map(pa.array, shard.links(ids, vectors)))

    dealt = held.union(asked).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind")
    return dealt.mapInArrow(ask, "a long, b long").distinct()


def near_duplicates(table: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for each row of the table."""
    rows = stored(usable(table), "vectors")
    classes = stored(distinct_vectors(rows, 1), "classes")
    linked = stored(links(classes, classes.count(), threshold), "links")
    both = linked.union(linked.select(F.col("b"), F.col("a"))).toDF("class_id", "other")
    sizes = classes.select(F.col("class_id").alias("other"), "copies")
    degrees = both.join(sizes, "other").groupBy("class_id").agg(F.sum("copies").alias("outside"))
    roots = connect(linked)
    smallest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    found = roots.join(smallest, "root").select(F.col("node").alias("class_id"), "component_id")
    answers = (
        classes.join(degrees, "class_id", "left")
        .join(found, "class_id", "left")
        .select(
            "embedding",
            (F.col("copies") - 1 + F.coalesce("outside", F.lit(0))).alias("n_links"),
            F.coalesce("component_id", "class_id").alias("component_id"),
        )
    )
    by_id = rows.join(answers, "embedding").select("vec_id", "n_links", "component_id")
    return (
        table.select(F.col("vec_id").cast("long").alias("vec_id"))
        .join(by_id, "vec_id", "left")
        .select(
            "vec_id",
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "vec_id").alias("component_id"),
            F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
        )
    )
