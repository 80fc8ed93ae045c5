"""SimHash groups, vector groups, searches and components, against brute force."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from cases import TEXTS, docs
from pyspark.sql import functions as F

from berth.llm import components, multi_index, simhash, small_world


def united(n, pairs):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, b in pairs:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    return [root(x) for x in range(n)]


@pytest.mark.parametrize(
    "pairs",
    [
        [],
        [(k, k + 1) for k in range(200)],
        [(k, 500) for k in range(300)],
        [(k % 40, (k * 7) % 40 + 40) for k in range(60)] + [(90, 91), (91, 90)],
    ],
)
def test_components(spark, pairs):
    links = spark.createDataFrame(pairs, "a long, b long") if pairs else spark.range(0).selectExpr("id a", "id b")
    found = {r.node: r.root for r in components.connect(links).collect()}
    nodes = sorted({x for p in pairs for x in p})
    assert sorted(found) == nodes
    expected = united(600, pairs)
    for x in nodes:
        assert [found[x] == found[y] for y in nodes] == [expected[x] == expected[y] for y in nodes]


def plain_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups_of(rows):
    """(doc_id, fp) rows -> component_id of each, by comparing all pairs."""
    fps = [f for _, f in rows]
    near = [(i, j) for i in range(len(fps)) for j in range(i) if (fps[i] ^ fps[j]).bit_count() <= 2]
    roots = united(len(rows), near)
    ids = {}
    for root, (doc_id, _) in zip(roots, rows, strict=True):
        ids[root] = min([x for x in (ids.get(root), doc_id) if x is not None], default=None)
    return roots, [ids[r] for r in roots]


def test_simhash_edges(spark):
    rows = [(i, plain_fingerprint(t)) for i, t in TEXTS]
    roots, expected = groups_of(rows)
    found = simhash.groups(docs(spark)).collect()
    assert Counter((r.doc_id, r.fingerprint, r.component_id) for r in found) == Counter(
        (i, f"{f:016x}", c) for (i, f), c in zip(rows, expected, strict=True)
    )
    kept = simhash.keep_one(docs(spark))
    assert kept.columns == docs(spark).columns
    assert kept.count() == len(set(roots))
    assert simhash.groups(docs(spark).limit(0)).collect() == []
    assert simhash.keep_one(docs(spark).limit(0)).collect() == []


@pytest.mark.parametrize("dense", [0, 2, 16])
def test_links_join_all_that_are_near(spark, monkeypatch, dense):
    monkeypatch.setattr(simhash, "DENSE", dense)
    draw = random.Random(dense)
    fps = {draw.getrandbits(64) for _ in range(300)}
    for _ in range(12):  # crowds around a centre, and chains
        centre = walk = draw.getrandbits(64)
        for _ in range(40):
            fps.add(centre ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64) ^ 1 << draw.randrange(64))
            walk ^= 1 << draw.randrange(64) ^ 1 << draw.randrange(64)
            fps.add(walk)
    rows = [(k, f) for k, f in enumerate(sorted(fps))]
    signed = [(k, f - (1 << 64) if f >> 63 else f) for k, f in rows]
    found = simhash.classes(spark.createDataFrame(signed, "doc_id long, fp long")).collect()
    by_fp = {r.fp: r.component_id for r in found}
    assert [by_fp[f] for _, f in signed] == groups_of(rows)[1]


def test_unary_counts_bound_the_distance():
    # The same arithmetic in Python: segment counts never differ by more than the bits do.
    def counts(x):
        low = 0x5555555555555555
        return (x | x >> 1) & low | ((x & x >> 1) & low) << 1

    draw = random.Random(9)
    for _ in range(2000):
        a, b = draw.getrandbits(64), draw.getrandbits(64)
        segments = sum(abs((a >> k & 3).bit_count() - (b >> k & 3).bit_count()) for k in range(0, 64, 2))
        assert (counts(a) ^ counts(b)).bit_count() == segments <= (a ^ b).bit_count()


ODD = [
    (None, [1.0, 0.0, 0.0, 0.0]), (900, None), (901, [0.0] * 4), (902, [1.0, None, 0.0, 0.0]),
    (903, [float("nan"), 1.0, 0.0, 0.0]), (904, [float("inf"), 1.0, 0.0, 0.0]), (905, [1.0, 2.0]),
    (906, []), (907, [1e-30, 0.0, 0.0, 0.0]), (908, [3e38, 0.0, 0.0, 0.0]),
]


@pytest.fixture(scope="module")
def cloud():
    """Vectors in crowds, with copies, and a chain of near ones."""
    draw = np.random.default_rng(4)
    rows = []
    for crowd in range(6):
        centre = draw.normal(size=4)
        rows += [(centre + draw.normal(size=4) * 0.1 * crowd) for _ in range(40)]
    rows += [rows[0]] * 30
    rows += [np.array([np.cos(t), np.sin(t), 0, 0]) for t in np.linspace(0, 3, 25)]
    return [(k * 2, [float(np.float32(x)) for x in r]) for k, r in enumerate(rows)]


def table(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return df.withColumns({n: F.lit(0) for n in ("shard", "kind", "copies", "cell", "part", "label")})


def test_vector_groups_against_brute_force(spark, cloud):
    found = small_world.near_duplicates(table(spark, cloud + ODD)).collect()
    assert len(found) == len(cloud) + len(ODD)
    by_id = {r.vec_id: r for r in found}
    given = cloud + [o for o in ODD if o[0] in (907, 908)]
    x = np.array([v for _, v in given], dtype=np.float64)
    x = np.array([np.float32(r) for r in x]).astype(np.float64)
    x /= np.abs(x).max(axis=1)[:, None]
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.95
    ids = [i for i, _ in given]
    roots = united(len(ids), [(i, j) for i in range(len(ids)) for j in np.flatnonzero(near[i])])
    smallest = {r: min(ids[k] for k in range(len(ids)) if roots[k] == r) for r in set(roots)}
    for k, i in enumerate(ids):
        r = by_id[i]
        assert (r.n_links, r.component_id) == (near[k].sum() - 1, smallest[roots[k]]), i
        assert r.kept == (r.vec_id == r.component_id)
    for i in (900, 901, 902, 903, 904, 905, 906):
        assert tuple(by_id[i])[1:] == (0, i, True)
    assert tuple(by_id[None])[1:] == (0, None, False)
    assert small_world.near_duplicates(table(spark, cloud).limit(0)).collect() == []


def test_repeated_vectors_are_no_links_of_themselves(spark):
    rows = [(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.01])]
    found = small_world.near_duplicates(table(spark, rows)).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]


def test_graph_finds_what_brute_force_finds():
    draw = np.random.default_rng(6)
    x = small_world.unit(draw.normal(size=(3000, 16)))
    graph = small_world.Graph(x)
    ids, sims = graph.search(x[:200].astype(np.float32), 40)
    best = np.argsort(-sims, axis=1)[:, :10]
    found = graph.order[np.take_along_axis(ids, best, axis=1)]
    true = np.argsort(-(x[:200] @ x.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, true, strict=True)]) > 0.9
    crowd = small_world.unit(np.ones((500, 16)) + draw.normal(size=(500, 16)) * 0.02)
    graph = small_world.Graph(np.concatenate([crowd, x]))
    row, _ = graph.within(crowd[:20], 0.95, 8)
    assert np.bincount(row, minlength=20).min() >= 495


def test_search_against_brute_force(spark, cloud):
    rows = cloud + ODD + [cloud[3]]
    found = multi_index.search(table(spark, rows), every=20, most=5).collect()
    given = cloud + [o for o in ODD if o[0] in (907, 908)]
    ids = np.array([i for i, _ in given])
    x = np.array([np.float32(v) for _, v in given]).astype(np.float64)
    queries = [i for i in ids if i % 20 == 0]
    hits = 0
    by_query = {}
    for r in found:
        by_query.setdefault(r.query_id, []).append(r)
    assert sorted(by_query) == queries
    for q, got in by_query.items():
        got.sort(key=lambda r: r.rank)
        k = int(np.flatnonzero(ids == q)[0])
        scores = x @ x[k]
        order = [i for i in np.lexsort((ids, -scores)) if ids[i] != q][:5]
        assert [r.rank for r in got] == [1, 2, 3, 4, 5]
        assert [(-r.score, r.vec_id) for r in got] == sorted((-r.score, r.vec_id) for r in got)
        assert all(r.vec_id != q and r.score == pytest.approx(scores[ids == r.vec_id][0]) for r in got)
        hits += len({int(ids[i]) for i in order} & {r.vec_id for r in got})
    assert hits >= 0.9 * 5 * len(queries)


def test_search_of_few(spark):
    few = table(spark, [(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 2.0])])
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in multi_index.search(few, every=20).collect()}
    assert found == {(0, 1): (20, 5.0), (0, 2): (1, 4.0), (20, 1): (0, 5.0), (20, 2): (1, 4.0)}
    assert multi_index.search(few.limit(0), every=20).collect() == []
    assert multi_index.search(few.where("vec_id = 1"), every=20).collect() == []
    one = multi_index.search(table(spark, [(0, [1.0])]), every=20).collect()
    assert one == []


def test_a_shard_without_links_is_audited_all_the_same():
    draw, ids = np.random.default_rng(2), np.arange(400)
    vectors = draw.normal(size=(400, 16))
    shard = small_world.Shard(ids, vectors, 0.95)
    for links in shard.graph.links:
        links[links >= 200] = -1  # no way leads there
    # The first that ask have no links, then each vector has a near one.
    assert len(shard.links(ids[:64] + 1000, draw.normal(size=(64, 16)))[0]) == 0
    a, b = shard.links(ids + 1000, vectors + 0.01 * draw.normal(size=vectors.shape))
    assert {(x, x - 1000) for x in a} == set(zip(a, b, strict=True)) and len(a) == 400


def test_audits_compare_until_enough_links_are_known():
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(3000, 16))
    vectors[1500:] = vectors[:1500] + 0.01 * draw.normal(size=(1500, 16))
    shard = small_world.Shard(np.arange(3000), vectors, 0.95)
    asking, node = shard.known_links(np.arange(3000))
    assert len(asking) >= small_world.AUDIT_PAIRS and (asking != node).all()


def test_full_beams_become_a_comparison_with_the_shard(monkeypatch):
    draw = np.random.default_rng(7)
    crowd = small_world.unit(np.ones((600, 16)) + draw.normal(size=(600, 16)) * 0.02)
    graph = small_world.Graph(np.concatenate([crowd, small_world.unit(draw.normal(size=(3000, 16)))]))
    widths, search = [], small_world.Graph.search

    def noted(self, queries, width):
        widths.append(width)
        return search(self, queries, width)

    monkeypatch.setattr(small_world.Graph, "search", noted)
    row, node = graph.within(crowd[:20], 0.95, 1)
    # A beam of four would cost more than comparing all 3,600 nodes.
    assert widths == [1]
    given = np.empty_like(graph.vectors)
    given[graph.order] = graph.vectors
    true = np.nonzero(crowd[:20].astype(np.float32) @ given.T >= 0.95)
    assert sorted(zip(row, node, strict=True)) == sorted(zip(*true, strict=True))


def test_tiles_compare_all_nodes(monkeypatch):
    monkeypatch.setattr(small_world, "TILE_ROWS", 7)
    monkeypatch.setattr(small_world, "TILE_NODES", 11)
    draw = np.random.default_rng(8)
    graph = small_world.Graph(small_world.unit(draw.normal(size=(100, 3))))
    queries = graph.vectors[:30]
    row, node = graph.compared(queries, 0.9)
    assert sorted(zip(row, node, strict=True)) == sorted(zip(*np.nonzero(queries @ graph.vectors.T >= 0.9), strict=True))
    assert len(graph.compared(queries, 1.1)[0]) == 0


def test_beams_take_back_what_they_marked():
    draw = np.random.default_rng(9)
    x = small_world.unit(draw.normal(size=(2000, 16)))
    graph = small_world.Graph(x)
    first = graph.search(x[:50].astype(np.float32), 24)
    assert not graph.marks.any()
    again = graph.search(x[:50].astype(np.float32), 24)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))


@pytest.mark.parametrize(("total", "cores", "shards"), [(0, 6, 1), (2_001, 6, 2), (51_282, 6, 6), (51_282, 64, 12), (4_000_001, 6, 21)])
def test_no_more_shards_than_cores_or_rows_ask_for(total, cores, shards):
    assert small_world.shards_of(total, cores) == shards
