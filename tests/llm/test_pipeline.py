"""The pipeline's stages against their own operators and brute force, and plans."""

from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from berth.llm import quality, simhash, toxicity
from berth.llm.common import read
from berth.llm.queries import QUERIES


@pytest.fixture(scope="module")
def staged(spark, sf_dir):
    docs = [read(spark, sf_dir, "documents")]
    for name, stage in corpus_pipeline.STAGES:
        docs.append(corpus_pipeline.stored(stage(spark, docs[-1], sf_dir), name))
    return docs


def ids(df):
    return Counter(r.doc_id for r in df.select("doc_id").collect())


def test_stages_and_their_columns(staged):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "simhash", "packing"]
    for df in staged[1:-1]:
        assert df.columns == staged[0].columns
        assert df.count() > 0
    assert "sequence_id" in staged[-1].columns


def test_rejected_documents_go_and_others_stay_whole(spark, sf_dir, staged):
    labels = read(spark, sf_dir, "labels")
    for module, before, after, kept in ((toxicity, 0, 1, 0), (quality, 1, 2, 1)):
        scores = module.score(staged[before], module.fit(staged[before], labels))
        expected = Counter(r.doc_id for r in scores.collect() if r.predicted == kept)
        assert ids(staged[after]) == expected
    first = {r.doc_id: tuple(r) for r in staged[0].collect()}
    assert all(tuple(r) == first[r.doc_id] for r in staged[2].collect())


def test_one_of_each_group_stays(staged):
    rows = [(r.doc_id, simhash.fingerprint(r.text)) for r in staged[2].collect()]
    kept = ids(staged[3])
    left = {i: f for i, f in rows if i in kept}
    groups = {r.doc_id: r.component_id for r in simhash.groups(staged[2]).collect()}
    assert sorted(kept) == sorted(set(groups.values()))
    # No two of those that stay are near, and each that went is in the group of one that stays.
    fps = list(left.values())
    assert all((a ^ b).bit_count() > 2 for k, a in enumerate(fps) for b in fps[:k])
    assert all(groups[i] in kept for i, _ in rows)


def test_all_that_stays_is_packed(staged):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sizes = {r.doc_id: len(tokenizer.encode(r.text, add_special_tokens=False).ids) + 1 for r in staged[3].collect()}
    packed = Counter()
    for r in staged[4].collect():
        packed[r.doc_id] += r.length
        assert r.doc_tokens == sizes[r.doc_id]
    assert packed == sizes


def test_run_does_the_same(spark, sf_dir, staged):
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == sorted(
        map(tuple, staged[-1].collect())
    )


@pytest.mark.parametrize("name", ["op3_chat", "op9_url_filter"])
def test_native_plans(name, spark, sf_dir):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for node in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert node not in plan
    if name == "op9_url_filter":
        assert "Join" not in plan and "Exchange" not in plan
