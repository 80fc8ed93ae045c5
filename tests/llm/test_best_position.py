"""The ranked search against scoring every document."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from cases import TEXTS, docs

from berth.llm import best_position as bp


def plain_terms(text):
    out, run = [], ""
    for c in (text or "") + " ":
        c = chr(ord(c) + 32) if "A" <= c <= "Z" else c
        if "0" <= c <= "9" or "a" <= c <= "z" or ord(c) >= 128:
            run += c
        elif run:
            out.append(run)
            run = ""
    return out


def plain_search(rows, items, k=10):
    said = [(i, Counter(plain_terms(t))) for i, t in rows]
    said = [(i, c) for i, c in said if c]
    n_docs, length = len(said), sum(sum(c.values()) for _, c in said)
    df = Counter(t for _, c in said for t in c)
    out = []
    for item, text in items:
        asked = Counter(plain_terms(text))
        scored = []
        for i, counts in said:
            n = sum(counts.values())
            m = 100 - 75 + (75 * n * n_docs) // length
            score = 0
            for t, times in asked.items():
                if t in counts:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
            if score > 0:
                scored.append((-score, i is None, i if i is not None else 0, i, score))
        for rank, (*_, i, score) in enumerate(sorted(scored, key=lambda s: s[:3])[:k], 1):
            out.append((item, rank, i, score))
    return sorted(out, key=str)


def found(spark, df, items, **options):
    rows = bp.search(df, spark.createDataFrame(items, "item_id long, text string"), **options).collect()
    return sorted((tuple(r) for r in rows), key=str)


def corpus(n, seed):
    """Texts of common and rare words, with groups of equal texts."""
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = []
    for i in range(n):
        if i % 4 == 3:
            rows.append((i, rows[draw.randrange(len(rows))][1]))
        else:
            rows.append((i, " ".join(draw.choices(words, weights, k=draw.randint(1, 80)))))
    items = [(q, " ".join(draw.choices(words, weights, k=draw.randint(1, 30)))) for q in range(25)]
    items += [(100 + q, rows[draw.randrange(n)][1]) for q in range(10)]
    draw.shuffle(rows)
    return rows, items


@pytest.mark.parametrize(("postings", "block", "item_bytes"), [(1, 1, 1 << 20), (300, 2, 500), (10**6, 32, 1 << 20)])
def test_as_by_scoring_all(spark, monkeypatch, postings, block, item_bytes):
    monkeypatch.setattr(bp, "SHARD_POSTINGS", postings)
    monkeypatch.setattr(bp, "FIRST_BLOCK", block)
    monkeypatch.setattr(bp, "ITEM_BYTES", item_bytes)
    rows, items = corpus(400, postings)
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(spark, df, items) == plain_search(rows, items)


def test_ties_of_copies_come_by_id(spark):
    rows = [(i, "same words here") for i in range(40, 0, -1)] + [(50, "other text"), (51, "more others")]
    items = [(1, "same words"), (2, "other others other"), (3, "none of these is there: zzz"), (4, None), (5, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = found(spark, df, items)
    assert got == plain_search(rows, items)
    assert [r[2] for r in sorted(got) if r[0] == 1] == list(range(1, 11))


def test_odd_texts_and_names(spark):
    items = [(1, "cat mat moon THE"), (1, "mit license"), (None, "brown fox"), (7, "漢字 mixed endoftext 12³")]
    df = docs(spark).withColumnRenamed("rank", "item").repartition(2)
    assert found(spark, df, items) == plain_search(TEXTS, items)
    assert found(spark, docs(spark, TEXTS[:0]), items) == []
    assert found(spark, docs(spark, [(1, None), (2, "...")]), items) == []
    assert found(spark, df, items[:0]) == []


def test_words_are_as_the_contract_has_them():
    for _, text in TEXTS:
        assert [w.decode() for w in bp.words_of(text or "")] == plain_terms(text)
