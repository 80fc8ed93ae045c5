"""The sparse matrix and the filter audit against plain counting."""

from __future__ import annotations

import itertools
from collections import Counter

import pyarrow as pa
import pytest
from cases import LONG, docs, labels
from pyspark.sql import functions as F

from berth.llm import filter_audit, matrix

SPACE = " \t\n\x0b\x0c\r"


def plain_words(text):
    for c in SPACE[1:]:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_audit(rows, marks):
    """rows: (doc_id, text, source); marks: doc_id -> (good, toxic)."""
    fails = []
    for doc_id, text, source in rows:
        text = text or ""
        words = plain_words(text)
        failed = set()
        if len(words) < 200:
            failed.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            failed.add("B")
        if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text):
            failed.add("C")
        if any(c in "#$%&*|" for c in text):
            failed.add("D")
        if doc_id is not None and any(
            i is not None and i < doc_id and (t or "") == text for i, t, _ in rows
        ):
            failed.add("E")
        fails.append((source or "", failed, *marks.get(doc_id, (0, 0))))
    found = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                failing = [f for f in own if name in f[1]]
                found[part, "".join(order), step] = [
                    len(left), len(gone), len(failing) - len(gone),
                    sum(f[1] == {name} for f in own),
                    sum(f[2] for f in gone), sum(f[3] for f in gone),
                ]
    shares = Counter()
    for (part, order, step), row in found.items():
        shares[part, order[step - 1]] += row[1]
    return {k: (*row, shares[k[0], k[1][k[2] - 1]]) for k, row in found.items()}


ROWS = [
    (1, "one two " * 150, "a"),
    (2, "one two " * 150, "b"),
    (3, "one two " * 150, None),
    (3, "one two " * 150, "a"),
    (None, "one two " * 150, "a"),
    (4, None, "a"),
    (5, "", ""),
    (6, " ".join(f"w{i}" for i in range(300)), "a"),
    (7, " ".join(f"W{i}" for i in range(300)) + " #", "b"),
    (8, " ".join(f"w{i % 100}" for i in range(200)), "b"),
    (9, " ".join(f"w{i % 99}" for i in range(199)) + " x\x1fy", "b"),
    (10, LONG, "a"),
    (11, "漢字 " * 250 + "A|B", "c"),
    (-1, LONG, "c"),
]
MARKS = [(1, 1, 0), (2, 1, 1), (6, 1, 0), (6, 0, 1), (7, None, 1), (10, 1, 1), (None, 1, 1)]


def audited(spark, rows, **more):
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for name, value in more.items():
        df = df.withColumn(name, F.lit(value))
    found = filter_audit.audit(df, labels(spark, MARKS))
    return {
        (r.part, r.filter_order, r.step): (
            r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley,
        )
        for r in found.collect()
    }


def test_audit_is_as_counted_plainly(spark):
    marks = {1: (1, 0), 2: (1, 1), 6: (1, 1), 7: (0, 1), 10: (1, 1)}
    expected = plain_audit(ROWS, marks)
    found = audited(spark, ROWS, n=1, part="x", id=7, word="w", n_words=0, digest="d", failed=3, row=1)
    assert found == expected
    assert len(found) == 600 * 4  # a, b, c and the part without a name


def test_audit_of_few_rows(spark):
    assert audited(spark, ROWS[:0]) == {}
    assert audited(spark, [(None, None, None)]) == plain_audit([(None, None, None)], {})


@pytest.mark.parametrize("size", [1, 150, 1 << 20])
def test_rows_over_the_dictionary_are_the_words(spark, monkeypatch, size):
    monkeypatch.setattr(matrix, "SHARD_BYTES", size)
    given = docs(spark)
    shards = matrix.encode(given.select("doc_id", "rank", "text"), lower=True)
    lists = matrix.numbered(shards)
    named = {r.id: (r.word, r.n) for r in matrix.dictionary(lists).collect()}
    assert sorted(named) == list(range(len(named)))
    counted = Counter()
    texts = sorted((r.doc_id if r.doc_id is not None else -1, r.text or "") for r in given.collect())
    for _, text in texts:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        counted.update(plain_words(lowered))
    assert dict(named.values()) == dict(counted)
    rows = []
    for r in matrix.csr(shards, lists).collect():
        for k, row in enumerate(r.rows):
            ids, counts = (c[r.starts[k] : r.starts[k + 1]] for c in (r.ids, r.counts))
            assert ids == sorted(set(ids))
            key = row.doc_id if row.doc_id is not None else -1
            rows.append((key, sorted((named[i][0], n) for i, n in zip(ids, counts, strict=True))))
    expected = []
    for key, text in texts:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        expected.append((key, sorted(Counter(plain_words(lowered)).items())))
    assert sorted(rows) == sorted(expected)


def test_only_counted_rows_count(spark):
    given = spark.createDataFrame(
        [("a b a", True), ("a c", False), (None, True)], "text string, learn boolean"
    )
    shards = matrix.encode(given, counted="learn", closing="\n")
    found = {r.word: r.n for r in matrix.dictionary(matrix.numbered(shards)).collect()}
    assert found == {"a": 2, "b": 1, "c": 0, "\n": 2}


def test_shards_hold_all_rows_in_order_and_keep_to_their_size(monkeypatch):
    monkeypatch.setattr(matrix, "SHARD_BYTES", 10)
    texts = ["", "abc", None, "x" * 30, "four", "five5", "sixsix6", "", "y" * 10, "z", ""]
    for size in (1, 2, 3, 11):
        batches = [pa.record_batch({"text": pa.array(texts[i : i + size], pa.string())}) for i in range(0, 11, size)]
        out = [b.column("text").to_pylist() for b in matrix.sized(iter(batches))]
        assert sum(out, []) == texts
        assert all(len(b) == 1 or sum(len(t or "") for t in b) <= 10 for b in out)


def test_words_are_cut_at_the_six_blanks_only():
    text = pa.array([" a\x1cb \x1f\u3000c\x0b\x0cD\td ", "", "\n", "É\x85é d"]).slice(0)
    for lower in (False, True):
        words, starts, slots, counts = matrix.count_words(text, lower, "\n")
        found = [
            {words[int(s)].as_py(): int(n) for s, n in zip(slots[a:b], counts[a:b], strict=True)}
            for a, b in zip(starts, starts[1:], strict=False)
        ]
        expected = [
            Counter([*plain_words(t.replace("D", "d") if lower else t), "\n"]) for t in text.to_pylist()
        ]
        assert found == [dict(e) for e in expected]
