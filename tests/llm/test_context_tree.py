"""Context-tree weighting against plain recursion over dictionaries, and the scores of texts."""

from __future__ import annotations

import math
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import TEXTS, docs
from test_matrix import plain_words

from berth.llm import context_tree as ct


class Plain:
    """Weighted context trees of words and how often each stood in training."""

    def __init__(self, counts):
        self.seen = defaultdict(lambda: [0, 0])
        self.longer = defaultdict(set)
        for word, n in counts.items():
            for context, byte in self.steps(word):
                for node, bit in self.path(byte):
                    for depth in range(ct.DEPTH + 1):
                        self.seen[node, context[:depth]][bit] += n
                        if depth:
                            self.longer[node, context[: depth - 1]].add(context[:depth])
        self.weights = {}

    @staticmethod
    def steps(word):
        raw = word.encode() + (b"" if word == ct.END else b" ")
        for i, byte in enumerate(raw):
            yield (raw[:i][::-1] + b" " * ct.DEPTH)[: ct.DEPTH], byte

    @staticmethod
    def path(byte):
        node = 1
        for k in range(7, -1, -1):
            bit = byte >> k & 1
            yield node, bit
            node = node * 2 + bit

    def own(self, node, context):
        a, b = self.seen.get((node, context), (0, 0))
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def below(self, node, context):
        return sum(self.weight(node, c) for c in self.longer.get((node, context), ()))

    def weight(self, node, context):
        if (node, context) not in self.weights:
            own = self.own(node, context)
            if len(context) < ct.DEPTH:
                own = np.logaddexp(own, self.below(node, context)) - math.log(2)
            self.weights[node, context] = own
        return self.weights[node, context]

    def one(self, node, context, depth=0, guess=0.5):
        """Probability of a one behind the context, from this depth on."""
        part = context[:depth]
        a, b = self.seen.get((node, part), (0, 0))
        if a + b:
            guess = (b + 0.5) / (a + b + 1)
        if depth == ct.DEPTH:
            return guess
        own = self.own(node, part)
        share = math.exp(own - np.logaddexp(own, self.below(node, part)))
        return share * guess + (1 - share) * self.one(node, context, depth + 1, guess)

    def bits(self, word):
        found = 0.0
        for context, byte in self.steps(word):
            for node, bit in self.path(byte):
                one = self.one(node, context)
                found -= math.log2(one if bit else 1 - one)
        return found

    def byte(self, context, byte):
        found = 1.0
        for node, bit in self.path(byte):
            one = self.one(node, context)
            found *= one if bit else 1 - one
        return found


WORDS = {
    "the": 50, "then": 7, "thesis": 3, "a": 40, "banana": 5, "bandana": 2, "ñandú": 4, "漢字漢字": 2,
    "x" * 40: 3, "unseen": 0, "thus": 0, "\x00\x1f": 1, ct.END: 30, "bananas": 0,
}


def test_gamma():
    x = np.concatenate([np.arange(1, 400) / 2, [1e3, 1e6, 1e12]])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-13, atol=1e-12)


def test_grams_are_the_bytes_behind_their_contexts():
    words = ["ab", ct.END, "漢", "c"]
    codes, word = ct.grams_of(pa.array(words))
    found = [(int(w), int(c).to_bytes(ct.DEPTH + 1, "big")) for c, w in zip(codes, word, strict=True)]
    expected = [(i, c + bytes([b])) for i, w in enumerate(words) for c, b in Plain.steps(w)]
    assert found == expected


def test_grams_are_learned_and_looked_up_in_order():
    draw = np.random.default_rng(3)
    codes = draw.integers(0, 1 << 8 * (ct.DEPTH + 1), 500)[draw.integers(0, 500, 20_000)]
    learn = draw.integers(0, 2, len(codes))
    grams, n = ct.learned(codes, learn)
    expected = ct.added_up(codes, learn)
    assert np.array_equal(grams, expected[0]) and np.array_equal(n, expected[1])
    values = draw.random(len(grams))
    assert np.array_equal(ct.values_of(codes, grams, values), values[np.searchsorted(grams, codes)])
    assert [len(a) for a in ct.learned(codes[:0], learn[:0])] == [0, 0]


@pytest.mark.parametrize("at_once", [7, 20, 1 << 20])
def test_pieces_of_texts_are_all_their_grams(monkeypatch, at_once):
    monkeypatch.setattr(ct, "BYTES_AT_ONCE", at_once)
    said = [b"\n", "漢 ab \n".encode(), b"a long word \n", b"\n"]
    texts = ct.Texts(pa.array([ct._CODEC.compress(t, asbytes=True) for t in said]), np.array([len(t) for t in said]))
    found = [[] for _ in said]
    for code, text, first in texts.pieces():
        for k, part in zip(text, np.split(code, first[1:]), strict=True):
            found[k] += [int(c).to_bytes(ct.DEPTH + 1, "big") for c in part]
    padded = [b" " * ct.DEPTH + t for t in said]
    whole = [[p[i : i + ct.DEPTH][::-1] + p[i + ct.DEPTH :][:1] for i in range(len(p) - ct.DEPTH)] for p in padded]
    assert found == whole


def test_a_shard_takes_little_time_a_byte():
    draw = np.random.default_rng(5)
    alphabet = np.frombuffer(b"etaoin shrdlu ", dtype=np.uint8)
    said = alphabet[draw.integers(0, len(alphabet), 4 << 20)].tobytes()
    texts = ct.Texts(pa.array([ct._CODEC.compress(said, asbytes=True)]), np.array([len(said)]))
    (codes, *_), *_ = texts.pieces()
    learn = np.ones(len(codes), dtype=np.int64)
    grams = np.unique(np.concatenate([c for c, *_ in texts.pieces()]))
    values = draw.random(len(grams))

    def took(work):
        spent = []
        for _ in range(3):
            begun = time.process_time()
            work()
            spent.append(time.process_time() - begun)
        return min(spent)

    plain = took(lambda: values[np.searchsorted(grams, codes)]) + took(lambda: ct.added_up(codes, learn))
    assert took(lambda: ct.values_of(codes, grams, values)) + took(lambda: ct.learned(codes, learn)) < 0.8 * plain


def test_plain_probabilities_of_the_next_byte_add_to_one():
    plain = Plain(WORDS)
    for context in (b"     ", b"eht  ", b"zzzzz"):
        assert math.isclose(sum(plain.byte(context, b) for b in range(256)), 1.0)


@pytest.mark.parametrize("counts", [WORDS, dict.fromkeys(WORDS, 0)])
@pytest.mark.parametrize("at_once", [1, 100_000])
def test_code_lengths_are_those_of_plain_trees(spark, monkeypatch, counts, at_once):
    monkeypatch.setattr(ct, "ROWS_AT_ONCE", at_once)
    monkeypatch.setattr(ct, "WORDS_AT_ONCE", 3 if at_once == 1 else 200_000)
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    bits = ct.code_lengths(ct.count_grams(words))
    found = {r.word: (r.n, r.bits) for r in ct.word_bits(words, bits).collect()}
    plain = Plain(counts)
    assert found.keys() == counts.keys()
    for word, (n, cost) in found.items():
        assert n == counts[word]
        assert math.isclose(cost, plain.bits(word), rel_tol=1e-9)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_scores(rows):
    held = {i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows}
    said = [(i, [*plain_words(lowered(t)), ct.END]) for i, t in rows]
    counts = Counter({w: 0 for _, words in said for w in words})
    for i, words in said:
        if i is not None and not held[i]:
            counts.update(words)
    n, v = sum(counts.values()), sum(c > 0 for c in counts.values())
    plain = Plain(counts)
    cost = {w: plain.bits(w) for w in counts}
    out = []
    for i, words in said:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        score = -sum(cost[w] for w in words) * math.log10(2)
        out.append((i, held[i], len(words), sum(counts[w] > 0 for w in words), n, base, score))
    return sorted(out, key=str)


def test_scores_of_texts(spark):
    rows = [*TEXTS, *((k, f"Held out text number {k} is read") for k in range(20, 40))]
    found = ct.score(docs(spark, rows)).collect()
    expected = plain_scores(rows)
    got = sorted((tuple(r)[:7] for r in found), key=str)
    assert [g[:5] for g in got] == [e[:5] for e in expected]
    assert any(g[1] for g in got)
    for g, e in zip(got, expected, strict=True):
        assert g[5:] == pytest.approx(e[5:], rel=1e-9)
    for r in found:
        assert r.bits_per_byte == pytest.approx(-r.score / math.log10(2) / r.n_bytes)


class PlainText(Plain):
    """The same of whole texts: a byte's context reaches back across words."""

    @staticmethod
    def steps(words):
        raw = b"".join(w.encode() + (b"" if w == ct.END else b" ") for w in words)
        for i, byte in enumerate(raw):
            yield (raw[:i][::-1][: ct.DEPTH] + b" " * ct.DEPTH)[: ct.DEPTH], byte


@pytest.mark.parametrize("at_once", [7, 1 << 20])
def test_contexts_reach_across_words(spark, monkeypatch, at_once):
    monkeypatch.setattr(ct, "BYTES_AT_ONCE", at_once)
    monkeypatch.setattr(ct, "SHARDS_A_RANGE", 1 if at_once == 7 else 4)
    kept = [(i, t[:300] if t else t) for i, t in TEXTS[:12]]
    rows = [*kept, (None, "not taught"), (91, None), *((k, f"Held out text number {k} is read") for k in range(20, 40))]
    counts = Counter()
    for i, t in rows:
        words = (*plain_words(lowered(t)), ct.END)
        counts[words] += i is not None and zlib.crc32(str(i).encode()) % 7 != 2
    plain = PlainText(counts)
    expected = [(i, -plain.bits((*plain_words(lowered(t)), ct.END)) * math.log10(2)) for i, t in rows]
    found = ct.score(docs(spark, rows), across=True).collect()
    base = {tuple(r)[:6] + (r.n_bytes,) for r in ct.score(docs(spark, rows)).collect()}
    assert {tuple(r)[:6] + (r.n_bytes,) for r in found} == base
    got = sorted(((r.doc_id, r.score) for r in found), key=str)
    for g, e in zip(got, sorted(expected, key=str), strict=True):
        assert g[0] == e[0] and g[1] == pytest.approx(e[1], rel=1e-9)
    assert ct.score(docs(spark, TEXTS[:0]), across=True).collect() == []


def test_shards_with_texts_take_little_disk(spark, monkeypatch):
    written = []
    plain = ct.matrix.stored

    def noted(df, label, *codec):
        written.append((label, plain(df, label, *codec)))
        return written[-1][1]

    monkeypatch.setattr(ct.matrix, "stored", noted)
    rows = [(k, " ".join(f"word{k * 37 % 1000 + n}" for n in range(200))) for k in range(60)]
    assert ct.score(docs(spark, rows), across=True).count() == 60
    (shards,) = (df for label, df in written if label == "shards")
    files = [f for f in shards.inputFiles() if f.endswith(".parquet")]
    assert files and all(".zstd." in f for f in files)


def test_scores_without_training_texts(spark):
    assert ct.score(docs(spark, TEXTS[:0])).collect() == []
    (row,) = ct.score(docs(spark, [(None, "one word")])).collect()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (False, 3, 0, 0)
    assert row.base_score == 0
    assert row.bits_per_byte == pytest.approx(8)


def test_held_out_texts_cost_far_less_than_their_bytes_alone(spark, sf_dir):
    found = ct.score(spark.read.parquet(f"{sf_dir}/documents.parquet")).where("held_out")
    cost, size = found.selectExpr("sum(bits_per_byte * n_bytes)", "sum(n_bytes)").first()
    assert cost / size < 2.5  # some 4.2 by the frequencies of single bytes
