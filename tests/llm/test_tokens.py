"""Packing and the piece codec, against the libraries."""

from __future__ import annotations

import hashlib
import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from cases import LONG, TEXTS, docs
from tokenizers import Tokenizer

from berth.llm import packing, pieces
from berth.llm.queries import QUERIES

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "B", "th", "é", "ß", "1", "½", "²", "'s", " ", "  ", "\n", "\t", "\x1c", "\x85", " ",
         "漢", "龘", "'", "!", "...", "<|endoftext|>", "<s>", "<0x41>", "😀", "̈", "▁", "\x00", " the"]


@pytest.fixture(scope="module")
def byte_bpe():
    own = Tokenizer.from_file(BYTE_BPE)
    own.encode_special_tokens = True
    return own


@pytest.fixture(scope="module")
def piece_bpe():
    return sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE)


def mixtures(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(PARTS) for _ in range(draw.randint(0, 14))) for _ in range(n)]


def test_chunk_ids_are_the_tokenizers(byte_bpe):
    memo = packing.ChunkIds(BYTE_BPE)
    for text in [t or "" for _, t in TEXTS] + mixtures(3000, 5):
        ids = byte_bpe.encode(text, add_special_tokens=False).ids
        assert memo.document(text) == np.array(ids, "<u4").tobytes(), repr(text)


def test_small_memos_forget_without_harm(byte_bpe, monkeypatch):
    monkeypatch.setattr(packing, "MEMO", 3)
    memo = packing.ChunkIds(BYTE_BPE)
    assert memo.document(LONG) == np.array(byte_bpe.encode(LONG).ids, "<u4").tobytes()


def test_added_tokens_get_their_own_ids():
    plain, memo = Tokenizer.from_file(BYTE_BPE), packing.ChunkIds(BYTE_BPE, added=True)
    end = "<|endoftext|>"
    odd = [end, end * 2, f"a {end} b", f"a  {end}  b", f"漢{end}\n{end}!", "<|endoftext", f" {end[:-1]}{end}"]
    for text in odd + mixtures(3000, 7):
        ids = plain.encode(text, add_special_tokens=False).ids
        assert memo.document(text) == np.array(ids, "<u4").tobytes(), repr(text)
    assert plain.encode(end, add_special_tokens=False).ids == [50256]


def test_the_query_packs_added_tokens_as_the_library_does(spark, tmp_path):
    texts = ["a<|endoftext|>b", "one two", "<|endoftext|>"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows.write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id: (r.ids_crc32, r.doc_tokens) for r in QUERIES["op5_packing"](spark, str(tmp_path)).collect()}
    plain = Tokenizer.from_file(BYTE_BPE)
    for k, text in enumerate(texts):
        ids = [*plain.encode(text, add_special_tokens=False).ids, 1]
        assert found[k] == (zlib.crc32(np.array(ids, "<u4").tobytes()), len(ids))


def test_histogram_packs_all_with_little_padding():
    draw = random.Random(3)
    histogram = Counter(draw.randint(1, 2048) for _ in range(3000)) + Counter({2048: 500, 7: 900})
    patterns = packing.pack_histogram(dict(histogram))
    used = Counter()
    for count, parts in patterns:
        assert sum(n * k for n, k in parts) <= 2048
        for n, k in parts:
            used[n] += count * k
    assert used == histogram
    filled = sum(n * c for n, c in histogram.items())
    assert filled / (2048 * sum(c for c, _ in patterns)) > 0.97
    assert len(patterns) <= 2 * len(histogram)


@pytest.mark.parametrize("size", [16, 2048])
def test_pack_edges(spark, byte_bpe, size):
    rows = packing.pack(docs(spark), BYTE_BPE, size).collect()
    expected = Counter()
    for doc_id, text in TEXTS:
        ids = [*byte_bpe.encode(text or "", add_special_tokens=False).ids, 1]
        for start in range(0, len(ids), size):
            part = np.array(ids[start : start + size], "<u4").tobytes()
            expected[doc_id, start, len(part) // 4, zlib.crc32(part), len(ids)] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    seats = defaultdict(list)
    for r in rows:
        seats[r.sequence_id].append((r.offset, r.length))
    for parts in seats.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    assert sorted(seats) == list(range(len(seats)))


def test_pack_nothing(spark):
    assert packing.pack(docs(spark).limit(0), BYTE_BPE).collect() == []


def test_common_lengths_are_ranked_in_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "ROWS_PER_GROUP", 5)
    rows = packing.pack(docs(spark, [(i % 3, "same text") for i in range(200)]), BYTE_BPE).collect()
    assert len({(r.sequence_id, r.offset) for r in rows}) == 200


def test_pieces_are_the_librarys(piece_bpe):
    own = pieces.model(PIECE_BPE)
    memo = pieces.UnitMemo(own)
    for text in [t or "" for _, t in TEXTS] + mixtures(3000, 6):
        ids = piece_bpe.encode(text)
        joined, count, decoded = memo.document(text)
        assert own.encode(text) == ids, repr(text)
        assert (joined, count) == (",".join(map(str, ids)), len(ids)), repr(text)
        assert decoded == own.decode(ids) == piece_bpe.decode(ids), repr(text)


def test_each_unit_of_many_is_encoded_once(monkeypatch):
    own = pieces.model(PIECE_BPE)
    memo, calls, plain = pieces.UnitMemo(own), Counter(), own.segment
    monkeypatch.setattr(own, "segment", lambda unit: calls.update([unit]) or plain(unit))
    letters = "bcdfghjklmnpqrstvwxz"
    words = ["".join(w) for w in itertools.islice(itertools.product(letters, repeat=5), 300_000)]
    found = [memo.document(" ".join(words)) for _ in range(2)]
    assert found[0] == found[1]
    assert len(calls) > 250_000 and set(calls.values()) == {1}


def test_small_unit_memos_forget_without_harm(piece_bpe, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 3)
    monkeypatch.setattr(pieces, "KEPT", 12)
    memo = pieces.UnitMemo(pieces.model(PIECE_BPE))
    for text in [t or "" for _, t in TEXTS] + mixtures(2000, 9):
        ids = piece_bpe.encode(text)
        names, count, decoded = memo.document(text)
        assert (names, count, decoded) == (",".join(map(str, ids)), len(ids), piece_bpe.decode(ids)), repr(text)


def test_any_ids_decode_as_in_the_library(piece_bpe):
    own, draw = pieces.model(PIECE_BPE), random.Random(4)
    for _ in range(2000):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(300)]) for _ in range(draw.randint(0, 8))]
        assert own.decode(ids) == piece_bpe.decode(ids), ids


def test_pairs_fit_as_merging_says():
    own, draw = pieces.model(PIECE_BPE), random.Random(8)
    plain = [i for i in own.edges if not own.text[i].startswith("▁▁")]
    for _ in range(3000):
        a, b = draw.choice(plain), draw.choice(plain)
        if own.text[b].startswith("▁"):
            continue
        both = [own.text[a], own.text[b]]
        assert own.fits(a, b) == (own.merged("".join(both)) == both), both


def test_digests_edges(spark, piece_bpe):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    expected = Counter()
    for doc_id, text in TEXTS:
        ids = piece_bpe.encode(text or "")
        expected[doc_id, len(ids), sha(",".join(map(str, ids))), sha(piece_bpe.decode(ids))] += 1
    assert Counter(tuple(r) for r in pieces.digests(docs(spark), PIECE_BPE).collect()) == expected
    assert pieces.digests(docs(spark).limit(0), PIECE_BPE).collect() == []


def test_round_trip(spark):
    given = docs(spark, [(i, t) for i, t in TEXTS if t and "▁" not in t])
    back = pieces.decoded(pieces.encoded(given, PIECE_BPE), PIECE_BPE)
    assert Counter(tuple(r) for r in back.collect()) == Counter(
        tuple(r) for r in given.select("doc_id", "text").collect()
    )
