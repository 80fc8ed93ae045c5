"""Packing of tokenised documents by shortest-pack-first over the length histogram.

A document becomes its token ids and a closing id; it is cut into full sequences and one rest.
With ``added``, as the queries and the pipeline have it, the ids are those of the library's
``Tokenizer.from_file(path).encode(text, add_special_tokens=False)``: an added token of the
vocabulary that stands in a text, such as <|endoftext|>, is its own id. Without, it is spelled out.
The histogram of piece lengths has at most ``size`` entries whatever the corpus, so it is packed
on the driver: lengths are placed longest first, each into the pattern with the most room, and a
pattern carries the number of sequences that follow it. Pieces then find their place by rank:
the r-th piece of a length takes the r-th place that the patterns keep for that length. Ranks
come from counts per (length, bucket) and a rank within the bucket, so no length, however
common, is sorted in one task.

Defined results: a null text is the empty text and yields the closing id alone; a null doc_id is
kept; repeated rows are packed as often as they stand there; an empty table gives no rows; other
columns of the input are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from berth.llm.common import record_batch, sole, stored, texts

SIZE = 2048
CLOSING_ID = 1
#: A (length, bucket) group is cut for about so many rows, and there are at most so many groups.
ROWS_PER_GROUP = 1_000
MOST_GROUPS = 200_000
#: Chunks of text in the younger of the two generations that a Python worker remembers.
MEMO = 160_000

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"
_PIECE_SCHEMA = pa.schema(
    [(n, pa.int64()) for n in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
)
_PLACED_SCHEMA = pa.schema([*_PIECE_SCHEMA, ("sequence_id", pa.int64()), ("offset", pa.int64())])

#: A blank that follows white space; elsewhere a blank always begins a new unit of the tokenizer.
_BLANK_AFTER_SPACE = regex.compile(r"[\s\x1c-\x1f] ")
#: The units of the byte-level tokenizer (a fixed pattern of its public vocabulary).
_UNITS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
#: From here on, libraries may differ in what they count as a letter; such texts go to the
#: tokenizer as they are.
_UNSURE = "\u1c80"
#: After a word these are units of their own.
_MARKS = frozenset(".,;:!?)")


def _byte_of_char() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _packed(ids: list[int]) -> bytes:
    words = array("I", ids)
    if sys.byteorder == "big":
        words.byteswap()
    return words.tobytes()


class ChunkIds(dict):
    """Chunk of text -> its ids as little-endian unsigned 32-bit bytes, filled as chunks appear.

    The tokenizer never joins what a blank parts, unless the blank follows white space. So equal
    chunks have equal ids wherever they stand, and a worker encodes each about once. What is used
    again moves to the younger generation; the older one is dropped when the younger is full."""

    def __init__(self, path: str, added: bool = False):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Where they get ids of their own, texts are split at them before.
        self.tokenizer.encode_special_tokens = True
        ids = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        special = set(ids)
        self.added = {token: _packed([i]) for token, i in ids.items()}
        self.parts = None
        if added and ids:
            # Of tokens that begin at one place the longest is taken, as in the library.
            longest = sorted(ids, key=len, reverse=True)
            self.parts = regex.compile(f"({'|'.join(map(regex.escape, longest))})")
        chars = _byte_of_char()
        ranks = {
            bytes(chars[c] for c in token): i
            for token, i in self.tokenizer.get_vocab().items()
            if token not in special
        }
        self.merge = tiktoken.Encoding(
            "bytes", pat_str=_UNITS.pattern, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe.encode_single_piece
        self.older: dict[str, bytes] = {}

    def encode(self, text: str) -> bytes:
        if text.isascii() or max(text) < _UNSURE:
            ids = [i for unit in _UNITS.findall(text) for i in self.merge(unit.encode())]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return _packed(ids)

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            if chunk.isalpha() and (chunk.isascii() or max(chunk) < _UNSURE):
                found = _packed(self.merge((" " + chunk).encode()))
            elif chunk[-1:] in _MARKS and chunk[:-1].isalpha():
                found = self[chunk[:-1]] + self.encode(chunk[-1])
            else:
                found = self.encode(" " + chunk)
        if len(chunk) < 64:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def document(self, text: str) -> bytes:
        """Ids of a text: of the added tokens that stand in it, if asked for, and of what lies
        between them."""
        if self.parts is None or not self.parts.search(text):
            return self.between(text)
        pieces = self.parts.split(text)
        return b"".join(self.added[t] if k % 2 else self.between(t) for k, t in enumerate(pieces))

    def between(self, text: str) -> bytes:
        if not text:
            return b""
        if _BLANK_AFTER_SPACE.search(text):
            return self.encode(text)
        first, *others = text.split(" ")
        return b"".join([self.encode(first) if first else b"", *map(self.__getitem__, others)])


def pieces(
    docs: DataFrame, tokenizer_path: str, size: int = SIZE, closing: int = CLOSING_ID, added: bool = False
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens), one row per piece of each document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = sole(("packing", tokenizer_path, added), lambda: ChunkIds(tokenizer_path, added))
        end = np.asarray([closing], dtype="<u4").tobytes()
        for batch in batches:
            rows: list[list] = [[], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch.column(1)), strict=True):
                ids = memoryview(memo.document(text) + end)
                total = len(ids) // 4
                for start in range(0, total, size):
                    part = ids[4 * start : 4 * (start + size)]
                    row = (doc_id, start, len(part) // 4, zlib.crc32(part), total)
                    for column, value in zip(rows, row, strict=True):
                        column.append(value)
            yield record_batch(_PIECE_SCHEMA, rows)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack_histogram(histogram: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, times), ...]) for piece counts by length.

    The open pattern with the most room is taken first. Each step ends a length or uses up a
    pattern, so there are at most two patterns for each length."""
    order = itertools.count()
    open_patterns: list[tuple[int, int, int, list[tuple[int, int]]]] = []
    done = []
    for length in sorted((n for n in histogram if histogram[n] > 0), reverse=True):
        left = histogram[length]
        while left:
            if open_patterns and -open_patterns[0][0] >= length:
                room, _, times, parts = heapq.heappop(open_patterns)
                room = -room
            else:
                room, times, parts = size, left // (size // length) or 1, []
            # As many of this length as fit, evenly over the sequences of the pattern.
            each = min(room // length, left) if times == 1 else min(room // length, max(left // times, 1))
            used = min(times, left // each)
            if used < times:
                heapq.heappush(open_patterns, (-room, next(order), times - used, parts))
            left -= used * each
            room -= each * length
            grown = (used, [*parts, (length, each)])
            if room:
                heapq.heappush(open_patterns, (-room, next(order), *grown))
            else:
                done.append(grown)
    return done + [(times, parts) for _, _, times, parts in sorted(open_patterns)]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, times, sequence base, offset), sorted: who sits where."""
    rows, taken, base = [], {}, 0
    for count, parts in patterns:
        offset = 0
        for length, times in parts:
            first = taken.get(length, 0)
            rows.append((length, first, times, base, offset))
            taken[length] = first + times * count
            offset += times * length
        base += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(
    docs: DataFrame, tokenizer_path: str, size: int = SIZE, closing: int = CLOSING_ID, added: bool = False
) -> DataFrame:
    """One row per piece with its sequence and the offset there; the columns are PLACED."""
    cut = stored(pieces(docs, tokenizer_path, size, closing, added), "pieces")
    # At most ``size`` rows, whatever the corpus.
    histogram = {r[0]: r[1] for r in cut.groupBy("length").count().collect()}
    rows = max(ROWS_PER_GROUP, sum(histogram.values()) // MOST_GROUPS)
    common = [F.lit(x) for n, c in histogram.items() if c > rows for x in (n, -(-c // rows))]
    buckets = F.coalesce(F.create_map(*common)[F.col("length")], F.lit(1)) if common else F.lit(1)
    keys = ("doc_id", "start", "ids_crc32", "doc_tokens")
    # The place in the stored file parts repeated rows; equal rows may take each other's places.
    dealt = cut.select("*", F.col("_metadata.row_index").alias("row")).withColumn(
        "bucket", F.pmod(F.xxhash64(*keys, "row"), buckets).cast("int")
    )
    in_group = Window.partitionBy("length", "bucket").orderBy(*keys)
    lower = Window.partitionBy("length").orderBy("bucket")
    # At most MOST_GROUPS and one row a length.
    sizes = (
        dealt.groupBy("length", "bucket")
        .count()
        .select("length", "bucket", (F.sum("count").over(lower) - F.col("count")).alias("before"))
    )
    ranked = (
        dealt.withColumn("place", F.row_number().over(in_group) - 1)
        .join(F.broadcast(sizes), ["length", "bucket"])
        .select(*_PIECE_SCHEMA.names, (F.col("place") + F.col("before")).alias("rank"))
    )
    table = places(pack_histogram(histogram, size))
    starts = table[:, 0] << 44 | table[:, 1]

    def seat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(n).to_numpy() for n in ("length", "rank"))
            row = table[np.searchsorted(starts, length << 44 | rank, side="right") - 1]
            turn, slot = np.divmod(rank - row[:, 1], row[:, 2])
            placed = [pa.array(row[:, 3] + turn), pa.array(row[:, 4] + slot * length)]
            yield record_batch(_PLACED_SCHEMA, [*batch.columns[:5], *placed])

    return ranked.mapInArrow(seat, PLACED)
