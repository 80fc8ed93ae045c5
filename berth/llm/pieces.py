"""SentencePiece encoding of merge-type models by backtracking, and decoding.

A merge-type (BPE) encoding is the one segmentation whose neighbours are all compatible: merging
the text of two neighbours anew gives the same two pieces. So the encoder walks the text with the
longest piece at each position (found by an Aho-Corasick automaton), steps to a shorter one when
the pair with the piece before is not compatible, steps back when none is left, and marks
positions that failed in a bitfield so that none is tried twice. Compatibility is decided by
re-merging the pair and remembered.

No piece has a blank mark behind another character, so a text falls into units that begin with
blank marks; equal units have equal ids, and a worker encodes each about once.

Defined results: a null text is the empty text and has no ids; a null doc_id is kept; repeated
rows give repeated rows; other columns are ignored. Texts of any length are encoded whole.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm.common import record_batch, sole, texts

BLANK = "▁"
NEVER = float("-inf")
#: Units that a Python worker remembers in each of two generations, and pairs of pieces.
MEMO = 400_000
PAIRS = 200_000
#: Characters of a unit's ids up to which it is remembered; 400,000 short units take some 270 MB.
KEPT = 128

_RUNS = re.compile(r"[^\W\d_]+|[\W\d_]+")
_UNIT = re.compile(f"{BLANK}+[^{BLANK}]*")
_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class PieceModel:
    """The pieces of a merge-type model with bytes for unknown characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.text: list[str] = []
        self.raw: dict[int, int] = {}
        self.id_of: dict[str, int] = {}
        self.score: dict[str, float] = {}
        self.byte_id: dict[int, int] = {}
        self.silent: set[int] = set()
        self.unknown = model.unk_id()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.text.append(piece)
            if model.is_byte(i):
                self.raw[i] = int(piece[3:5], 16)
                self.byte_id[self.raw[i]] = i
            elif model.is_control(i):
                self.silent.add(i)
            elif not model.is_unknown(i):
                self.id_of[piece] = i
                self.score[piece] = model.get_score(i)
        letters = {c for piece in self.id_of for c in piece}
        if len(self.byte_id) != 256 or not letters <= self.id_of.keys():
            raise ValueError("the model needs byte pieces and a piece for each single character")
        if any(BLANK in piece.lstrip(BLANK) for piece in self.id_of):
            raise ValueError("a piece has a blank mark behind another character")
        self.letters = letters
        #: Neighbouring characters that some piece holds; between others nothing ever merges.
        self.joined = {pair for piece in self.id_of for pair in zip(piece, piece[1:], strict=False)}
        special = [*self.raw, *self.silent, self.unknown]
        self.first_plain = max(special) + 1 if max(special) < min(self.id_of.values()) else len(self.text)
        #: Per piece, how its own text merges along its left and its right edge: the parts that
        #: touch the edge, in order, each with the score of the merge that ends it. A piece whose
        #: text merges to something else never comes out of an encoding and is left out.
        self.edges: dict[int, tuple[list[tuple[str, float]], list[tuple[str, float]]]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            steps: list[tuple[str, str]] = []
            if self.merged(piece, steps) == [piece]:
                children = {left + right: (left, right) for left, right in steps}
                self.edges[i] = (self.edge(piece, children, 0), self.edge(piece, children, 1))
                self.automaton.add_word(piece, i)
        self.automaton.make_automaton()
        self.lengths = [len(piece) for piece in self.text]
        self.names = [str(i) for i in range(len(self.text))]
        #: The longest of the automaton's pieces that a piece begins with, itself apart, or -1.
        self.shorter = [-1] * len(self.text)
        for i in self.edges:
            piece = self.text[i]
            starts = (self.id_of.get(piece[:n], -1) for n in range(len(piece) - 1, 0, -1))
            self.shorter[i] = next((j for j in starts if j in self.edges), -1)
        self.pairs: dict[int, bool] = {}

    def edge(self, piece: str, children: dict, side: int) -> list[tuple[str, float]]:
        ends, parts = NEVER, []
        while piece in children:
            parts.append((piece, ends))
            ends, piece = self.score[piece], children[piece][side]
        return [(piece, ends), *parts[::-1]]

    def merged(self, text: str, steps: list[tuple[str, str]] | None = None) -> list[str]:
        """Plain merging: the best-scored pair first, the leftmost of equals. The merges are
        added to ``steps``."""
        parts: list[str | None] = list(text)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            right = after[left]
            if right < len(parts):
                joined = parts[left] + parts[right]
                if joined in self.score:
                    heapq.heappush(heap, (-self.score[joined], left, joined))

        for left in range(len(parts) - 1):
            offer(left)
        while heap:
            _, left, joined = heapq.heappop(heap)
            right = after[left]
            if parts[left] is None or right >= len(parts) or parts[left] + parts[right] != joined:
                continue
            if steps is not None:
                steps.append((parts[left], parts[right]))
            parts[left], parts[right] = joined, None
            after[left] = after[right]
            if after[left] < len(parts):
                before[after[left]] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        return [p for p in parts if p is not None]

    def fits(self, left: int, right: int) -> bool:
        """Whether the two pieces stay as they are when their text is merged anew.

        Only merges across the border can differ, so the two touching edges are merged again in
        step: if a pair across the border comes before the next merge of either edge, the pieces
        are not compatible. Of equal scores the left one goes first."""
        ours, theirs = self.edges[left][1], self.edges[right][0]
        k = m = 0
        while True:
            (part, ends), (other, other_ends) = ours[k], theirs[m]
            across = self.score.get(part + other)
            if across is not None and across > ends and across >= other_ends:
                return False
            if ends == other_ends == NEVER:
                return True
            if ends >= other_ends:
                k += 1
            else:
                m += 1

    def segment(self, text: str) -> list[int]:
        """Ids of a text of known characters, by backtracking over longest matches."""
        end, lengths, shorter, pairs = len(text), self.lengths, self.shorter, self.pairs
        # Of matches that start together, the longest one ends last.
        longest = [-1] * (end + 1)
        for last, i in self.automaton.iter(text):
            longest[last + 1 - lengths[i]] = i
        if len(pairs) >= PAIRS:
            pairs.clear()
        ids: list[int] = []
        failed = bytearray(end + 1)
        at, left, i = 0, -1, longest[0]
        while at < end:
            # What fails is not tried again: the text before a position has one encoding only, so a
            # position that is reached again would be reached behind the same piece.
            while i >= 0:
                if not failed[at + lengths[i]]:
                    if left < 0:
                        break
                    key = left << 32 | i
                    known = pairs.get(key)
                    if known is None:
                        known = pairs[key] = self.fits(left, i)
                    if known:
                        break
                i = shorter[i]
            if i >= 0:
                ids.append(i)
                at += lengths[i]
                left, i = i, longest[at]
                continue
            failed[at] = 1
            if not ids:
                raise ValueError(f"no pieces for {text!r}")
            i = ids.pop()
            at -= lengths[i]
            left, i = (ids[-1] if ids else -1), shorter[i]
        return ids

    def bytes_of(self, text: str) -> list[int]:
        return [self.byte_id[b] for b in text.encode()]

    def encode_unit(self, unit: str) -> list[int]:
        """Ids of a unit; characters without a piece become bytes and part their neighbours."""
        if BLANK * 2 in unit:
            # Runs of blank marks share one score, so only the order of merging decides.
            return [
                i
                for part in self.merged(unit)
                for i in ([self.id_of[part]] if part in self.id_of else self.bytes_of(part))
            ]
        if self.letters.issuperset(unit):
            return self.segment(unit)
        ids: list[int] = []
        start = 0
        for at, letter in enumerate(unit):
            if letter not in self.letters:
                if start < at:
                    ids += self.segment(unit[start:at])
                ids += self.bytes_of(letter)
                start = at + 1
        if start < len(unit):
            ids += self.segment(unit[start:])
        return ids

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(BLANK + text.replace(" ", BLANK)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for unit in self.units(text) for i in self.encode_unit(unit)]

    def decode_part(self, ids: list[int]) -> str:
        """Text of a run of ids, the leading blank included."""
        if ids and min(ids) >= self.first_plain:
            return "".join(map(self.text.__getitem__, ids)).replace(BLANK, " ")
        out: list[str] = []
        run = bytearray()
        for i in ids:
            if i in self.raw:
                run.append(self.raw[i])
                continue
            if run:
                out.append(_as_text(run))
                run = bytearray()
            if i == self.unknown:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.text[i].replace(BLANK, " "))
        if run:
            out.append(_as_text(run))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        first = next((i for i in ids if i not in self.silent), self.unknown)
        text = self.decode_part(ids)
        return text.removeprefix(" ") if self.text[first].startswith(BLANK) else text


def _as_text(run: bytearray) -> str:
    """UTF-8 text of a run of bytes; each byte that is no part of a character becomes U+FFFD."""
    out, at = [], 0
    while at < len(run):
        for width in (1, 2, 3, 4):
            try:
                out.append(run[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


Coded = tuple[str, int, str]


class UnitMemo(dict):
    """Chunk between blanks -> (ids as text, their number, what they decode to)."""

    def __init__(self, model: PieceModel):
        self.model = model
        self.older: dict[str, Coded] = {}

    def of(self, unit: str) -> Coded:
        model = self.model
        whole = model.id_of.get(unit, -1)
        if whole in model.edges:
            return model.names[whole], 1, unit.replace(BLANK, " ")
        # Known characters are decoded to themselves.
        plain = model.letters.issuperset(unit)
        ids = model.segment(unit) if plain and BLANK * 2 not in unit else model.encode_unit(unit)
        names = ",".join(map(model.names.__getitem__, ids))
        return names, len(ids), unit.replace(BLANK, " ") if plain else model.decode_part(ids)

    def __missing__(self, chunk: str) -> Coded:
        found = self.older.get(chunk)
        if found is None:
            if chunk.isalpha():
                found = self.of(BLANK + chunk)
            elif chunk[:1] == " ":
                found = self.of(chunk[1:])
            else:
                found = self.divided(chunk)
        if len(chunk) < 64 and len(found[0]) < KEPT:
            if len(self) >= MEMO:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def divided(self, chunk: str) -> Coded:
        """A chunk of letters and other signs, cut where nothing can merge. What stands behind a
        border is remembered with a blank before it, which no chunk has."""
        parts = _RUNS.findall(chunk)
        if len(parts) < 2 or not parts[0][0].isalpha():
            return self.of(BLANK + chunk)
        joined = self.model.joined
        for left, right in zip(parts, parts[1:], strict=False):
            if (left[-1], right[0]) in joined:
                return self.of(BLANK + chunk)
        ids, count, decoded = self[parts[0]]
        for part in parts[1:]:
            more, n, text = self[" " + part]
            ids, count, decoded = f"{ids},{more}", count + n, decoded + text
        return ids, count, decoded

    def document(self, text: str) -> Coded:
        """(ids joined by commas, number of ids, decoded text) of a whole text."""
        if not text:
            return "", 0, ""
        if "  " in text or BLANK in text or text[0] == " ":
            parts = [self.of(unit) for unit in self.model.units(text)]
        else:
            parts = list(map(self.__getitem__, text.split(" ")))
        ids, counts, decoded = zip(*parts, strict=True)
        return ",".join(ids), sum(counts), "".join(decoded).removeprefix(" ")


@lru_cache(maxsize=1)
def model(path: str) -> PieceModel:
    return PieceModel(path)


def digests(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of each whole text."""

    def sha(text: str) -> str:
        return hashlib.sha256(text.encode()).hexdigest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = sole(("pieces", model_path), lambda: UnitMemo(model(model_path)))
        for batch in batches:
            rows: list[list] = [[], [], []]
            for text in texts(batch.column(1)):
                ids, count, decoded = memo.document(text)
                for column, value in zip(rows, (count, sha(ids), sha(decoded)), strict=True):
                    column.append(value)
            yield record_batch(_SCHEMA, [batch.column(0), *rows])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, DIGESTS)


def encoded(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, ids) of each whole text."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in batches:
            yield record_batch(schema, [batch.column(0), [own.encode(t) for t in texts(batch.column(1))]])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        encode, "doc_id long, ids array<int>"
    )


def decoded(rows: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); a null list is the empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = model(model_path)
        for batch in batches:
            found = [own.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield record_batch(schema, [batch.column(0), found])

    return rows.select(F.col("doc_id").cast("long"), "ids").mapInArrow(
        decode, "doc_id long, text string"
    )
