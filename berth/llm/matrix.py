"""A sparse document-term matrix in shards, with one dictionary of all words.

Words are numbered twice. A task numbers the words of its own texts as they come and writes shards
of compressed sparse rows over these numbers, each with its own word list. The word lists, far
shorter than the texts, are sorted by word, which numbers all words once for the whole corpus; or
they are joined with what is known of words. Either way each shard gets its list back with
global numbers, counts or estimates, and its rows are rewritten with them. Texts are read once and
never shuffled.

A shard is closed at SHARD_BYTES of text, so it and its word list are bounded, whatever one
source or one group of copies holds; a single longer text is a shard of its own. A common word
stands once in each shard's list, so no word is a hot key.

Defined results: a null text is the empty text and has an empty row; repeated rows have rows of
their own; an empty table has no shards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.llm.common import stored

SHARD_BYTES = 16 << 20
#: Bits for the shards of a task, and for the words of a partition of the sorted lists.
_BITS = 33
_CODEC = pa.Codec("zstd")

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

#: From a text and its UTF-8 bytes to further values of the row, named by a schema.
Facts = Callable[[str, bytes], tuple]


def _one(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(values: np.ndarray) -> pa.Array:
    return pa.array([_CODEC.compress(values.astype(np.int32).tobytes(), asbytes=True)], pa.binary())


def _unpacked(column: pa.ChunkedArray, size: int) -> np.ndarray:
    return np.frombuffer(_CODEC.decompress(column[0].as_py(), 4 * size, asbytes=True), np.int32)


def _steps(slots: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each row's first slot and the distances of its others; small numbers, as new words have
    neighbouring slots."""
    steps = np.diff(slots, prepend=0)
    begun = starts[:-1][np.diff(starts) > 0]
    steps[begun] = slots[begun]
    return steps


def _from_steps(steps: np.ndarray, starts: np.ndarray) -> np.ndarray:
    whole = np.cumsum(steps, dtype=np.int64)
    before = np.concatenate([[0], whole])[starts[:-1]]
    return whole - np.repeat(before, np.diff(starts))


def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows in batches of about SHARD_BYTES of text, or of one longer text."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy())
        begun = 0
        while begun < batch.num_rows:
            before = int(ends[begun - 1]) if begun else 0
            # As many rows as the shard has room for, and one at least.
            end = max(int(np.searchsorted(ends, before + SHARD_BYTES - size, side="right")), begun + (not held))
            if end > begun:
                held.append(batch.slice(begun, end - begun))
                size += int(ends[end - 1]) - before
                begun = end
            if begun < batch.num_rows:
                yield _together(held)
                held, size = [], 0
    if held:
        yield _together(held)


def _together(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def count_words(
    text: pa.Array, lower: bool = False, closing: str | None = None
) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(words, starts, slots, counts): the different words of some texts in the order in which
    they come, and which of them each text has how often."""
    if lower:
        ends = np.cumsum(pc.binary_length(text).to_numpy())
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        raw = b"".join(text.cast(pa.binary()).to_pylist()).translate(LOWER)
        text = pa.StringArray.from_buffers(len(text), pa.py_buffer(offsets), pa.py_buffer(raw))
    split = pc.ascii_split_whitespace(text)
    flat, offsets = split.flatten(), split.offsets.to_numpy()
    row = np.repeat(np.arange(len(text)), np.diff(offsets))
    # Blanks at the ends of a text leave empty pieces.
    real = pc.binary_length(flat).to_numpy() > 0
    coded = flat.filter(pa.array(real)).dictionary_encode()
    row, slots, words = row[real], coded.indices.to_numpy(), coded.dictionary
    if closing is not None:
        row = np.concatenate([row, np.arange(len(text))])
        slots = np.concatenate([slots, np.full(len(text), len(words))])
        words = pa.concat_arrays([words, pa.array([closing])])
    width = max(len(words), 1)
    keys, counts = np.unique(row * width + slots, return_counts=True)
    starts = np.searchsorted(keys, np.arange(len(text) + 1) * width)
    return words, starts, keys % width, counts


def encode(
    docs: DataFrame,
    lower: bool = False,
    closing: str | None = None,
    counted: str | None = None,
    facts: Facts | None = None,
    fact_fields: T.StructType | None = None,
    codec: str | None = None,
) -> DataFrame:
    """Shards of the texts of ``docs``, written below the shared checkpoint folder: (shard, rows,
    starts, slots, counts, words). Row r of a shard has slots and counts from starts[r] to
    starts[r + 1]; both are compressed, slots as steps. ``rows`` has the other columns of ``docs``
    and the facts. ``words`` has a shard's (slot, word, n), n in rows where the column ``counted``
    is true (in all without it).
    Words are runs of characters other than blank and \\t to \\r; ``closing`` is added behind each
    text, ``lower`` turns A-Z to lower case. The files are written with ``codec``, else as the session
    has it."""
    kept = [c for c in docs.columns if c != "text"]
    fact_fields = fact_fields or T.StructType([])
    row_type = T.StructType([*(docs.schema[c] for c in kept), *fact_fields.fields])
    layout = T.StructType(
        [
            T.StructField("shard", T.LongType()),
            T.StructField("rows", T.ArrayType(row_type)),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("slots", T.BinaryType()),
            T.StructField("counts", T.BinaryType()),
            T.StructField(
                "words",
                T.ArrayType(T.StructType.fromDDL("slot int, word string, n long")),
            ),
        ]
    )
    names = [f.name for f in fact_fields]

    def shard(number: int, rows: pa.RecordBatch) -> pa.RecordBatch:
        text = rows.column("text").fill_null("")
        columns = [rows.column(c) for c in kept]
        if facts:
            found = [facts(t, t.encode()) for t in text.to_pylist()]
            columns += [pa.array([f[k] for f in found]) for k in range(len(names))]
        words, starts, slots, counts = count_words(text, lower, closing)
        row = np.repeat(np.arange(len(text)), np.diff(starts))
        learned = counts
        if counted:
            learned = counts * rows.column(counted).fill_null(False).to_numpy(zero_copy_only=False)[row]
        totals = np.bincount(slots, weights=learned, minlength=len(words)).astype(np.int64)
        listed = [pa.array(np.arange(len(words), dtype=np.int32)), words, pa.array(totals)]
        arrays = [
            pa.array([number]),
            _one(pa.StructArray.from_arrays(columns, [*kept, *names])),
            _one(pa.array(starts.astype(np.int32))),
            _packed(_steps(slots, starts)),
            _packed(counts),
            _one(pa.StructArray.from_arrays(listed, ["slot", "word", "n"])),
        ]
        return pa.RecordBatch.from_arrays(arrays, layout.names)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << _BITS
        for number, rows in enumerate(sized(batches)):
            yield shard(first + number, rows)

    given = docs.select(*(F.col(f"`{c}`") for c in kept), "text")
    return stored(given.mapInArrow(build, layout), "shards", codec)


def local_words(shards: DataFrame) -> DataFrame:
    """(shard, slot, word, n): the word lists of all shards."""
    return shards.select("shard", F.inline("words"))


def numbered(shards: DataFrame) -> DataFrame:
    """The word lists with global numbers, written below the shared checkpoint folder: (home, slot,
    n, part, row, word), the word only where it comes first. ``row`` numbers the words of a
    partition of the sorted lists; ``dictionary`` and ``ids`` add the words of the partitions
    before."""
    lists = local_words(shards).select(F.col("shard").alias("home"), "slot", "n", "word")
    names = ["home", "slot", "n", "part", "row", "word"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, row = TaskContext.get().partitionId(), None, -1
        for batch in batches:
            if not batch.num_rows:
                continue
            word = batch.column(3)
            fresh = np.ones(len(word), dtype=bool)
            fresh[1:] = pc.not_equal(word[1:], word[:-1]).to_numpy(zero_copy_only=False)
            fresh[0] = last is None or word[0].as_py() != last
            rows = row + np.cumsum(fresh)
            row, last = int(rows[-1]), word[-1].as_py()
            first = pc.if_else(pa.array(fresh), word, pa.scalar(None, word.type))
            parts = pa.array(np.full(len(word), part, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], parts, pa.array(rows), first], names)

    in_order = lists.repartition("word").sortWithinPartitions("word")
    layout = "home long, slot int, n long, part int, row long, word string"
    return stored(in_order.mapInArrow(number, layout), "numbered")


def _with_id(rows: DataFrame) -> DataFrame:
    # One row per partition of a shuffle, which its setting bounds.
    sizes = rows.groupBy("part").agg(F.max("row") + 1).collect()
    before, offsets = 0, []
    for part, size in sorted(tuple(r) for r in sizes):
        offsets.append((part, before))
        before += size
    starts = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    return rows.join(F.broadcast(starts), "part").withColumn("id", F.col("before") + F.col("row"))


def ids(rows: DataFrame) -> DataFrame:
    """(home, slot, id) of ``numbered`` word lists."""
    return _with_id(rows).select("home", "slot", "id")


def dictionary(rows: DataFrame) -> DataFrame:
    """(word, id, n) of ``numbered`` word lists: every word once, its number (from 0, without gaps)
    and how often it stands in counted rows."""
    return _with_id(rows).groupBy("id").agg(F.max("word").alias("word"), F.sum("n").alias("n"))


def brought(shards: DataFrame, values: DataFrame) -> DataFrame:
    """(home, slot, values) of all word lists; each of their words has one row (word, values)."""
    lists = local_words(shards).select(F.col("shard").alias("home"), "slot", "word")
    return lists.join(values, "word").drop("word")


@dataclass
class Rows:
    """One shard with the values that the dictionary gave its words."""

    rows: pa.StructArray
    starts: np.ndarray
    slots: np.ndarray
    counts: np.ndarray
    values: dict[str, np.ndarray]  # per slot

    def sums(self, of_entry: np.ndarray) -> np.ndarray:
        """Sum per row of a value of each entry, added up row by row."""
        whole = np.zeros(len(self.starts) - 1, dtype=of_entry.dtype)
        filled = np.flatnonzero(np.diff(self.starts))
        if len(filled):
            whole[filled] = np.add.reduceat(of_entry, self.starts[:-1][filled])
        return whole


def resolve(
    shards: DataFrame, values: DataFrame, fn: Callable[[Rows], pa.Table], layout: T.StructType
) -> DataFrame:
    """What ``fn`` makes of each shard with the ``values`` (home, slot, numbers) of its words."""
    names = [c for c in values.columns if c not in ("home", "slot")]
    left = shards.select("shard", "rows", "starts", "slots", "counts")

    def work(one: pa.Table, found: pa.Table) -> pa.Table:
        rows, starts = (one.column(c).combine_chunks().flatten() for c in ("rows", "starts"))
        starts = starts.to_numpy()
        steps, counts = (_unpacked(one.column(c), int(starts[-1])) for c in ("slots", "counts"))
        slot = found.column("slot").to_numpy()
        given = {}
        for name in names:
            value = found.column(name).to_numpy()
            given[name] = np.zeros(len(slot), dtype=value.dtype)
            given[name][slot] = value
        return fn(Rows(rows, starts, _from_steps(steps, starts), counts, given))

    return left.groupBy("shard").cogroup(values.groupBy("home")).applyInArrow(work, layout)


def csr(shards: DataFrame, lists: DataFrame) -> DataFrame:
    """(rows, starts, ids, counts): the shards over the numbers of the ``numbered`` lists, each
    row's numbers ascending."""
    rows = shards.schema["rows"].dataType
    layout = T.StructType(
        [
            T.StructField("rows", rows),
            T.StructField("starts", T.ArrayType(T.IntegerType())),
            T.StructField("ids", T.ArrayType(T.LongType())),
            T.StructField("counts", T.ArrayType(T.IntegerType())),
        ]
    )

    def renumber(own: Rows) -> pa.Table:
        ids = own.values["id"][own.slots]
        row = np.repeat(np.arange(len(own.starts) - 1), np.diff(own.starts))
        order = np.lexsort((ids, row))
        arrays = [own.rows, pa.array(own.starts), pa.array(ids[order]), pa.array(own.counts[order])]
        return pa.table([_one(a) for a in arrays], names=layout.names)

    return resolve(shards, ids(lists), renumber, layout)
