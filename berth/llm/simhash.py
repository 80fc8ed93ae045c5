"""SimHash near-dedup through segment bit counts.

A fingerprint is cut into 32 segments of two bits; a segment's bit count is 0, 1 or 2. The
counts change by at most one for each differing bit, so their Manhattan distance is a lower
bound of the number of differing bits. Written in unary (two bits a segment) that distance is
again a bit count, so all of this is arithmetic on longs.

Fingerprints at a Manhattan distance of at most 2 differ in at most two segments. With the
segments in four blocks, two blocks agree; so the range join meets on grids of two blocks each,
one for each pair of blocks, and checks the distance of all segments, then the bits. A cell of
more than DENSE fingerprints, as large groups of near copies make them, is not paired: there,
two fingerprints link if and only if a third word is at most one bit from both, so each one
names its 65 such words, and those that name the same word (at most 65) are linked to the
smallest. That is exact too, and linear.

Equal fingerprints are one row before anything is joined. Groups are the components of links.

Defined results: a null text is the empty text; texts without words have the fingerprint zero
and link like any others; fewer than three words are one shingle; a null doc_id takes part, and
a group without any id has a null component_id; repeated rows are in one group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.llm.common import sole, stored, texts
from berth.llm.components import connect

SHINGLE = 3
SEED = 42
MOST_BITS = 2
#: Cells of more fingerprints are linked through the words between them.
DENSE = 16
BLOCKS = 4
_LOW = 0x5555555555555555

_hash = partial(xxhash.xxh64_intdigest, seed=SEED)


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """64 bits as a signed number: those set in more than half of the shingles' hashes."""
    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        hashes = np.array([_hash(b" ".join(words))], dtype=np.uint64)
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False))
        hashes = np.fromiter(map(_hash, shingles), np.uint64, len(words) - shingle + 1)
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, name: str = "fp") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of ``text`` as a long."""
    at = docs.columns.index("text")

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sole("simhash", dict)  # nothing to remember; frees what an operator before did
        for batch in batches:
            found = pa.array([fingerprint(t) for t in texts(batch.column(at))], pa.int64())
            yield batch.append_column(name, found)

    return docs.mapInArrow(mark, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def _low(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW))


def counts_in_unary(fp: Column) -> Column:
    """The bit counts of all two-bit segments, each as that many ones."""
    upper = F.shiftrightunsigned(fp, 1)
    any_, both = _low(fp.bitwiseOR(upper)), _low(fp.bitwiseAND(upper))
    return any_.bitwiseOR(F.shiftleft(both, 1))


def grids(blocks: int = BLOCKS, most: int = MOST_BITS) -> list[int]:
    """Masks of the blocks that a grid keeps; ``most`` segments spoil at most as many blocks."""
    width = 64 // blocks
    whole = [((1 << width) - 1) << (width * k) for k in range(blocks)]
    masks = [sum(kept) for kept in combinations(whole, blocks - most)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def links(fingerprints: DataFrame) -> DataFrame:
    """Links (a, b) that join all fingerprints at most MOST_BITS apart, directly or through a
    chain of such links; ``fingerprints`` has distinct values in ``fp``."""
    masks = F.array(*(F.struct(F.lit(k).alias("grid"), F.lit(m).alias("mask")) for k, m in enumerate(grids())))
    placed = fingerprints.select("fp", counts_in_unary(F.col("fp")).alias("counts")).select(
        "fp", "counts", F.explode(masks).alias("g")
    ).select("fp", "counts", "g.grid", F.col("counts").bitwiseAND(F.col("g.mask")).alias("cell"))
    cells = placed.groupBy("grid", "cell").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stored(placed.join(cells, ["grid", "cell"]), "cells")
    sparse = shared.where(F.col("size") <= DENSE).select("grid", "cell", "fp", "counts")
    other = sparse.select("grid", "cell", F.col("fp").alias("b"), F.col("counts").alias("counts_b"))
    near = F.bit_count(F.col("counts").bitwiseXOR(F.col("counts_b"))) <= MOST_BITS
    same = F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= MOST_BITS
    pairs = (
        sparse.join(other, ["grid", "cell"])
        .where((F.col("fp") > F.col("b")) & near & same)
        .select(F.col("fp").alias("a"), "b")
    )
    flips = F.array(F.lit(0).cast("long"), *(F.lit((1 << k) - (1 << 64 if k == 63 else 0)).cast("long") for k in range(64)))
    between = (
        shared.where(F.col("size") > DENSE)
        .select("fp")
        .distinct()
        .select("fp", F.explode(flips).alias("flip"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
        .agg(F.collect_set("fp").alias("fps"))
        .where(F.size("fps") > 1)
        .select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
        .where("a <> b")
    )
    return pairs.union(between)


def classes(rows: DataFrame) -> DataFrame:
    """(fp, root, component_id) for each different ``fp`` of rows (doc_id, fp)."""
    firsts = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprints")
    roots = stored(connect(links(firsts)), "roots")
    rooted = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = roots.select("root").distinct()
    # Only roots of links can have more than one fingerprint.
    known = smallest.join(linked, "root", "left_semi")
    return rooted.join(known, "root", "left").select(
        "fp", "root", F.coalesce("component_id", "first").alias("component_id")
    )


def groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row."""
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = stored(with_fingerprint(given).select("doc_id", "fp"), "simhash")
    found = rows.join(classes(rows), "fp")
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _unused(columns: list[str], name: str) -> str:
    taken = {c.lower() for c in columns}
    while name in taken:
        name = f"_{name}"
    return name


def keep_one(docs: DataFrame) -> DataFrame:
    """One row, all columns, of each group: the one with the smallest doc_id, and of several such
    the first as they are stored. Input columns keep their names, whatever these are."""
    columns = docs.columns
    own, spot, kept_spot = (_unused(columns, n) for n in ("fp", "place", "kept"))
    copy = stored(with_fingerprint(docs, own), "documents")
    place = F.struct(F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row"))
    rows = copy.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(own).alias("fp"), place.alias("place")
    )
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "place")).alias("best")
    # Within a fingerprint first, so that groups of exact copies never meet in one task.
    firsts = rows.groupBy("fp").agg(best)
    kept = (
        firsts.join(classes(rows.select("doc_id", "fp")), "fp")
        .groupBy("root")
        .agg(F.min("best").alias("best"))
        .select(F.col("best.place").alias(kept_spot))
    )
    marked = copy.select("*", place.alias(spot))
    return marked.join(kept, F.col(spot) == F.col(kept_spot), "left_semi").select(*columns)
