"""How five text filters act on each other, for all orders in which they can be applied.

A sparse document-term matrix (see ``matrix``) is built over one dictionary of all words; its row
sums are the numbers of words and its counts of entries the numbers of distinct words, which decide
filters A and B. What a text itself shows (capitals, odd signs) is noted when it is encoded,
and identity is decided by SHA-256 over all texts.

Every text then is one of 32 combinations of failed filters, so all 120 orders follow from counts
per part and combination: what is kept behind a set of filters are the texts that fail none of it.

Defined results: a null text is empty (no words, fails A only); a null source is the part ''; a
null doc_id is never a repeat and makes none; repeated rows of one doc_id are no repeats of each
other, as no id is smaller; several labels of one id count as 1 if one of them does; a text without
labels is neither good nor toxic; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.llm import matrix
from berth.llm.common import bounded

FILTERS = "ABCDE"
LEAST_WORDS = 200
#: Percent.
LEAST_DISTINCT = 50
MOST_CAPITALS = 2
ODD_SIGNS = b"#$%&*|"

_CAPITALS = bytes(range(65, 91))
_FACTS = T.StructType().add("capitals", "boolean").add("odd", "boolean").add("digest", "binary")
_MEASURED = "doc_id long, part string, capitals boolean, odd boolean, digest binary, n_words long, n_distinct long"
_SETS = 1 << len(FILTERS)


def facts(text: str, raw: bytes) -> tuple:
    """(too many capitals, an odd sign, digest) of a text."""
    capitals = len(raw) - len(raw.translate(None, _CAPITALS))
    odd = len(raw.translate(None, ODD_SIGNS)) < len(raw)
    return 100 * capitals > MOST_CAPITALS * len(text), odd, hashlib.sha256(raw).digest()


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, part, capitals, odd, digest, n_words, n_distinct) of each row of ``docs``."""
    given = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), "text"
    )
    shards = matrix.encode(given, facts=facts, fact_fields=_FACTS)
    layout = T.StructType.fromDDL(_MEASURED)

    def count(own: matrix.Rows) -> pa.Table:
        ids = own.values["id"]
        if len(np.unique(ids)) < len(ids):
            raise ValueError("two words of a shard have one number")
        sums = [own.sums(own.counts.astype(np.int64)), np.diff(own.starts).astype(np.int64)]
        return pa.table([*own.rows.flatten(), *(pa.array(s) for s in sums)], names=layout.names)

    return matrix.resolve(shards, matrix.ids(matrix.numbered(shards)), count, layout)


def _bit(k: int, failed: Column) -> Column:
    return F.when(failed, F.lit(1 << k)).otherwise(F.lit(0))


def combinations(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, failed, n, good, toxic): how many texts of each part fail exactly the filters of the
    set ``failed``, whose bit k stands for FILTERS[k]."""
    own = measured(docs)
    own = own.withColumn(
        "failed",
        _bit(0, F.col("n_words") < LEAST_WORDS)
        + _bit(1, 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"))
        + _bit(2, F.col("capitals"))
        + _bit(3, F.col("odd")),
    )
    marks = (
        labels.where("doc_id IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.max((F.col("quality") == 1).cast("int")).alias("good"),
            F.max((F.col("toxic") == 1).cast("int")).alias("toxic"),
        )
    )
    marked = own.join(bounded(marks), "doc_id", "left").select(
        "digest",
        "part",
        "failed",
        F.coalesce("good", F.lit(0)).alias("good"),
        F.coalesce("toxic", F.lit(0)).alias("toxic"),
        "doc_id",
    )
    # Copies fall together before anything meets by digest: what is left of a group of copies is a
    # row per part and marks, with its smallest id and how many rows have that.
    kind = ["digest", "part", "failed", "good", "toxic"]
    groups = (
        marked.groupBy(*kind, "doc_id")
        .agg(F.count("*").alias("n"))
        .groupBy(*kind)
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
            F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"),
        )
    )
    groups = groups.select(*kind, "n", "nameless", F.col("least.doc_id").alias("id"), F.col("least.n").alias("at"))
    firsts = groups.groupBy("digest").agg(F.min("id").alias("first"))
    alone = F.col("nameless") + F.when(F.col("id") == F.col("first"), F.col("at")).otherwise(0)
    halves = groups.join(firsts, "digest").select(
        "part",
        "good",
        "toxic",
        F.inline(
            F.array(
                F.struct(F.col("failed"), alone.alias("n")),
                F.struct((F.col("failed") + F.lit(16)).alias("failed"), (F.col("n") - alone).alias("n")),
            )
        ),
    )
    return halves.groupBy("part", "failed").agg(
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("good")).alias("good"),
        F.sum(F.col("n") * F.col("toxic")).alias("toxic"),
    )


def _clear(of: str) -> str:
    """For each set of filters, how many of a part's texts fail none of it."""
    return (
        f"transform(sequence(0, {_SETS - 1}), s -> "
        f"aggregate(filter(cells, c -> c.failed & s = 0), 0L, (sum, c) -> sum + c.{of}))"
    )


def orders(found: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, from ``combinations``."""
    parts = (
        found.groupBy("part")
        .agg(F.collect_list(F.struct("failed", "n", "good", "toxic")).alias("cells"))
        .select("part", *(F.expr(_clear(c)).alias(c) for c in ("n", "good", "toxic")))
    )
    last = len(FILTERS) - 1
    ways = ", ".join(str(factorial(k) * factorial(last - k)) for k in range(len(FILTERS)))
    shares = F.expr(
        f"transform(sequence(0, {last}), k -> aggregate(filter(sequence(0, {_SETS - 1}), "
        f"s -> s & shiftleft(1, k) = 0), 0L, (sum, s) -> sum + "
        f"array({ways})[bit_count(s)] * (n[s] - n[s | shiftleft(1, k)])))"
    )
    names = ["".join(p) for p in itertools.permutations(FILTERS)]
    steps = (
        parts.withColumn("shares", shares)
        .withColumn("filter_order", F.explode(F.array(*map(F.lit, names))))
        .withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
        .withColumn("k", F.expr(f"instr('{FILTERS}', substring(filter_order, step, 1)) - 1"))
        .withColumn(
            "before",
            F.expr(
                "aggregate(filter(sequence(1, 5), i -> i < step), 0, (s, i) -> "
                f"s | shiftleft(1, instr('{FILTERS}', substring(filter_order, i, 1)) - 1))"
            ),
        )
        .withColumn("after", F.expr("before | shiftleft(1, k)"))
    )
    return steps.selectExpr(
        "part",
        "filter_order",
        "step",
        "n[after] AS kept",
        "n[before] - n[after] AS removed",
        "n[0] - n[shiftleft(1, k)] - (n[before] - n[after]) AS redundant",
        f"n[{_SETS - 1} ^ shiftleft(1, k)] - n[{_SETS - 1}] AS unique_fails",
        "good[before] - good[after] AS good_lost",
        "toxic[before] - toxic[after] AS toxic_lost",
        "shares[k] AS shapley",
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost and
    shapley."""
    return orders(combinations(docs, labels))
