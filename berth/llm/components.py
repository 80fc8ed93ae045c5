"""Connected components of a table of links, by contraction.

Each round every node names the neighbour that a hash of this round puts first (or itself), and
the links are rewritten to the named nodes; links within a name and repeated links vanish. The
hash changes from round to round, so chains shrink by a constant share and the number of rounds
is logarithmic. Rounds are written below the shared checkpoint folder. Nothing but the number of
links left comes to the driver. A node with very many links is combined before the shuffle, and
the joins are plain ones that the adaptive plan can split."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.llm.common import record_batch, stored

#: Links that a task joins at a time before the first round.
LINKS_AT_ONCE = 200_000


def forest(links: DataFrame) -> DataFrame:
    """Fewer links (a, b) with the same components: each task keeps, of every so many links, one
    for each node that is not yet connected."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        def kept() -> pa.RecordBatch:
            pairs = [(x, r) for x in parent if (r := root(x)) != x]
            parent.clear()
            return record_batch(schema, [[p[k] for p in pairs] for k in (0, 1)])

        for batch in batches:
            for a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                x, y = root(a), root(b)
                if x != y:
                    parent[max(x, y)] = min(x, y)
            if len(parent) > LINKS_AT_ONCE:
                yield kept()
        yield kept()

    return links.select("a", "b").mapInArrow(thin, "a long, b long")


def connect(links: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b), which are longs; the root is one of the
    component's nodes."""
    left = stored(forest(links).distinct(), "links")
    rounds: list[DataFrame] = []
    while left.limit(1).count():
        order = F.xxhash64("other", F.lit(len(rounds)))
        both = left.select(F.col("a").alias("node"), F.col("b").alias("other")).union(
            left.select(F.col("b"), F.col("a"))
        )
        own = F.struct(F.xxhash64("node", F.lit(len(rounds))).alias("h"), F.col("node").alias("n"))
        named = both.groupBy("node").agg(
            F.least(F.first(own), F.min(F.struct(order.alias("h"), F.col("other").alias("n"))))
            .getField("n")
            .alias("name")
        )
        named = stored(named, "named")
        rounds.append(named)
        a = named.select(F.col("node").alias("a"), F.col("name").alias("x"))
        b = named.select(F.col("node").alias("b"), F.col("name").alias("y"))
        left = left.join(a, "a").join(b, "b").where("x <> y")
        left = stored(
            left.select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b")).distinct(),
            "links",
        )
    if not rounds:
        return left.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = rounds[-1].withColumnRenamed("name", "root")
    for named in reversed(rounds[:-1]):
        upper = found.select(F.col("node").alias("name"), F.col("root").alias("above"))
        found = named.join(upper, "name", "left").select(
            "node", F.coalesce("above", "name").alias("root")
        )
    return found
