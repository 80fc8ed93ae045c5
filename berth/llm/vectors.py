"""Which vectors take part, and one row for each different vector."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(table: DataFrame) -> DataFrame:
    """(vec_id, embedding) with one row per id, of vectors that can be compared: not null, not
    zero, without null or non-finite components, and of the most common length (of two, the
    longer). Of several vectors with one id the smallest counts; null ids are left out."""
    given = table.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
    )
    finite = F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    )
    rows = given.where(finite & F.exists("embedding", lambda x: x != 0))
    sizes = rows.groupBy(F.size("embedding").alias("n")).count()
    best = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    if best is None:
        return rows
    return (
        rows.where(F.size("embedding") == best["n"])
        .groupBy("vec_id")
        .agg(F.min("embedding").alias("embedding"))
    )


def distinct_vectors(rows: DataFrame, most_ids: int) -> DataFrame:
    """(class_id, embedding, copies, ids) for each different vector: its smallest id, how many
    ids have it, and the ``most_ids`` smallest of them. Equal vectors are counted and ranked
    before the shuffle, so one that fills a third of the table is no large group."""
    counts = rows.groupBy("embedding").agg(
        F.min("vec_id").alias("class_id"), F.count(F.lit(1)).alias("copies")
    )
    if most_ids == 1:
        return counts.select("class_id", "embedding", "copies")
    order = Window.partitionBy("embedding").orderBy("vec_id")
    firsts = (
        rows.withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= most_ids)
        .groupBy("embedding")
        .agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    )
    return firsts.select(F.element_at("ids", 1).alias("class_id"), "embedding", "ids")


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal lengths, in double precision."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(flat), -1) if len(flat) else np.zeros((0, 0))
