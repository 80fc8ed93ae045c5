"""What several operators of this folder share: tables, folds, written tables, Arrow helpers."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.session import scratch_dir

#: Rows of a checked small side up to which a join may broadcast it (about 24 bytes a row).
BROADCAST_ROWS = 1_000_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write a table below the shared checkpoint folder and read it back: the lineage ends here,
    and a lost executor costs no more than a new read."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def fold(column: str, folds: int) -> Column:
    """crc32 of an id written as text, modulo the number of folds; null for a null id."""
    return F.crc32(F.col(column).cast("string")) % F.lit(folds)


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint if the table really is that small; else the join is left to a shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def labels_of(labels: DataFrame, label: str) -> DataFrame:
    """(doc_id, y) with one row per id: 1 if any of its rows says 1. Null ids and labels, and
    values other than 0 and 1, teach nothing."""
    return (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1))
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )


def texts(column: pa.ChunkedArray | pa.Array) -> Iterator[str]:
    """The values one by one, null as the empty text."""
    for value in column:
        yield value.as_py() or ""


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


_SOLE: dict[object, object] = {}


def sole(key: object, make: Callable[[], Any]) -> Any:
    """What a Python worker remembers for the operator at work. Workers serve one operator after
    another, so what the one before remembered is dropped."""
    if key not in _SOLE:
        _SOLE.clear()
        _SOLE[key] = make()
    return _SOLE[key]


_WORD_BYTES = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32
    for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Runs of digits, letters a-z and characters beyond ASCII, A-Z lower-cased."""
    return text.encode().translate(_WORD_BYTES).split()


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit_logistic(
    x: np.ndarray, y: np.ndarray, share: float, ridge: float = 1e-4, steps: int = 50
) -> np.ndarray:
    """Weights of a logistic regression by Newton steps. ``share`` is what label 1 weighs, however
    many of the rows have it."""
    weight = np.where(y == 1, share / max(y.sum(), 1), (1 - share) / max((1 - y).sum(), 1))
    beta = np.zeros(x.shape[1])
    for _ in range(steps):
        p = logistic(x @ beta)
        gradient = x.T @ (weight * (p - y)) + ridge * beta
        hessian = (x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + ridge * np.eye(len(beta))
        step = np.linalg.solve(hessian, gradient)
        beta -= step
        if np.abs(step).max() < 1e-8:
            break
    return beta
