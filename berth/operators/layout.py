"""Small relations from the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def literal(value: str | int | float | bool | None) -> str:
    """SQL text of a plain value."""
    if value is None:
        return "NULL"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return str(value)


def local_rows(spark: SparkSession, rows: Sequence[tuple], layout: str) -> DataFrame:
    """A relation of a few plain rows that is part of the plan; no job makes or reads it."""
    fields = T.StructType.fromDDL(layout).fields
    given = rows or [tuple(None for _ in fields)]
    values = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in given)
    columns = ", ".join(
        f"CAST(col{i + 1} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for i, f in enumerate(fields)
    )
    df = spark.sql(f"SELECT {columns} FROM VALUES {values}")
    return df if rows else df.limit(0)
