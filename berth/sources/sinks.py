"""Writing results: appends, insert-select, copies and per-input status rows."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.operators.profile import comparable, quoted
from berth.session import scratch_dir
from berth.sources.readers import read_staged

# Fixed value: how a failed input reads in the summary column.
ERROR_SUMMARY = "Error: %s"


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Append result rows to a history folder; nested columns stay typed."""
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def create_table(spark: SparkSession, name: str, layout: str, path: str) -> None:
    spark.sql(f"CREATE TABLE {name} ({layout}) USING parquet LOCATION '{path}'")


def insert_select(df: DataFrame, table: str, columns: Sequence[str]) -> None:
    """Insert rows into a table through a temporary view."""
    view = f"incoming_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    names = ", ".join(columns)
    df.sparkSession.sql(f"INSERT INTO {table} ({names}) SELECT {names} FROM {view}")
    df.sparkSession.catalog.dropTempView(view)


def copy_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create a table as a copy of another; fails where the table exists already."""
    spark = df.sparkSession
    view = f"copied_{uuid.uuid4().hex[:12]}"
    df.createOrReplaceTempView(view)
    location = path or scratch_dir(spark, name)
    spark.sql(
        f"CREATE TABLE {name} USING parquet LOCATION '{location}' AS SELECT * FROM {view}"
    )
    spark.catalog.dropTempView(view)
    return spark.table(name)


def error_condition(error: Exception) -> str:
    """Short name of a Spark error, such as PATH_NOT_FOUND."""
    if isinstance(error, PySparkException) and error.getCondition():
        return error.getCondition()
    if isinstance(error, Py4JJavaError):
        found = re.search(r"\[([A-Z_.]+)\]", error.java_exception.toString())
        return found.group(1) if found else error.java_exception.getClass().getSimpleName()
    return type(error).__name__


def _every_value(df: DataFrame, number: int) -> DataFrame:
    """One row (number, n) for which each value of each column has been read."""
    seen = F.xxhash64(*[F.to_json(F.struct(quoted(f.name))) if not comparable(f.dataType) else quoted(f.name)
                        for f in df.schema.fields]) if df.columns else F.lit(0)
    read = df.select(seen.alias("seen"))
    return read.agg(F.count(F.lit(1)).alias("n"), F.bit_xor("seen").alias("mark")).select(
        F.lit(number).alias("number"), "n", "mark"
    )


def _measured_together(readable: list[tuple]) -> Iterator[list[tuple]]:
    """Status rows of inputs, measured in one job. If that fails, each half is measured on its
    own, so one bad input among many costs a logarithmic number of jobs."""
    if not readable:
        return
    try:
        frames = [_every_value(df, number) for number, _, _, df in readable]
        found = {r["number"]: r["n"] for r in reduce(DataFrame.unionByName, frames).collect()}
        yield [
            (name, kind, "COMPLETED", found[number], len(df.columns), None)
            for number, name, kind, df in readable
        ]
    except (PySparkException, Py4JJavaError) as error:
        if len(readable) == 1:
            _, name, kind, _ = readable[0]
            yield [(name, kind, "FAILED", None, None, ERROR_SUMMARY % error_condition(error))]
            return
        half = len(readable) // 2
        yield from _measured_together(readable[:half])
        yield from _measured_together(readable[half:])


def measure_inputs(
    spark: SparkSession,
    inputs: Sequence[tuple[str, str]],
    read: Callable[[SparkSession, str, str], DataFrame] = read_staged,
) -> DataFrame:
    """One status row per (path, format): counts for a readable input, the error for another.

    An input that cannot be read does not stop the rest. Every value of every column is read,
    so damage behind intact footers is found. One row per input comes back to the driver,
    which is what the caller has listed.
    """
    rows, readable = [], []
    for number, (path, file_format) in enumerate(inputs):
        name = path.rstrip("/").rsplit("/", 1)[-1]
        try:
            # Opening looks at listings, headers and footers only.
            readable.append((number, name, file_format, read(spark, path, file_format)))
        except (PySparkException, Py4JJavaError) as error:
            summary = ERROR_SUMMARY % error_condition(error)
            rows.append((name, file_format, "FAILED", None, None, summary))
    for part in _measured_together(readable):
        rows += part
    return spark.createDataFrame(
        rows,
        "file_name string, file_format string, status string, row_count bigint, "
        "column_count int, summary string",
    )
