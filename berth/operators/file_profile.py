"""Profiles that grow by file: what is known of a file is kept and never read again.

For each file and column the store (a table in parts, ``parts``) has counts, extremes and a
mergeable sketch of the distinct values. An update lists the files, reads those that are new or
changed, in one scan that groups by file, and forgets those that are gone. The profile of
the table is put together from these rows alone; distinct counts are estimates of merged sketches,
within about 1.6 percent (one standard error). ``profile`` with ``distinct="exact"`` remains for
where exact ones are asked for.

A file is told by its path, length and time of change. Columns that a file does not have count as
NULL in all its rows, as they read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.functions import quality
from berth.operators import load
from berth.operators.layout import local_rows
from berth.operators.parts import PartTable
from berth.operators.profile import comparable, quoted, tick

FILES = (
    "file string, file_size bigint, changed_at timestamp, slot int, row_count bigint, "
    "non_null_count bigint, low_whole decimal(38,0), high_whole decimal(38,0), low_fraction double, "
    "high_fraction double, low_text string, high_text string, max_length bigint, sketch binary"
)
_PARTS = 64


def _kind(dtype: T.DataType) -> str | None:
    """Under which of the typed pairs of columns the extremes of a type are kept."""
    if isinstance(dtype, (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        return "whole"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return "fraction"
    if isinstance(dtype, (T.StringType, T.BooleanType)):
        return "text"
    return None


def _ordered(name: str, dtype: T.DataType) -> str:
    """A value in the type of its extremes, in its own order."""
    if isinstance(dtype, T.DateType):
        return f"unix_date({tick(name)})"
    if isinstance(dtype, T.TimestampType):
        return f"unix_micros({tick(name)})"
    if isinstance(dtype, T.TimestampNTZType):
        return f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ '1970-01-01', {tick(name)})"
    if isinstance(dtype, T.BooleanType):
        return f"CAST({tick(name)} AS string)"
    return tick(name)


def _shown(which: str, dtype: T.DataType) -> str:
    """An extreme as the text of its column's own type."""
    kind = _kind(dtype)
    value = f"{which}_{kind}"
    if isinstance(dtype, T.DateType):
        return f"CAST(date_from_unix_date(CAST({value} AS int)) AS string)"
    if isinstance(dtype, T.TimestampType):
        return f"CAST(timestamp_micros(CAST({value} AS bigint)) AS string)"
    if isinstance(dtype, T.TimestampNTZType):
        return f"CAST(timestampadd(MICROSECOND, CAST({value} AS bigint), TIMESTAMP_NTZ '1970-01-01') AS string)"
    if isinstance(dtype, T.FloatType):
        return f"CAST(CAST({value} AS float) AS string)"
    return f"CAST({value} AS string)"


def _counted(name: str, dtype: T.DataType) -> str:
    """A value in a form that a sketch takes; equal values have equal forms."""
    if _kind(dtype) == "whole":
        return f"CAST({_ordered(name, dtype)} AS bigint)"
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return f"CAST({tick(name)} + 0.0D AS string)"  # both zeros alike
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        return tick(name)
    return f"to_json(struct({tick(name)}))" if not isinstance(dtype, T.DecimalType) else f"CAST({tick(name)} AS string)"


def measure_files(df: DataFrame) -> DataFrame:
    """One row per file and column of a table read from files."""
    fields = df.schema.fields
    measures = ["count(1) AS _rows"]
    cells = []
    for i, f in enumerate(fields):
        kind = _kind(f.dataType)
        measures.append(f"count({tick(f.name)}) AS _n{i}")
        if kind:
            measures += [f"{m}({_ordered(f.name, f.dataType)}) AS _{m}{i}" for m in ("min", "max")]
        if isinstance(f.dataType, T.StringType):
            measures.append(f"max(length({tick(f.name)})) AS _length{i}")
        if comparable(f.dataType):
            measures.append(f"hll_sketch_agg({_counted(f.name, f.dataType)}) AS _sketch{i}")
        pairs = []
        for k, t in (("whole", "decimal(38,0)"), ("fraction", "double"), ("text", "string")):
            for which, m in (("low", "min"), ("high", "max")):
                pairs.append(f"CAST({f'_{m}{i}' if k == kind else 'NULL'} AS {t}) AS {which}_{k}")
        length = f"_length{i}" if isinstance(f.dataType, T.StringType) else "NULL"
        sketch = f"_sketch{i}" if comparable(f.dataType) else "NULL"
        cells.append(
            f"struct({i} AS slot, _rows AS row_count, _n{i} AS non_null_count, {', '.join(pairs)}, "
            f"CAST({length} AS bigint) AS max_length, CAST({sketch} AS binary) AS sketch)"
        )
    found = df.groupBy(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("changed_at"),
    ).agg(*[F.expr(m) for m in measures])
    return found.selectExpr("file", "file_size", "changed_at", f"inline(array({', '.join(cells)}))")


def listed(spark: SparkSession, paths: Sequence[str], pattern: str = "*.parquet") -> DataFrame:
    """(file, file_size, changed_at, path) of the files below the paths; no content is read."""
    found = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(list(paths))
    )
    return found.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_modification_time").alias("changed_at"),
        "path",
    )


class FileProfile:
    """What is known of the files of one table, kept below ``base``."""

    def __init__(self, spark: SparkSession, base: str, layout: T.StructType):
        self.spark, self.layout = spark, layout
        self.store = PartTable(spark, base)

    @classmethod
    def create(cls, spark: SparkSession, base: str, layout: T.StructType) -> FileProfile:
        PartTable.create(spark, base, FILES, ["file", "slot"], f"CAST(pmod(xxhash64(file), {_PARTS}) AS string)")
        return cls(spark, base, layout)

    def update(self, paths: Sequence[str]) -> list[str]:
        """Measure the Parquet files below the paths that are new or changed, and forget those of
        the store that are no longer there. Returns the files that were read, whose number the
        caller has chosen by how often it updates."""
        now = listed(self.spark, paths)
        known = self.store.read().filter("slot = 0").select("file", "file_size", "changed_at")
        fresh = now.join(known, ["file", "file_size", "changed_at"], "left_anti")
        read = sorted(r["path"] for r in fresh.select("path").collect())
        lost = self.store.read().join(now.select("file"), "file", "left_anti").select("file", "slot")
        rows = lost.withColumn("gone", F.lit(True))
        if read:
            table = self.spark.read.schema(self.layout).parquet(*read)
            measured = load.write_snapshot(measure_files(table), label="measured")
            # A file without rows has no group; it is known all the same.
            empty = fresh.drop("path").join(measured.select("file").distinct(), "file", "left_anti")
            slots = F.explode(F.sequence(F.lit(0), F.lit(len(self.layout) - 1)))
            zero = F.lit(0).cast("bigint")
            none = empty.withColumn("slot", slots).withColumns({"row_count": zero, "non_null_count": zero})
            rows = rows.unionByName(measured, allowMissingColumns=True).unionByName(none, allowMissingColumns=True)
        names = [c.split(" ")[0] for c in FILES.split(", ")]
        typed = self.store.read().limit(0).unionByName(rows, allowMissingColumns=True)
        self.store.merge(typed.select(*names, "gone"), ["changed_at"], deleted="gone")
        return read

    def profile(self) -> DataFrame:
        """One row per column, as ``profile`` of the whole table has them with estimated distinct
        counts."""
        rows = self.store.read()
        extremes = [
            f(F.col(f"{which}_{kind}")).alias(f"{which}_{kind}")
            for kind in ("whole", "fraction", "text")
            for which, f in (("low", F.min), ("high", F.max))
        ]
        found = rows.groupBy("slot").agg(
            F.sum("row_count").alias("row_count"),
            F.sum("non_null_count").alias("non_null_count"),
            *extremes,
            F.max("max_length").alias("max_length"),
            F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("_about"),
        )
        fields = self.layout.fields
        columns = local_rows(
            self.spark,
            [(i, f.name, f.dataType.simpleString(), comparable(f.dataType)) for i, f in enumerate(fields)],
            "ordinal int, column_name string, data_type string, grouped boolean",
        )
        joined = columns.join(F.broadcast(found), F.col("ordinal") == F.col("slot"), "left")
        n, given = (F.coalesce(c, F.lit(0)) for c in ("row_count", "non_null_count"))
        # An estimate beyond the values that there are is their number.
        about = F.when(F.col("grouped"), F.least(F.coalesce("_about", F.lit(0)), given))
        return joined.select(
            "column_name",
            "ordinal",
            "data_type",
            n.alias("row_count"),
            (n - given).alias("null_count"),
            given.alias("non_null_count"),
            about.alias("distinct_count"),
            quality.null_percentage(n - given, n).alias("null_percentage"),
            F.when(about.isNotNull(), quality.cardinality_class(about, n)).alias("cardinality"),
            _by_ordinal("low", fields).alias("min_value"),
            _by_ordinal("high", fields).alias("max_value"),
            "max_length",
        )


def _by_ordinal(which: str, fields: list[T.StructField]) -> Column:
    """The extreme of each column from the pair of its type."""
    shown = [(i, _shown(which, f.dataType)) for i, f in enumerate(fields) if _kind(f.dataType)]
    start = F.lit(None).cast("string")
    return reduce(lambda c, s: F.when(F.col("ordinal") == s[0], F.expr(s[1])).otherwise(c), reversed(shown), start)
