"""Layered load: validity, quarantine, incremental upsert and snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from berth.operators.profile import comparable, quoted
from berth.operators.runlog import latest
from berth.session import scratch_dir


def flag_validity(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Add ``is_valid_record`` and ``violations``, the names of the rules that do not hold.

    A rule that gives NULL does not hold.
    """
    broken = F.array_compact(
        F.array(
            *[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]
        )
    )
    return df.withColumn("violations", broken).withColumn(
        "is_valid_record", F.size("violations") == 0
    )


def clean_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter("is_valid_record").drop("is_valid_record", "violations")


def reject_rows(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~F.col("is_valid_record")).drop("is_valid_record")


def high_water_mark(df: DataFrame, column: str) -> Column | None:
    """Largest value of the load column as a literal of its type; None for an empty target.

    The value comes to the driver as text and goes back the same way, both in the session's
    time zone, so the driver's own zone has no part in it.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.FloatType, T.DoubleType, T.BinaryType)):
        raise ValueError(f"a load column of type {dtype.simpleString()} has no exact mark")
    text = df.agg(F.max(quoted(column)).cast("string").alias("mark")).collect()[0]["mark"]
    return None if text is None else F.lit(text).cast(dtype)


def newer_than(df: DataFrame, column: str, mark: Column | None, inclusive: bool) -> DataFrame:
    """Rows beyond the mark, which is a literal and so prunes the scan; all without a mark."""
    if mark is None:
        return df
    value = quoted(column)
    return df.filter(value >= mark if inclusive else value > mark)


def _keyed(keys: Sequence[str]) -> Column:
    return reduce(Column.__and__, [quoted(k).isNotNull() for k in keys])


def rows_without_key(incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows that no upsert can place, because a part of their key is NULL."""
    return incoming.filter(~_keyed(keys))


def upsert(
    existing: DataFrame, incoming: DataFrame, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Existing rows without the incoming keys, and the newest incoming row per key.

    Keys are unique within the join, so none is hot; a small batch is broadcast by
    the adaptive plan after its size is known, not by a hint. Rows with a NULL in their
    key are left to quarantine (``rows_without_key``). A column that only one side has is
    NULL in the rows of the other.
    """
    hashed = [quoted(f.name) for f in incoming.schema.fields if comparable(f.dataType)]
    # The same row wins among equally new ones, also when a lost task runs again.
    marked = incoming.filter(_keyed(keys)).withColumn("_tie", F.xxhash64(*hashed))
    batch = latest(marked, keys, [*newest, "_tie"]).drop("_tie")
    kept = existing.join(batch.select(*keys), list(keys), "left_anti")
    return kept.select(existing.columns).unionByName(batch, allowMissingColumns=True)


def incremental_load(
    existing: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    load_column: str,
    inclusive: bool = False,
    updated_at: Column | None = None,
) -> DataFrame:
    """Curated table after loading the source rows newer than its high-water mark.

    The load column may be of any exact type. With ``inclusive`` rows at the mark are taken
    again, so that none that arrived late with the same time is lost; the upsert makes that
    harmless. ``updated_at`` stamps what is loaded, in a table that had no such column too.
    """
    mark = high_water_mark(existing, load_column)
    fresh = newer_than(source, load_column, mark, inclusive)
    if updated_at is not None:
        fresh = fresh.withColumn("updated_at", updated_at)
    return upsert(existing, fresh, keys, [load_column])


def write_snapshot(
    df: DataFrame,
    path: str | None = None,
    label: str = "snapshot",
    partition_by: Sequence[str] = (),
) -> DataFrame:
    """Write a table to a new folder and read it back: cuts the lineage, survives lost
    executors, and never overwrites what is being read."""
    path = path or scratch_dir(df.sparkSession, label)
    df.write.mode("errorifexists").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_bucketed(
    df: DataFrame, name: str, keys: Sequence[str], buckets: int, path: str | None = None
) -> DataFrame:
    """Write a curated table in buckets of its key.

    An upsert into such a table moves only the batch: the table is already laid out
    the way the join needs it. Choose as many buckets as keep one bucket in the memory
    of a task.
    """
    spark = df.sparkSession
    location = path or scratch_dir(spark, name)
    spread_out = df.repartition(buckets, *keys)
    spread_out.write.mode("errorifexists").bucketBy(buckets, *keys).sortBy(*keys).option(
        "path", location
    ).saveAsTable(name)
    return spark.table(name)


def stage_view(df: DataFrame, source: str) -> str:
    """Register mapped data as the staging view of its source."""
    name = f"stg_{source.lower()}"
    df.createOrReplaceTempView(name)
    return name
