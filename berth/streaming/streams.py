"""Streaming forms of the load and of the run metrics.

All streams read folders of files, run until the input is used up (``availableNow``) and
keep their progress in a checkpoint below the shared scratch folder. State is kept per key
or per window only as long as the watermark allows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from berth.operators.profile import comparable, quoted
from berth.operators.runlog import latest
from berth.session import scratch_dir

BATCH = "batch_id"
# The store that state with timers needs, as it keeps several values per key.
STORE = "spark.sql.streaming.stateStore.providerClass"
TIMED_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def read_folder(
    spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None, glob: str = ""
) -> DataFrame:
    """Stream of the Parquet files of a folder, oldest first."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def _finish(query: StreamingQuery) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def each_batch(
    stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str
) -> None:
    """Run a stream batch by batch. A batch may come twice after a failure, under its number."""
    _finish(
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@contextmanager
def _store(spark: SparkSession, provider: str | None) -> Iterator[None]:
    """Streams that start meanwhile keep their state in this store, whatever the session has; a
    stream takes its settings when it starts, so the session's own come back at once."""
    before = spark.conf.get(STORE)
    if provider:
        spark.conf.set(STORE, provider)
    try:
        yield
    finally:
        if provider:
            spark.conf.set(STORE, before)


def to_folder(
    stream: DataFrame, path: str, checkpoint: str, mode: str = "append", store: str | None = None
) -> None:
    """Run a stream into a Parquet folder, each row once; ``store`` is where its state is kept, if
    not where the session says."""
    with _store(stream.sparkSession, store):
        query = (
            stream.writeStream.format("parquet")
            .outputMode(mode)
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    _finish(query)


def load_changes(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write every batch to its own partition of a change folder.

    A repeated batch replaces its partition, so nothing is loaded twice, and no batch
    rewrites the curated table: the work of a batch is its own size.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    each_batch(stream, write, checkpoint)


def current_rows(
    spark: SparkSession, path: str, schema: str, keys: Sequence[str], newest: Sequence[str]
) -> DataFrame:
    """Curated view of a change folder: the newest row per key, later batches first on ties, and
    among rows of one batch the same one each time."""
    changes = spark.read.schema(f"{schema}, {BATCH} bigint").parquet(path)
    hashed = [quoted(f.name) for f in changes.schema.fields if comparable(f.dataType)]
    marked = changes.withColumn("_tie", F.xxhash64(*hashed))
    return latest(marked, keys, [*newest, BATCH, "_tie"]).drop(BATCH, "_tie")


def compact_changes(
    spark: SparkSession, path: str, schema: str, keys: Sequence[str], newest: Sequence[str]
) -> str:
    """Write the current rows as the first batch of a new change folder, whose path is returned.

    Readers go on with the old folder until they are pointed to the new one; later batches
    of the stream are written there.
    """
    fresh = scratch_dir(spark, "changes")
    current_rows(spark, path, schema, keys, newest).write.parquet(f"{fresh}/{BATCH}=-1")
    return fresh


def windowed_metrics(
    steps: DataFrame, width: str = "1 hour", slide: str | None = None, delay: str = "10 minutes"
) -> DataFrame:
    """Executions, failures and tokens per agent and time window, once a window is closed.

    Rows later than ``delay`` behind the newest are left out; ``slide`` gives overlapping
    windows.
    """
    span = F.window("start_time", width, slide) if slide else F.window("start_time", width)
    return (
        steps.withWatermark("start_time", delay)
        .groupBy(span.alias("span"), "agent_name")
        .agg(
            F.count(F.lit(1)).alias("executions"),
            F.count_if(F.col("status") == "FAILED").alias("failures"),
            F.sum("tokens_used").alias("tokens"),
        )
        .select(
            F.col("span.start").alias("window_start"),
            F.col("span.end").alias("window_end"),
            "agent_name",
            "executions",
            "failures",
            "tokens",
        )
    )


def without_repeats(
    stream: DataFrame, keys: Sequence[str], time: str, delay: str = "1 hour"
) -> DataFrame:
    """Each key once; repeats are recognised within ``delay`` of event time."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))


def quarantine(stream: DataFrame, path: str, checkpoint: str, flag: str = "is_valid_record") -> None:
    """Valid and invalid rows of each batch side by side, written in one pass.

    Below the batch the rows are partitioned by the flag, so both branches are complete
    whenever the batch is, and each is read on its own by partition pruning.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy(flag).parquet(f"{path}/{BATCH}={batch_id}")

    each_batch(stream, write, checkpoint)


def branch(
    spark: SparkSession, path: str, schema: str, valid: bool, flag: str = "is_valid_record"
) -> DataFrame:
    """The valid or the invalid branch of a quarantine folder."""
    rows = spark.read.schema(f"{schema}, {BATCH} bigint, {flag} boolean").parquet(path)
    return rows.filter(F.col(flag) == F.lit(valid)).drop(BATCH, flag)


def stream_folders(spark: SparkSession, label: str) -> tuple[str, str]:
    """Fresh (output, checkpoint) folders for one stream."""
    base = scratch_dir(spark, label)
    return f"{base}/rows", f"{base}/progress"
