from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from berth.operators import load
from berth.session import scratch_dir
from berth.streaming import streams as st

T0 = dt.datetime(2024, 1, 1)
STEP = "start_time timestamp, agent_name string, status string, tokens_used bigint"


def write_batches(spark, batches, layout, label):
    """One folder with one file per batch, in order of their names."""
    path = scratch_dir(spark, label)
    for rows in batches:
        spark.createDataFrame(rows, layout).coalesce(1).write.mode("append").parquet(path)
    return path


def test_late_rows_are_left_out_after_the_delay(spark):
    def step(minutes, agent="A", status="COMPLETED"):
        return (T0 + dt.timedelta(minutes=minutes), agent, status, 1)

    batches = [
        [step(5), step(50)],
        [step(200)],
        [step(201)],  # from here on the mark of 190 minutes counts
        [step(10), step(205, status="FAILED")],  # the first is later than the delay
        [step(400)],
    ]
    source = write_batches(spark, batches, STEP, "late")
    path, progress = st.stream_folders(spark, "late-out")
    stream = st.read_folder(spark, source, STEP, files_per_batch=1)
    st.to_folder(st.windowed_metrics(stream), path, progress)
    rows = {r["window_start"].hour: (r["executions"], r["failures"]) for r in spark.read.parquet(path).collect()}
    assert rows == {0: (2, 0), 3: (3, 1)}


def test_change_folder_equals_a_batch_upsert(spark):
    layout = "k int, v string, at timestamp_ntz"
    batches = [
        [(1, "a", T0), (2, "b", T0)],
        [(2, "B", T0 + dt.timedelta(days=1)), (3, "c", T0)],
        [(1, "old", T0 - dt.timedelta(days=1)), (3, "C", T0)],
    ]
    source = write_batches(spark, batches, layout, "changes")
    path, progress = st.stream_folders(spark, "changes-out")
    st.load_changes(st.read_folder(spark, source, layout, files_per_batch=1), path, progress)
    got = {r["k"]: r["v"] for r in st.current_rows(spark, path, layout, ["k"], ["at"]).collect()}
    assert got == {1: "a", 2: "B", 3: "C"}
    # Running again finds nothing new; a batch that comes twice replaces itself.
    st.load_changes(st.read_folder(spark, source, layout, files_per_batch=1), path, progress)
    repeated = spark.createDataFrame(batches[1], layout)
    repeated.write.mode("overwrite").parquet(f"{path}/batch_id=1")
    assert spark.read.parquet(path).count() == 6


def test_repeats_within_the_delay_come_once(spark):
    layout = "id int, at timestamp"
    batches = [[(1, T0), (2, T0)], [(1, T0 + dt.timedelta(minutes=1)), (3, T0)], [(2, T0)]]
    source = write_batches(spark, batches, layout, "repeats")
    path, progress = st.stream_folders(spark, "repeats-out")
    stream = st.read_folder(spark, source, layout, files_per_batch=1)
    st.to_folder(st.without_repeats(stream, ["id"], "at"), path, progress)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_quarantine_keeps_every_row_once(spark):
    layout = "k int"
    source = write_batches(spark, [[(1,), (None,)], [(2,), (None,), (3,)]], layout, "quarantine")
    path, progress = st.stream_folders(spark, "quarantine-out")
    stream = st.read_folder(spark, source, layout, files_per_batch=1)
    flagged = load.flag_validity(stream, {"k": F.col("k").isNotNull()}).drop("violations")
    st.quarantine(flagged, path, progress)
    assert sorted(r["k"] for r in st.branch(spark, path, layout, True).collect()) == [1, 2, 3]
    assert st.branch(spark, path, layout, False).count() == 2
