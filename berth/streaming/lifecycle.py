"""The life of runs as a stream with state: each run comes out once, when it has ended.

Events are rows of a run: workflow_id, status, at (timestamp), seq, error_message and payload
(JSON text). Of an open run the state holds a few values, whatever the number of its events: its
first and last time, its last status with error and payload, and how many events there were. All
of them are minima, maxima and counts, so the order in which events arrive, and how they are dealt
to batches, has no part in the result as long as they come within the watermark.

A timer ends a run: once event time is GRACE beyond the last event of a run with a final status,
it comes out with that status; a run whose last status is not final comes out as FAILED after the
time-out. Events of a run that has come out are the first of a new row of it.

State with timers is the one thing here that built-in expressions do not have, so a Python
processor keeps it. It is called for a bucket of runs and not for a single run: runs are dealt to
BUCKETS by a hash, rows reach the processor chunk by chunk, and all runs of a chunk are folded at
once. A bucket has one state value, the table of its open runs, and one timer, for the first of
them to end. So calls grow with the buckets and memory with the open runs of one bucket, whatever
the number of runs and of events. BUCKETS is part of a checkpoint and stays as it is. Such state
needs a store that keeps several values per key; ``follow`` names it for its stream, so that the
session need not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from berth.operators.runlog import FINAL_STATES
from berth.streaming import streams as st

EVENT = (
    "workflow_id string, status string, at timestamp, seq bigint, error_message string, payload string"
)
ENDED = (
    "workflow_id string, status string, started_at timestamp, ended_at timestamp, "
    "duration_seconds double, events bigint, error_message string, payload string, timed_out boolean"
)
# Fixed value: how a run without an end reads in the error column.
NO_END = "no end within %d seconds"

#: Groups of runs that share a state value and a timer.
BUCKETS = 1024
#: Rows of a bucket that wait to be folded, beside as many as its runs of this batch.
WAITING = 50_000

_STATE = "runs binary, timer_ms bigint"
# A missing seq comes before any other of the same time.
_NO_SEQ = -(2**63)
_ROWS = (
    f"CAST(pmod(xxhash64(workflow_id), {BUCKETS}) AS INT) AS bucket",
    "at",
    "workflow_id",
    "unix_micros(at) AS last_us",
    f"coalesce(CAST(seq AS BIGINT), {_NO_SEQ}) AS seq",
    "CAST(status AS STRING) AS status",
    "CAST(error_message AS STRING) AS error_message",
    "CAST(payload AS STRING) AS payload",
)
_FOLDED = ["workflow_id", "first_us", "last_us", "seq", "status", "error_message", "payload", "events"]
_NUMBERS = ("first_us", "last_us", "seq", "events")
_TABLE = pa.schema([(c, pa.int64() if c in _NUMBERS else pa.string()) for c in _FOLDED])
_OUT = (
    "workflow_id string, status string, first_us bigint, last_us bigint, events bigint, "
    "error_message string, payload string, timed_out boolean"
)
_ENDED = (
    "workflow_id",
    "status",
    "timestamp_micros(first_us) AS started_at",
    "timestamp_micros(last_us) AS ended_at",
    "(last_us - first_us) / 1000000D AS duration_seconds",
    "events",
    "error_message",
    "payload",
    "timed_out",
)


def _folded(rows: pd.DataFrame, newest: list[str]) -> pd.DataFrame:
    """One row per run: first time and count of all its rows, the rest of its newest one, which is
    the last by these columns, nulls first."""
    rows = rows.sort_values(newest, kind="stable", na_position="first")
    runs = rows.groupby("workflow_id", sort=False)
    sums = runs.agg(first_us=("first_us", "min"), events=("events", "sum"))
    last = rows.drop_duplicates("workflow_id", keep="last").drop(columns=["first_us", "events"])
    return last.join(sums, on="workflow_id")[_FOLDED]


def _bytes(runs: pd.DataFrame) -> bytearray:
    table = pa.Table.from_pandas(runs, schema=_TABLE, preserve_index=False, nthreads=1)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, _TABLE, options=pa.ipc.IpcWriteOptions(compression="lz4")) as writer:
        writer.write_table(table)
    return bytearray(sink.getvalue())


def _runs(kept: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(kept)).read_all().to_pandas(use_threads=False)


class Runs(StatefulProcessor):
    """State and timer of each bucket of runs."""

    def __init__(self, grace: dt.timedelta, timeout: dt.timedelta):
        self.grace, self.timeout = grace, timeout

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("open", _STATE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        order = ["last_us", "seq", "status"]
        parts, waiting, most = [], 0, WAITING
        for chunk in rows:
            parts.append(chunk.assign(first_us=chunk["last_us"], events=1)[_FOLDED])
            waiting += len(chunk)
            if waiting > most:
                parts = [_folded(pd.concat(parts, ignore_index=True), order)]
                waiting, most = len(parts[0]), WAITING + 2 * len(parts[0])
        runs = _folded(pd.concat(parts, ignore_index=True), order)
        runs["seq"] = runs["seq"].where(runs["seq"] != _NO_SEQ, -1)
        timer = None
        if self.open.exists():
            kept, timer = self.open.get()
            # Of two events of one time and seq that of the later batch counts, so the sort is by
            # place, too.
            both = pd.concat([_runs(kept), runs], ignore_index=True)
            runs = _folded(both.assign(place=both.index), ["last_us", "seq", "place"])
        self._keep(runs, timer)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        runs = _runs(self.open.get()[0])
        fired = expiredTimerInfo.getExpiryTimeInMs()
        due = self._ends(runs) <= max(fired, timerValues.getCurrentWatermarkInMs() - 1)
        self._keep(runs[~due], fired, fires=True)
        out = runs[due].drop(columns="seq")
        out["timed_out"] = ~out["status"].isin(FINAL_STATES)
        out["error_message"] = out["error_message"].mask(
            out["timed_out"], NO_END % self.timeout.total_seconds()
        )
        out["status"] = out["status"].mask(out["timed_out"], "FAILED")
        yield out[[c.split(" ")[0] for c in _OUT.split(", ")]]

    def _ends(self, runs: pd.DataFrame) -> pd.Series:
        """When each run ends if nothing more comes, in whole milliseconds."""
        wait = [w // dt.timedelta(milliseconds=1) for w in (self.grace, self.timeout)]
        return -(-runs["last_us"] // 1000) + np.where(runs["status"].isin(FINAL_STATES), *wait)

    def _keep(self, runs: pd.DataFrame, timer: int | None, fires: bool = False) -> None:
        """Set the open runs and the timer of the first to end; one that fires goes by itself."""
        if runs.empty:
            self.open.clear()
            return
        first = int(self._ends(runs).min())
        if first != timer:
            if timer is not None and not fires:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(first)
        self.open.update((_bytes(runs), first))

    def close(self) -> None:
        pass


def ended_runs(
    events: DataFrame,
    grace: dt.timedelta = dt.timedelta(minutes=10),
    timeout: dt.timedelta = dt.timedelta(hours=1),
    delay: str = "10 minutes",
) -> DataFrame:
    """Runs of a stream of events, each once it has ended or timed out; ``delay`` is how late an
    event may come behind the newest one. Events without a run or a time belong to none."""
    known = events.filter("workflow_id IS NOT NULL AND at IS NOT NULL")
    return (
        known.withWatermark("at", delay)
        .selectExpr(*_ROWS)
        .groupBy("bucket")
        .transformWithStateInPandas(Runs(grace, timeout), _OUT, "Append", "EventTime")
        .selectExpr(*_ENDED)
    )


def follow(runs: DataFrame, path: str, checkpoint: str) -> None:
    """Run a stream of ended runs into a Parquet folder, each once."""
    st.to_folder(runs, path, checkpoint, store=st.TIMED_STORE)


def with_variant(runs: DataFrame) -> DataFrame:
    """Payloads as variants, whatever their fields; text that is no JSON becomes NULL."""
    return runs.withColumn("payload", F.try_parse_json("payload"))
