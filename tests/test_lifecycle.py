"""Runs as a stream with state: ends, time-outs, restarts, events in any order."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd

from berth.session import scratch_dir
from berth.streaming import lifecycle as lc
from berth.streaming import streams as st

T0 = dt.datetime(2024, 1, 1)


def event(run, minute, status, error=None, payload=None, seq=0):
    return (run, status, T0 + dt.timedelta(minutes=minute), seq, error, payload)


def put(spark, base, *batches):
    for given in batches:
        spark.createDataFrame(given, lc.EVENT).coalesce(1).write.mode("append").parquet(f"{base}/events")


def follow(spark, base):
    stream = st.read_folder(spark, f"{base}/events", lc.EVENT, files_per_batch=1)
    st.to_folder(lc.ended_runs(stream), f"{base}/runs", f"{base}/progress")
    return {
        (r["workflow_id"], r["started_at"]): r for r in spark.read.schema(lc.ENDED).parquet(f"{base}/runs").collect()
    }


def test_runs_end_fail_and_time_out_across_restarts(spark):
    base = scratch_dir(spark, "lifecycle")
    put(
        spark,
        base,
        [event("done", 0, "INITIATED"), event("lost", 1, "INITIATED", payload='{"a": 1}'), event(None, 1, "X")],
        [event("done", 5, "COMPLETED", payload='{"rows": 5}'), event("broken", 6, "FAILED", "bad")],
        [event("lost", 7, "RUNNING", payload="no json")],
    )
    assert follow(spark, base) == {}
    # The stream stops here; it goes on from its checkpoint with what is new.
    put(spark, base, [event("open", 100, "RUNNING")], [event("open", 101, "RUNNING", seq=3)])
    found = follow(spark, base)
    assert {k[0] for k in found} == {"done", "broken", "lost"}
    done, broken, lost = (next(r for k, r in found.items() if k[0] == n) for n in ("done", "broken", "lost"))
    assert (done["status"], done["events"], done["duration_seconds"], done["timed_out"]) == ("COMPLETED", 2, 300, False)
    assert done["payload"] == '{"rows": 5}' and done["error_message"] is None
    assert (broken["status"], broken["error_message"]) == ("FAILED", "bad")
    assert (lost["status"], lost["timed_out"], lost["events"]) == ("FAILED", True, 2)
    assert lost["error_message"] == lc.NO_END % 3600
    # A run that had come out begins anew.
    put(spark, base, [event("done", 102, "COMPLETED")], [event("late", 400, "RUNNING")], [event("late", 401, "RUNNING")])
    found = follow(spark, base)
    assert sorted(k[0] for k in found) == ["broken", "done", "done", "lost", "open"]


def test_order_and_batches_do_not_matter(spark):
    draw = random.Random(4)
    events = [
        event(f"r{n % 5}", n, draw.choice(["RUNNING", "COMPLETED", "FAILED"]), f"e{n}", f'{{"n": {n}}}', n)
        for n in range(10)
    ]
    ends = [event("end", 500, "RUNNING"), event("end", 501, "RUNNING")]
    results = set()
    for size in (1, 4, 10):
        base = scratch_dir(spark, "shuffled")
        draw.shuffle(events)
        put(spark, base, *(events[i : i + size] for i in range(0, 10, size)), *([e] for e in ends))
        results.add(tuple(sorted(map(tuple, follow(spark, base).values()))))
    assert len(results) == 1 and len(next(iter(results))) == 5


def test_payloads_become_variants(spark):
    given = [event("a", 0, "X", payload='{"k": [1, 2]}'), event("b", 0, "X", payload="{"), event("c", 0, "X")]
    runs = lc.with_variant(spark.createDataFrame(given, lc.EVENT))
    rows = runs.selectExpr("workflow_id", "variant_get(payload, '$.k[1]', 'int') AS k").collect()
    assert {r["workflow_id"]: r["k"] for r in rows} == {"a": 2, "b": None, "c": None}


def test_the_stream_brings_its_own_store(spark):
    # As in a session that nobody has set up for state with timers.
    plain = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(st.STORE)
    spark.conf.set(st.STORE, plain)
    try:
        base = scratch_dir(spark, "lifecycle")
        put(spark, base, [event("done", 0, "COMPLETED")], [event("open", 99, "RUNNING")], [event("open", 100, "RUNNING")])
        stream = st.read_folder(spark, f"{base}/events", lc.EVENT, files_per_batch=1)
        lc.follow(lc.ended_runs(stream), f"{base}/runs", f"{base}/progress")
        assert spark.conf.get(st.STORE) == plain
    finally:
        spark.conf.set(st.STORE, before)
    assert [r["workflow_id"] for r in spark.read.schema(lc.ENDED).parquet(f"{base}/runs").collect()] == ["done"]


class Held:
    """Stands in for a handle with one value, and keeps the timers and the number of calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value, self.calls = value, self.calls + 1

    def clear(self):
        self.value = None

    def registerTimer(self, at):
        self.timers.add(at)
        self.calls += 1

    def deleteTimer(self, at):
        self.timers.remove(at)


class Times:
    def __init__(self, at):
        self.at = at

    def getCurrentWatermarkInMs(self):
        return self.at

    getExpiryTimeInMs = getCurrentWatermarkInMs


def chunk(*rows):
    """(run, second, seq, status) rows as a processor gets them."""
    columns = ["workflow_id", "last_us", "seq", "status"]
    made = pd.DataFrame([(r, s * 1_000_000, n, x) for r, s, n, x in rows], columns=columns)
    return made.assign(bucket=0, error_message=made["status"].str.lower(), payload=None)


def test_a_bucket_of_runs_is_one_call_with_one_timer():
    held = Held()
    runs = lc.Runs(dt.timedelta(seconds=10), dt.timedelta(seconds=100))
    runs.init(held)
    many = [(f"r{n}", n % 50, n, "COMPLETED" if n % 2 else "RUNNING") for n in range(5000)]
    assert list(runs.handleInputRows((0,), iter([chunk(*many[:2500]), chunk(*many[2500:])]), Times(0))) == []
    # However many runs there are, the state is set once, with a timer for the first to end.
    assert held.calls == 2 and held.timers == {11_000}
    list(runs.handleInputRows((0,), iter([chunk(("r1", 60, 0, "COMPLETED"), ("r1", 0, 0, "RUNNING"))]), Times(0)))
    assert held.timers == {11_000}
    (out,) = runs.handleExpiredTimer((0,), Times(30_000), Times(11_000))
    held.timers.remove(11_000)  # which Spark does
    ended = {n for n in range(5000) if n % 2 and n != 1 and n % 50 < 20}
    assert set(out["workflow_id"]) == {f"r{n}" for n in ended} and not out["timed_out"].any()
    assert held.timers == {31_000}
    (out,) = runs.handleExpiredTimer((0,), Times(10**9), Times(31_000))
    assert held.value is None and len(out) == 5000 - len(ended)
    one = out.set_index("workflow_id").loc["r1"]
    assert (one["first_us"], one["last_us"], one["events"], one["status"]) == (0, 60_000_000, 3, "COMPLETED")
    assert set(out["status"][out["timed_out"]]) == {"FAILED"}
    assert set(out["error_message"][out["timed_out"]]) == {lc.NO_END % 100}


def test_newest_event_of_a_run():
    held = Held()
    runs = lc.Runs(dt.timedelta(seconds=10), dt.timedelta(seconds=100))
    runs.init(held)

    def newest(*batches):
        held.value = None
        for batch in batches:
            list(runs.handleInputRows((0,), iter(batch), Times(0)))
        (row,) = lc._runs(held.value[0]).itertuples()
        return row.status, row.seq

    none = lc._NO_SEQ
    # Within a batch by time, seq (a missing one first) and status; a later batch wins a tie.
    assert newest([chunk(("a", 1, 5, "B"), ("a", 1, none, "Z"), ("a", 0, 9, "Y"))]) == ("B", 5)
    assert newest([chunk(("a", 1, 5, "B")), chunk(("a", 1, 5, "A"), ("a", 1, 5, None))]) == ("B", 5)
    assert newest([chunk(("a", 1, 5, "B"))], [chunk(("a", 1, 5, "A"))]) == ("A", 5)
    assert newest([chunk(("a", 1, 5, "B"))], [chunk(("a", 1, 4, "C"))]) == ("B", 5)
    assert newest([chunk(("a", 1, none, "B"))], [chunk(("a", 0, 4, "C"))]) == ("B", -1)


def test_runs_of_one_bucket_end_each_at_its_time(spark):
    names = [
        r["n"]
        for r in spark.range(20_000)
        .selectExpr("concat('r', id) AS n", f"pmod(xxhash64(concat('r', id)), {lc.BUCKETS}) AS b")
        .filter("b = 7")
        .limit(3)
        .collect()
    ]
    a, b, c = names
    base = scratch_dir(spark, "bucket")
    put(
        spark,
        base,
        [event(a, 0, "COMPLETED"), event(b, 0, "RUNNING"), event(c, 0, "RUNNING")],
        [event("clock", 30, "RUNNING")],
        [event("clock", 31, "RUNNING")],
    )
    assert {k[0] for k in follow(spark, base)} == {a}
    put(spark, base, [event(b, 32, "FAILED", "bad"), event("clock", 65, "RUNNING")], [event("clock", 66, "RUNNING")])
    found = {k[0]: r for k, r in follow(spark, base).items()}
    assert set(found) == {a, b}
    assert (found[b]["events"], found[b]["error_message"], found[b]["duration_seconds"]) == (2, "bad", 32 * 60)
    put(spark, base, [event("clock", 100, "RUNNING")], [event("clock", 101, "RUNNING")])
    found = {k[0]: r for k, r in follow(spark, base).items()}
    assert set(found) == {a, b, c} and found[c]["timed_out"]
