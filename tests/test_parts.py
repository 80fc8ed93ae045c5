"""Tables in parts and change logs in levels: what is rewritten, what survives a failure."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from berth.operators import load
from berth.operators.parts import PartTable
from berth.session import scratch_dir
from berth.sources.pointers import Conflict, Pointers, names
from berth.streaming import levels as lv
from berth.streaming import streams as st

LAYOUT = "k bigint, v string, at timestamp_ntz"
T0 = dt.datetime(2024, 1, 1)


def rows(spark, given, layout=LAYOUT):
    return spark.createDataFrame(given, layout)


def many(spark, n, v="a", day=1):
    return spark.range(n).selectExpr("id AS k", f"'{v}' AS v", f"TIMESTAMP_NTZ '2024-01-0{day}' AS at")


def values(df):
    return {r["k"]: r["v"] for r in df.collect()}


def new(spark, parts=64, load_column="at"):
    return PartTable.create(spark, scratch_dir(spark, "parts"), LAYOUT, ["k"], parts, load_column)


def test_the_first_rows_are_written_once(spark, monkeypatch):
    def fail(*args, **kwargs):
        raise AssertionError("the batch is written beside the table")

    monkeypatch.setattr(load, "write_snapshot", fail)
    table = new(spark)
    given = rows(spark, [(1, "a", T0), (1, "b", T0 + dt.timedelta(days=1)), (2, "c", T0), (None, "d", T0)])
    assert table.merge(given.limit(0), ["at"]).parts == ()
    done = table.merge(given, ["at"])
    assert values(table.read()) == {1: "b", 2: "c"}
    assert list(done.parts) == table.parts()
    assert table.state()[1]["mark"] == "2024-01-02 00:00:00"


def test_only_touched_parts_are_rewritten(spark):
    table = new(spark)
    table.merge(many(spark, 1000), ["at"])
    before = table.state()[1]["folders"]
    assert len(before) == 64
    files = set(table.read().inputFiles())
    done = table.merge(many(spark, 10, "b", 2), ["at"])  # one key in a hundred
    after = table.state()[1]["folders"]
    assert 0 < len(done.parts) <= 10
    assert {p for p in after if after[p] != before[p]} == set(done.parts)
    # Files of all other parts are the ones that were there.
    rewritten = {f for f in files if f.split("_part=")[1].split("/")[0] in done.parts}
    assert files - set(table.read().inputFiles()) == rewritten
    assert values(table.read()) == {k: "b" if k < 10 else "a" for k in range(1000)}


def test_a_merge_that_fails_before_the_swap_changes_nothing(spark, monkeypatch):
    table = new(spark, 8)
    table.merge(many(spark, 100), ["at"])
    number, state = table.state()

    def fail(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(PartTable, "_swap", fail)
    with pytest.raises(RuntimeError):
        table.merge(many(spark, 50, "b", 2), ["at"])
    monkeypatch.undo()
    assert table.state() == (number, state)
    assert set(values(table.read()).values()) == {"a"}
    table.merge(many(spark, 50, "b", 2), ["at"])
    assert sum(v == "b" for v in values(table.read()).values()) == 50
    assert len(names(spark, f"{table.base}/data")) == 3
    assert len(table.sweep()) == 2  # of the failed merge, and of the first, all of which was rewritten
    assert len(values(table.read())) == 100


def test_an_unfinished_state_is_passed_over(spark):
    table = new(spark, 4)
    table.merge(many(spark, 10), ["at"])
    number, _ = table.state()
    path = spark._jvm.org.apache.hadoop.fs.Path(table.states._path(number + 1))
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, False)
    out.write(bytearray(b'{"layout": '))
    out.close()
    assert table.state()[0] == number
    assert table.merge(many(spark, 5, "b", 2), ["at"]).number == number + 2
    assert sum(v == "b" for v in values(table.read()).values()) == 5


def test_of_two_writers_one_fails(spark):
    table = new(spark, 4)
    table.merge(many(spark, 10), ["at"])
    number, state = table.state()
    table.merge(many(spark, 5, "b", 2), ["at"])
    with pytest.raises(Conflict):
        table._swap(number, state)
    states = Pointers(spark, scratch_dir(spark, "states"))
    states.claim(0, {"n": 0})
    with pytest.raises(Conflict):
        states.claim(0, {"n": 1})
    assert states.update(lambda s: {"n": s["n"] + 5}) == 1
    assert states.current() == (1, {"n": 5})


def test_earlier_states_stay_readable(spark):
    table = new(spark, 8)
    numbers = [table.merge(many(spark, 20, v, d), ["at"]).number for d, v in ((1, "a"), (2, "b"), (3, "c"))]
    for number, v in zip(numbers, "abc", strict=True):
        assert set(values(table.read(number)).values()) == {v}
    table.sweep(states=2)
    assert set(values(table.read(numbers[1])).values()) == {"b"}


def test_loads_go_by_the_mark_in_the_state(spark):
    table = new(spark, 8)
    table.load(rows(spark, [(1, "a", T0), (2, "b", T0 + dt.timedelta(days=5))]))
    assert table.state()[1]["mark"] == "2024-01-06 00:00:00"
    source = rows(
        spark,
        [(1, "late", T0), (3, "tie", T0 + dt.timedelta(days=5)), (4, "new", T0 + dt.timedelta(days=6)),
         (None, "lost", T0 + dt.timedelta(days=9))],
    )
    table.load(source)
    assert values(table.read()) == {1: "a", 2: "b", 4: "new"}
    table.load(source, inclusive=True)
    assert table.state()[1]["mark"] == "2024-01-07 00:00:00"
    assert table.load(source).parts == ()
    other = new(spark, 4, None)
    with pytest.raises(ValueError):
        other.load(source)


def test_an_instant_as_mark_does_not_depend_on_the_zone(spark):
    layout = "k int, at timestamp"
    table = PartTable.create(spark, scratch_dir(spark, "zoned"), layout, ["k"], 2, "at")
    given = spark.sql("SELECT 1 AS k, timestamp_micros(1700000000123456) AS at")
    table.load(given)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert table.load(given).parts == ()
        assert table.load(spark.sql("SELECT 2 AS k, timestamp_micros(1700000000123457) AS at")).parts
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_kept_columns_deletes_and_unknown_columns(spark):
    table = new(spark, 4)
    table.merge(many(spark, 4), ["at"])
    flagged = many(spark, 6, "b", 2).withColumn("gone", F.col("k").isin(0, 5))
    table.merge(flagged, ["at"], keep=["v"], deleted="gone")
    assert values(table.read()) == {1: "a", 2: "a", 3: "a", 4: "b"}
    assert {r["at"].day for r in table.read().collect()} == {2}
    table.merge(flagged.filter("k = 1").withColumn("gone", F.lit(True)), ["at"], deleted="gone")
    assert values(table.read()) == {2: "a", 3: "a", 4: "b"}
    with pytest.raises(ValueError, match="more"):
        table.merge(many(spark, 1).withColumn("more", F.lit(1)), ["at"])
    table.merge(many(spark, 1).drop("v"), ["at"])
    assert values(table.read())[0] is None


def test_all_parts_may_be_emptied_and_the_table_rebuilt(spark):
    table = new(spark, 4)
    assert table.read().count() == 0
    table.merge(many(spark, 30), ["at"])
    table.rebuild(32)
    assert len(values(table.read())) == 30 and table.state()[1]["parts"] == 32
    table.merge(many(spark, 5, "b", 2), ["at"])
    assert sum(v == "b" for v in values(table.read()).values()) == 5
    table.merge(many(spark, 30, "c", 3).withColumn("gone", F.lit(True)), ["at"], deleted="gone")
    assert table.read().count() == 0 and table.state()[1]["folders"] == {}


def test_a_table_gets_more_columns(spark):
    table = new(spark, 4)
    table.merge(many(spark, 3), ["at"])
    wide = many(spark, 2, "b", 2).withColumn("more", F.lit(5))
    number = table.widen(wide.schema)
    assert table.widen(wide.schema) == number
    table.merge(wide, ["at"])
    assert {r["k"]: r["more"] for r in table.read().collect()} == {0: 5, 1: 5, 2: None}


def test_a_key_is_read_from_its_part(spark):
    table = new(spark, 16)
    table.merge(many(spark, 200), ["at"])
    found = table.keyed({"k": 77})
    assert values(found) == {77: "a"}
    assert len({f.split("_part=")[1].split("/")[0] for f in found.inputFiles()}) == 1


CHANGES = "k int, v string, at timestamp_ntz, gone boolean"


def change_log(spark, label):
    base = scratch_dir(spark, label)
    return base, lv.ChangeLog(spark, f"{base}/log", CHANGES, ["k"], ["at"], "gone")


def put(spark, base, *files):
    for given in files:
        rows(spark, given, CHANGES).coalesce(1).write.mode("append").parquet(f"{base}/files")


def follow(spark, base, log, progress="progress"):
    log.follow(st.read_folder(spark, f"{base}/files", CHANGES, files_per_batch=1), f"{base}/{progress}")


def day(n):
    return T0 + dt.timedelta(days=n)


def test_levels_equal_the_batches(spark):
    base, log = change_log(spark, "levels")
    assert log.current().count() == 0 and log.compact() == 0
    files = [[(k, f"v{n}", day(n if k % 2 else -n), False) for k in range(n, n + 6)] for n in range(9)]
    files.append([(4, "gone", day(100), True), (50, "never there", day(1), True)])
    files.append([(4, "late", day(50), False)])
    newest = {}
    for given in files:
        for k, v, at, gone in given:
            if k not in newest or at >= newest[k][0]:
                newest[k] = (at, v, gone)
        put(spark, base, given)
        follow(spark, base, log)
        log.compact(fan=2)
        assert values(log.current()) == {k: v for k, (_, v, gone) in newest.items() if not gone}
    merged = log._state()["merged"]
    assert max(m["level"] for m in merged) >= 3 and len(merged) <= 4
    gone = log.sweep()
    assert any(g.startswith("batches/") for g in gone) and any(g.startswith("merged/") for g in gone)
    assert values(log.current()) == {k: v for k, (_, v, gone) in newest.items() if not gone}


def test_a_batch_that_lands_during_a_merge_is_kept(spark, monkeypatch):
    base, log = change_log(spark, "landing")
    put(spark, base, *[[(n, "old", day(0), False)] for n in range(4)])
    follow(spark, base, log)
    update = Pointers.update

    def late(self, change):
        monkeypatch.undo()
        put(spark, base, [(9, "landed", day(1), False), (0, "newer", day(1), False)])
        follow(spark, base, log)
        return update(self, change)

    monkeypatch.setattr(Pointers, "update", late)
    assert log.compact(fan=4) == 1
    assert values(log.current()) == {0: "newer", 1: "old", 2: "old", 3: "old", 9: "landed"}
    assert sum(map(len, log.loose().values())) == 1


def test_a_new_checkpoint_replaces_nothing(spark):
    base, log = change_log(spark, "checkpoints")
    put(spark, base, [(1, "a", day(0), False)], [(2, "b", day(0), False)])
    follow(spark, base, log)
    put(spark, base, [(1, "A", day(0), False)])
    follow(spark, base, log, "another")  # reads all three files under its own id
    assert [len(n) for n in log.loose().values()] == [2, 3]
    assert values(log.current()) == {1: "A", 2: "b"}
    log.compact(fan=2)
    follow(spark, base, log)
    assert values(log.current()) == {1: "A", 2: "b"}


def test_a_batch_that_comes_again_replaces_itself(spark):
    base, log = change_log(spark, "again")
    put(spark, base, [(1, "a", day(0), False)], [(2, "b", day(0), False)])
    follow(spark, base, log)
    (stream,) = log.loose()
    rows(spark, [(2, "b", day(0), False)], CHANGES).write.mode("overwrite").parquet(
        f"{log.base}/batches/{stream}/1"
    )
    assert values(log.current()) == {1: "a", 2: "b"}
    # A batch without its mark of success is not there yet.
    rows(spark, [(3, "c", day(0), False)], CHANGES).write.parquet(f"{log.base}/batches/{stream}/2")
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{log.base}/batches/{stream}/2/_SUCCESS")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)
    assert values(log.current()) == {1: "a", 2: "b"}


