from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import functions as F

from berth.operators import load
from berth.operators import runlog as log

T0 = dt.datetime(2024, 1, 1)
LAYOUT = "k int, v string, loaded_at timestamp_ntz"


def at(hours):
    return T0 + dt.timedelta(hours=hours)


def test_load_into_an_empty_table_takes_all(spark):
    empty = spark.createDataFrame([], LAYOUT)
    source = spark.createDataFrame([(1, "a", at(0)), (1, "b", at(1)), (2, "c", at(0))], LAYOUT)
    rows = load.incremental_load(empty, source, ["k"], "loaded_at").collect()
    assert sorted((r["k"], r["v"]) for r in rows) == [(1, "b"), (2, "c")]


def test_rows_at_the_mark(spark):
    existing = spark.createDataFrame([(1, "a", at(0)), (2, "b", at(5))], LAYOUT)
    source = spark.createDataFrame([(1, "late", at(1)), (3, "tie", at(5)), (4, "new", at(6))], LAYOUT)
    strict = load.incremental_load(existing, source, ["k"], "loaded_at").collect()
    assert {r["k"] for r in strict} == {1, 2, 4}
    loose = load.incremental_load(existing, source, ["k"], "loaded_at", inclusive=True)
    assert {r["k"]: r["v"] for r in loose.collect()} == {1: "a", 2: "b", 3: "tie", 4: "new"}
    again = load.incremental_load(loose, source, ["k"], "loaded_at", inclusive=True)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, loose.collect()))


def test_equally_new_rows_give_the_same_result_in_any_layout(spark):
    existing = spark.createDataFrame([], LAYOUT)
    rows = [(i % 5, f"v{i}", at(0)) for i in range(50)]
    results = set()
    for parts in (1, 3, 7):
        incoming = spark.createDataFrame(rows[parts:] + rows[:parts], LAYOUT).repartition(parts)
        merged = load.upsert(existing, incoming, ["k"], ["loaded_at"])
        results.add(tuple(sorted((r["k"], r["v"]) for r in merged.collect())))
    assert len(results) == 1


def test_snapshot_is_written_before_it_is_read(spark):
    df = spark.range(10).toDF("k")
    saved = load.write_snapshot(df)
    assert saved.count() == 10 and "parquet" in saved.inputFiles()[0]


def test_upsert_into_buckets_moves_only_the_batch(spark):
    import uuid

    name = f"curated_{uuid.uuid4().hex[:8]}"
    existing = spark.range(1000).selectExpr("id AS k", "'old' AS v", "TIMESTAMP_NTZ '2024-01-01' AS loaded_at")
    table = load.write_bucketed(existing, name, ["k"], 8)
    batch = spark.range(900, 1100).selectExpr("id AS k", "'new' AS v", "TIMESTAMP_NTZ '2024-01-02' AS loaded_at")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = load.upsert(table, batch, ["k"], ["loaded_at"])
        plan = merged._jdf.queryExecution().executedPlan().toString()
        kept = plan[plan.index("SortMergeJoin"):plan.index("WindowGroupLimit")]
        table_side = kept[: kept.index("FileScan")]
        assert "Bucketed: true" in plan and "Exchange" not in table_side
        assert merged.count() == 1100 and merged.filter("v = 'new'").count() == 200
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_validity_names_broken_rules(spark):
    df = spark.createDataFrame([(1, 5), (None, 5), (2, None)], "k int, v int")
    flagged = load.flag_validity(df, {"k given": F.col("k").isNotNull(), "v small": F.col("v") < 6})
    assert load.clean_rows(flagged).count() == 1
    broken = {tuple(r["violations"]) for r in load.reject_rows(flagged).collect()}
    assert broken == {("k given",), ("v small",)}


def steps(spark, rows):
    return spark.createDataFrame(
        rows,
        "workflow_id string, execution_id bigint, agent_name string, status string, "
        "start_time timestamp_ntz, duration_seconds decimal(10,2), tokens_used bigint, "
        "credits_used decimal(10,4), error_message string",
    )


def some_steps(spark, n=400):
    from decimal import Decimal

    random.seed(5)
    rows = []
    for i in range(n):
        run = "hot" if i % 3 == 0 else f"r{i % 37}"
        status = random.choice(["COMPLETED", "FAILED", "IN_PROGRESS"])
        agent = random.choice(["PROFILING", "DICTIONARY", "MAPPING"])
        moment = at(random.randint(0, 60) / 4)
        rows.append((run, i, agent, status, moment, Decimal(f"{i % 9}.25"), i % 50, Decimal("0.5"),
                     "boom" if status == "FAILED" else None))
    return rows, steps(spark, rows)


def test_latest_and_headers_match_brute_force(spark):
    rows, df = some_steps(spark)
    expected = {}
    for r in rows:
        if r[0] not in expected or (r[4], r[1]) > (expected[r[0]][4], expected[r[0]][1]):
            expected[r[0]] = r
    got = {r["workflow_id"]: r["execution_id"] for r in log.latest(df, ["workflow_id"], ["start_time", "execution_id"]).collect()}
    assert got == {k: v[1] for k, v in expected.items()}
    for header in log.run_headers(df).collect():
        assert header["status"] == expected[header["workflow_id"]][3]
        assert (header["end_time"] is None) == (header["status"] == "IN_PROGRESS")


def test_positions_of_a_hot_run_match_brute_force(spark):
    rows, df = some_steps(spark)
    expected = {}
    for run in {r[0] for r in rows}:
        ordered = sorted((r for r in rows if r[0] == run), key=lambda r: (r[4], r[1]))
        expected.update({r[1]: i + 1 for i, r in enumerate(ordered)})
    got = {r["execution_id"]: r["position"] for r in log.step_positions(df).collect()}
    assert got == expected


def test_sequence_holds_each_agent_once(spark):
    rows, df = some_steps(spark)
    got = {r["workflow_id"]: r["agent_sequence"] for r in log.step_sequence(df).collect()}
    for run, sequence in got.items():
        ordered = sorted((r for r in rows if r[0] == run), key=lambda r: (r[4], r[1]))
        assert sequence == list(dict.fromkeys(r[2] for r in ordered))


def test_lifecycle(spark):
    events = spark.createDataFrame(
        [
            ("a", "INITIATED", at(0), 1),
            ("a", "IN_PROGRESS", at(0), 2),
            ("a", "COMPLETED", at(2), 3),
            ("b", "INITIATED", at(1), 4),
        ],
        "workflow_id string, status string, at timestamp_ntz, seq int",
    )
    rows = {r["workflow_id"]: r for r in log.lifecycle(events).collect()}
    assert rows["a"]["status"] == "COMPLETED" and rows["a"]["duration_seconds"] == 7200
    assert rows["b"]["status"] == "INITIATED" and rows["b"]["ended_at"] is None


def test_no_rows_in_the_window(spark):
    _, df = some_steps(spark)
    far = dt.datetime(2030, 1, 1)
    summary = log.recent_summary(log.run_headers(df), far).collect()[0]
    assert summary["workflows_today"] == 0
    assert summary["avg_duration"] is None and summary["success_rate"] is None
    assert log.performance_by_agent(df, far).count() == 0
    assert log.status_of(log.run_headers(df), "nobody").count() == 0


def test_budget_levels(spark):
    from decimal import Decimal

    rows = [("r", i, "PROFILING", "COMPLETED", T0 + dt.timedelta(days=d), None, 1, Decimal(c), None)
            for i, (d, c) in enumerate([(0, "70"), (1, "6"), (2, "15"), (3, "9"), (31, "1")])]
    levels = [r["level"] for r in log.budget_levels(steps(spark, rows), 100).orderBy("day").collect()]
    assert levels == ["NONE", "NOTIFY", "SUSPEND", "SUSPEND_IMMEDIATE", "NONE"]


def test_metrics_and_removal(spark):
    rows, df = some_steps(spark, 60)
    metrics = log.step_metrics(df)
    assert metrics.count() == 120
    hot = df.filter("workflow_id = 'hot'").select("workflow_id").distinct()
    total = {(r["agent_name"], r["metric_type"]): r["total_value"] for r in log.metrics_of_runs(metrics, df, hot).collect()}
    for agent in {r[2] for r in rows if r[0] == "hot"}:
        mine = [r for r in rows if r[0] == "hot" and r[2] == agent]
        assert total[agent, "SUCCESS_RATE"] == sum(r[3] == "COMPLETED" for r in mine)
        assert total[agent, "EXECUTION_TIME"] == float(sum(r[5] for r in mine))
    assert log.remove_runs(df, hot).filter("workflow_id = 'hot'").count() == 0


def test_marks_of_any_type_and_zone(spark, monkeypatch):
    import time

    for zone in ("Asia/Tokyo", "America/New_York"):
        monkeypatch.setenv("TZ", zone)
        time.tzset()
        try:
            existing = spark.sql("SELECT 1 AS k, TIMESTAMP '2024-01-01 12:00:00' AS loaded_at")
            source = spark.sql(
                "SELECT k, loaded_at FROM VALUES (2, TIMESTAMP '2024-01-01 11:00:00'), "
                "(3, TIMESTAMP '2024-01-01 13:00:00') AS t(k, loaded_at)"
            )
            loaded = load.incremental_load(existing, source, ["k"], "loaded_at")
            assert {r["k"] for r in loaded.collect()} == {1, 3}
        finally:
            monkeypatch.undo()
            time.tzset()
    for low, mark, high, kind in (
        ("5", "9", "10", "bigint"), ("2024-01-01", "2024-02-01", "2024-03-01", "date"),
        ("a", "it's", "z", "string"), ("1.10", "1.20", "1.30", "decimal(10,2)"),
    ):
        existing = spark.createDataFrame([(1, mark)], "k int, m string").withColumn("m", F.col("m").cast(kind))
        source = spark.createDataFrame([(2, low), (3, high)], "k int, m string").withColumn("m", F.col("m").cast(kind))
        rows = load.incremental_load(existing, source, ["k"], "m").collect()
        assert {r["k"] for r in rows} == {1, 3}, kind


def test_rows_without_a_key_go_to_quarantine(spark):
    existing = spark.createDataFrame([(1, "a", at(0))], LAYOUT)
    incoming = spark.createDataFrame([(None, "x", at(1)), (None, "y", at(1)), (2, "b", at(1))], LAYOUT)
    merged = load.upsert(existing, incoming, ["k"], ["loaded_at"])
    assert sorted(r["k"] for r in merged.collect()) == [1, 2]
    again = load.upsert(merged, incoming, ["k"], ["loaded_at"])
    assert again.count() == 2
    assert sorted(r["v"] for r in load.rows_without_key(incoming, ["k"]).collect()) == ["x", "y"]


def test_the_stamp_reaches_a_table_that_had_none(spark):
    existing = spark.createDataFrame([(1, "a", at(0))], LAYOUT)
    source = spark.createDataFrame([(2, "b", at(1))], LAYOUT)
    rows = load.incremental_load(existing, source, ["k"], "loaded_at", updated_at=F.lit("now")).collect()
    assert {r["k"]: r["updated_at"] for r in rows} == {1: None, 2: "now"}


def test_positions_of_steps_without_run_or_time_and_of_one_hour(spark):
    rows, df = some_steps(spark, 60)
    odd = [(None, 900 + i, "A", "FAILED", at(0) if i else None, None, 1, None, None) for i in range(3)]
    odd += [("r0", 950, "A", "FAILED", None, None, 1, None, None)]
    odd += [("hot", 1000 + i, "A", "FAILED", at(1) + dt.timedelta(seconds=i), None, 1, None, None) for i in range(500)]
    df = df.unionByName(steps(spark, odd))
    got = {r["execution_id"]: r["position"] for r in log.step_positions(df).collect()}
    every = rows + odd
    assert len(got) == len(every)
    for run in {r[0] for r in every}:
        own = sorted((r[4] is not None, r[4] or T0, r[1]) for r in every if r[0] == run)
        assert [got[r[2]] for r in own] == list(range(1, len(own) + 1))


def test_headers_of_a_window_equal_all_headers_in_it(spark):
    rows, df = some_steps(spark, 300)
    odd = [(None, 800, "A", "FAILED", at(14), None, 1, None, None), (None, 801, "A", "FAILED", at(2), None, 1, None, None)]
    odd += [("late", 802, "A", "FAILED", at(14), None, 1, None, None), ("late", 803, "A", "COMPLETED", None, None, 1, None, None)]
    df = df.unionByName(steps(spark, odd))
    for hours in (1, 3, 8):
        window = log.since(at(15), hours=hours)
        every = log.run_headers(df).filter(window)
        some = log.headers_since(df, at(15), hours=hours).filter(window)
        assert sorted(map(str, some.collect())) == sorted(map(str, every.collect()))
