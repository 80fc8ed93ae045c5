"""Physical plans: what must not and what must be in them."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.operators import runlog as log
from berth.operators import textops
from berth.plans import catalogue, profiling

QUERIES = catalogue.QUERIES
# These run whole jobs while they build their frame; their operators are covered elsewhere.
EAGER = ("stream_", "onboarding_", "read_", "append_", "insert_", "snapshot_", "failed_", "many_", "corrupt_",
         "platform_")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(EAGER)))
def test_no_pairing_of_whole_tables(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_approximate_profile_is_one_scan_without_value_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    plan = plan_of(prof.profile(df, distinct="approx"))
    assert "hashpartitioning" not in plan
    assert plan.count("FileScan") == 1


def test_exact_profile_reads_fixed_width_columns_once(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_partkey", "l_tax")
    plan = plan_of(prof.profile(df))
    assert plan.count("FileScan") == 2  # one per type, each with its own columns
    assert "Expand" not in plan


def test_rank_filters_apply_before_the_shuffle(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    frames = [
        log.latest(events, ["user_id"], ["ts", "event_id"]),
        textops.text_digest(documents, "text", ["lang"]),
        prof.top_values(events, ["event_type"]),
    ]
    for df in frames:
        plan = plan_of(df)
        assert plan.count("WindowGroupLimit") == 2


def test_time_window_reaches_the_scan(spark, sf_dir):
    import datetime as dt

    events = spark.read.parquet(f"{sf_dir}/events.parquet").withColumnRenamed("ts", "start_time")
    recent = events.filter(log.since(dt.datetime(2024, 1, 31), days=7)).select("event_id")
    plan = plan_of(recent)
    assert "GreaterThanOrEqual(ts" in plan
    assert "props" not in plan.split("ReadSchema")[1]


def test_newest_n_is_a_bounded_heap(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert "TakeOrderedAndProject" in plan_of(log.newest(events, 10, ["ts", "event_id"]))


def test_only_needed_columns_are_read(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").agg(F.sum("l_tax"))
    assert "struct<l_tax:double>" in plan_of(df)


def test_inference_of_a_wide_csv_is_one_scan(spark, sf_dir):
    from berth.operators import dictionary as dic
    from berth.session import scratch_dir

    path = scratch_dir(spark, "wide")
    cells = [f"{e} AS {n}" for n, e in profiling.WIDE_TEXT.items()]
    spark.read.parquet(f"{sf_dir}/customer.parquet").selectExpr(*cells).write.csv(path, header=True)
    text = spark.read.option("header", True).csv(path)
    assert len(text.columns) > 30
    assert plan_of(prof.infer_text_schema(text)).count("FileScan csv") == 1
    assert plan_of(dic.narrow_types({"wide": text})).count("FileScan csv") == 1


@pytest.mark.parametrize("name", ["runs_7d", "runs_24h", "runs_daily", "runs_monitor", "perf_overall"])
def test_report_windows_reach_the_scan(name, spark, sf_dir):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    scans = plan.split("FileScan")[1:]
    assert any("GreaterThanOrEqual(ts" in s for s in scans)
    older = [s for s in scans if "LessThan(ts" in s]
    assert older and all("props" not in s.split("ReadSchema")[1] for s in older)


def test_hashed_terms_shuffle_once(spark, sf_dir):
    plan = plan_of(QUERIES["hashed_terms"](spark, sf_dir))
    assert plan.count("Exchange") == 1
