"""Run reports from hourly rollups that several loads have kept up to date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from berth.operators import runlog as log
from berth.operators.rollup import RunReports
from berth.plans import runlog
from berth.plans.registry import SQL, query
from berth.plans.runlog import AS_OF
from berth.session import scratch_dir

#: The log comes in three loads; runs of the day of a cut are loaded again with their later steps.
_CUTS = [dt.datetime(2024, 1, 20, 12), dt.datetime(2024, 1, 29, 18), AS_OF]


_MADE: dict[tuple[str, str], RunReports] = {}


def _reports(spark, sf_dir) -> RunReports:
    """Reports after three loads; they are made once for all queries of a session."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MADE:
        _MADE[key] = _loaded(spark, sf_dir)
    return _MADE[key]


def _loaded(spark, sf_dir) -> RunReports:
    reports = RunReports.create(spark, scratch_dir(spark, "run-reports"))
    steps = runlog.steps(spark, sf_dir)
    before = None
    for cut in _CUTS:
        known = steps.filter(F.col("start_time") < log.instant(cut))
        if before is not None:
            touched = known.filter(F.col("start_time") >= log.instant(before)).select("workflow_id").distinct()
            known = known.join(touched, "workflow_id", "left_semi")
        headers = log.run_headers(known)
        reports.load(headers.withColumn("updated_at", log.instant(cut)))
        before = cut
    return reports


@query("rollup_runs_7d", SQL["runs_7d"])
def rollup_runs_7d(spark, sf_dir):
    return _reports(spark, sf_dir).totals(AS_OF)


@query("rollup_runs_24h", SQL["runs_24h"])
def rollup_runs_24h(spark, sf_dir):
    return _reports(spark, sf_dir).recent_summary(AS_OF, hours=48)


@query("rollup_runs_daily", SQL["runs_daily"])
def rollup_runs_daily(spark, sf_dir):
    return _reports(spark, sf_dir).per_day(AS_OF)


@query("rollup_runs_monitor", SQL["runs_monitor"])
def rollup_runs_monitor(spark, sf_dir):
    return runlog.shown(_reports(spark, sf_dir).monitor(AS_OF, ["FAILED", "IN_PROGRESS"], days=14))


@query("rollup_perf_overall", SQL["perf_overall"])
def rollup_perf_overall(spark, sf_dir):
    return _reports(spark, sf_dir).performance(AS_OF, hours=26)


@query(
    "rollup_distinct_within_bounds",
    f"{runlog._WITH} SELECT count(*) AS runs, true AS within FROM runs WHERE start_time >= "
    f"TIMESTAMP '{AS_OF:%Y-%m-%d %H:%M:%S}' - INTERVAL 14 DAY",
)
def rollup_distinct_within_bounds(spark, sf_dir):
    reports = _reports(spark, sf_dir)
    # Sketches of 2^12 places are right within five times their standard error of 1.6 percent.
    about = F.hll_sketch_estimate(F.hll_union_agg("ids"))
    return reports.window(AS_OF, dt.timedelta(days=14)).agg(
        F.coalesce(F.sum("runs"), F.lit(0)).alias("runs"),
        (F.abs(about - F.sum("runs")) <= 0.08 * F.sum("runs") + 1).alias("within"),
    )
