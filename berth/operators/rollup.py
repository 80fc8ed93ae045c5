"""Reports on runs from hourly rollups, kept up to date load by load.

Runs lie in parts by the hour in which they started (``parts``), and beside them one small row per
hour and status: how many runs, the sum, number and extremes of their durations, and a mergeable
sketch of their ids. A load of new or changed runs rewrites their hours only, late ones that of
their start, and rolls up again exactly the hours whose files are not those rolled up last; so a
load that fails between the two is made good by the next.

A report reads the rollups of the whole hours in its window and, where the window begins within an
hour, the runs of that hour. Which files these are is known from the states, so nothing older is
opened, however long the history.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from berth.operators import runlog as log
from berth.operators.parts import PartTable

RUNS = (
    "workflow_id string, status string, start_time timestamp_ntz, end_time timestamp_ntz, "
    "duration_seconds decimal(20,2), error_message string, step_count bigint, updated_at timestamp_ntz"
)
HOURS = (
    "start_hour timestamp_ntz, status string, runs bigint, duration_sum decimal(30,2), "
    "durations bigint, shortest decimal(20,2), longest decimal(20,2), ids binary"
)
_LABEL = "yyyyMMddHH"


def roll(runs: DataFrame) -> DataFrame:
    """One row per start hour and status of the runs."""
    hour = F.date_trunc("HOUR", "start_time").cast("timestamp_ntz")
    return runs.groupBy(hour.alias("start_hour"), "status").agg(
        F.count("*").alias("runs"),
        F.sum("duration_seconds").cast("decimal(30,2)").alias("duration_sum"),
        F.count("duration_seconds").alias("durations"),
        F.min("duration_seconds").alias("shortest"),
        F.max("duration_seconds").alias("longest"),
        F.hll_sketch_agg("workflow_id").alias("ids"),
    )


def _label(moment: dt.datetime) -> str:
    return f"{moment:%Y%m%d%H}"


class RunReports:
    """Runs and their rollups below ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.runs = PartTable(spark, f"{base.rstrip('/')}/runs")
        self.hours = PartTable(spark, f"{base.rstrip('/')}/hours")

    @classmethod
    def create(cls, spark: SparkSession, base: str) -> RunReports:
        made = cls(spark, base)
        keys = ["workflow_id", "start_time"]
        PartTable.create(spark, made.runs.base, RUNS, keys, f"date_format(start_time, '{_LABEL}')")
        PartTable.create(
            spark, made.hours.base, HOURS, ["start_hour", "status"], f"date_format(start_hour, '{_LABEL}')"
        )
        return made

    def load(self, runs: DataFrame) -> list[str]:
        """Take new and changed runs, the newest by ``updated_at``, and roll up their hours, which
        are returned. The start of a run never changes; runs without one are left out."""
        self.runs.merge(runs, ["updated_at"])
        return self.refresh()

    def refresh(self) -> list[str]:
        """Roll up the hours that have changed since they were last."""
        number, state = self.runs.state()
        seen = self.hours.state()[1].get("note") or {}
        folders = state["folders"]
        changed = sorted(h for h in {*folders, *seen} if folders.get(h) != seen.get(h))
        if changed:
            self.hours.replace(roll(self.runs.read(number, changed)), changed, note=folders)
        return changed

    def _edges(self, since: dt.datetime) -> tuple[list[str], list[str]]:
        """Hours of the window from ``since`` on that lie in it whole, and the one that does not."""
        begun = since.replace(minute=0, second=0, microsecond=0)
        label = _label(begun)
        known = self.hours.parts()
        if begun == since:
            return [h for h in known if h >= label], []
        return [h for h in known if h > label], [h for h in known if h == label]

    def window(self, as_of: dt.datetime, span: dt.timedelta) -> DataFrame:
        """Rolled up runs that started in the span before ``as_of``."""
        since = as_of - span
        whole, cut = self._edges(since)
        rows = self.hours.read(parts=whole)
        if cut:
            first = self.runs.read(parts=cut).filter(F.col("start_time") >= log.instant(since))
            rows = rows.unionByName(roll(first))
        return rows

    def listed(self, as_of: dt.datetime, span: dt.timedelta) -> DataFrame:
        """The runs that started in the span before ``as_of``."""
        since = as_of - span
        whole, cut = self._edges(since)
        return self.runs.read(parts=[*cut, *whole]).filter(F.col("start_time") >= log.instant(since))

    def totals(self, as_of: dt.datetime, days: int = 7) -> DataFrame:
        def of(status: str | None):
            runs = F.col("runs") if status is None else F.when(F.col("status") == status, F.col("runs"))
            return F.coalesce(F.sum(runs), F.lit(0))

        return self.window(as_of, dt.timedelta(days=days)).agg(
            of(None).alias("total_workflows"),
            of("COMPLETED").alias("completed"),
            of("FAILED").alias("failed"),
            of("IN_PROGRESS").alias("in_progress"),
        )

    def recent_summary(self, as_of: dt.datetime, hours: int = 24) -> DataFrame:
        done = F.when(F.col("status") == "COMPLETED", F.col("runs")).otherwise(0)
        return self.window(as_of, dt.timedelta(hours=hours)).agg(
            F.coalesce(F.sum("runs"), F.lit(0)).alias("workflows_today"),
            _mean().alias("avg_duration"),
            F.try_divide(F.sum(done).cast("double") * 100, F.sum("runs")).alias("success_rate"),
        )

    def distinct_estimate(self, as_of: dt.datetime, days: int) -> DataFrame:
        """About how many different runs started, from the sketches of the hours."""
        merged = F.hll_sketch_estimate(F.hll_union_agg("ids"))
        return self.window(as_of, dt.timedelta(days=days)).agg(F.coalesce(merged, F.lit(0)).alias("runs"))

    def per_day(self, as_of: dt.datetime, days: int = 7) -> DataFrame:
        day = F.date_trunc("DAY", "start_hour").cast("timestamp_ntz")
        rows = self.window(as_of, dt.timedelta(days=days))
        return rows.groupBy(day.alias("day"), "status").agg(F.sum("runs").alias("count"))

    def monitor(self, as_of: dt.datetime, statuses: Sequence[str], days: int, n: int = 50) -> DataFrame:
        return log.monitor(self.listed(as_of, dt.timedelta(days=days)), as_of, statuses, days, n)

    def performance(self, as_of: dt.datetime, hours: int = 1) -> DataFrame:
        def of(status: str):
            return F.coalesce(F.sum(F.when(F.col("status") == status, F.col("runs"))), F.lit(0))

        return self.window(as_of, dt.timedelta(hours=hours)).agg(
            F.coalesce(F.sum("runs"), F.lit(0)).alias("total_workflows"),
            _mean().alias("avg_duration"),
            F.min("shortest").cast("double").alias("min_duration"),
            F.max("longest").cast("double").alias("max_duration"),
            of("COMPLETED").alias("completed_count"),
            of("FAILED").alias("failed_count"),
        )


def _mean():
    return F.try_divide(F.sum("duration_sum").cast("double"), F.sum("durations"))
