"""Hourly rollups: which hours are rewritten and read, late runs, failures between two steps."""

from __future__ import annotations

import datetime as dt

import pytest

from berth.operators import runlog as log
from berth.operators.parts import PartTable
from berth.operators.rollup import RUNS, RunReports
from berth.session import scratch_dir

T0 = dt.datetime(2024, 1, 1)
AS_OF = dt.datetime(2024, 1, 2, 6)


def run(n, hours, status="COMPLETED", seconds=10, version=1):
    start = T0 + dt.timedelta(hours=hours)
    return (f"r{n}", status, start, start, seconds, None, 1, T0 + dt.timedelta(days=version))


def rows(spark, given):
    text = [(a, b, c, d, str(e) if e is not None else None, f, g, h) for a, b, c, d, e, f, g, h in given]
    layout = RUNS.replace("decimal(20,2)", "string")
    return spark.createDataFrame(text, layout).selectExpr(
        *(f"CAST({c.split(' ')[0]} AS {c.split(' ')[1]}) AS {c.split(' ')[0]}" for c in RUNS.split(", "))
    )


def made_of(spark, n):
    made = RunReports.create(spark, scratch_dir(spark, "reports"))
    made.load(rows(spark, [run(k, k * 0.75, seconds=k % 7, status=["COMPLETED", "FAILED"][k % 2]) for k in range(n)]))
    return made


@pytest.fixture(scope="module")
def reports(spark):
    return made_of(spark, 40)


@pytest.fixture
def own_reports(spark):
    return made_of(spark, 12)


def plain(reports, since):
    return reports.runs.read().filter(log.F.col("start_time") >= log.instant(since))


@pytest.mark.parametrize("as_of", [AS_OF, AS_OF + dt.timedelta(minutes=20), AS_OF + dt.timedelta(days=90)])
def test_reports_equal_those_on_all_runs(reports, as_of):
    for days in (1,):
        runs = plain(reports, as_of - dt.timedelta(days=days))
        pairs = [
            (reports.totals(as_of, days), log.totals(runs, as_of, days)),
            (reports.recent_summary(as_of, days * 24), log.recent_summary(runs, as_of, days * 24)),
            (reports.per_day(as_of, days), log.per_day(runs, as_of, days)),
            (reports.performance(as_of, days * 24), log.performance(runs, as_of, days * 24)),
            (reports.monitor(as_of, ["FAILED"], days, 5), log.monitor(runs, as_of, ["FAILED"], days, 5)),
        ]
        for got, expected in pairs:
            assert got.columns == expected.columns
            assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


def test_late_and_changed_runs_rewrite_their_hours_only(spark, own_reports):
    reports = own_reports
    before = set(reports.runs.read().inputFiles()) | set(reports.hours.read().inputFiles())
    changed = [run(8, 6, status="FAILED", version=2), run(1000, 2.2, version=2), run(1001, 400.5, version=2)]
    assert reports.load(rows(spark, changed)) == ["2024010102", "2024010106", "2024011716"]
    after = set(reports.runs.read().inputFiles()) | set(reports.hours.read().inputFiles())
    assert {f.split("_part=")[1].split("/")[0] for f in before - after} == {"2024010102", "2024010106"}
    totals = reports.totals(AS_OF, days=20).first()
    assert (totals["total_workflows"], totals["failed"]) == (14, 7)
    # The status that an hour no longer has is gone.
    hour = {r["status"]: r["runs"] for r in reports.hours.read(parts=["2024010106"]).collect()}
    assert hour == {"FAILED": 2}
    assert reports.load(rows(spark, [])) == []


def test_only_hours_of_the_window_are_opened(reports):
    as_of = dt.datetime(2024, 1, 2, 0, 30)
    files = reports.window(as_of, dt.timedelta(hours=6)).inputFiles()
    labels = sorted(f.split("_part=")[1].split("/")[0] for f in files)
    assert min(labels) == "2024010118" and len(set(labels)) == 12 < len(reports.hours.parts()) == 30
    cut = [f for f in files if "/runs/" in f]
    assert {f.split("_part=")[1].split("/")[0] for f in cut} == {"2024010118"}
    assert all("/hours/" in f for f in files if f not in cut)


def test_what_a_failed_load_left_undone_is_rolled_up_by_the_next(spark, own_reports, monkeypatch):
    reports = own_reports

    def fail(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(PartTable, "replace", fail)
    with pytest.raises(RuntimeError):
        reports.load(rows(spark, [run(2000, 3.5, version=2)]))
    monkeypatch.undo()
    assert reports.totals(AS_OF, days=20).first()["total_workflows"] == 12
    assert reports.refresh() == ["2024010103"]
    assert reports.totals(AS_OF, days=20).first()["total_workflows"] == 13
    assert reports.refresh() == []


def test_sketches_tell_about_how_many(reports):
    assert abs(reports.distinct_estimate(AS_OF, 20).first()["runs"] - 40) <= 3
    assert reports.distinct_estimate(AS_OF + dt.timedelta(days=400), 1).first()["runs"] == 0
