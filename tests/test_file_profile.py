"""Profiles by file: what is read again, files that change, go or are empty."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.operators.file_profile import FileProfile
from berth.plans import file_profiles
from berth.session import scratch_dir
from berth.sources.pointers import remove

SAME = ["column_name", "data_type", "row_count", "null_count", "non_null_count", "min_value", "max_value", "max_length"]


def some(spark, n, first=0):
    return spark.range(first, first + n).selectExpr(
        "id AS k",
        "CAST(id % 7 AS int) AS `odd name`",
        "IF(id % 5 = 0, NULL, concat('v', id % 11)) AS v",
        "CAST(id AS double) / 4 - 3 AS d",
        "CAST(id AS float) / 3 AS f",
        "DATE '1969-12-20' + CAST(id AS int) AS day",
        "timestamp_micros(id * 1000001 - 5) AS at",
        "TIMESTAMP_NTZ '1960-01-01 00:00:00' + make_dt_interval(0, 0, 0, id) AS ntz",
        "id % 2 = 0 AS b",
        "CAST(NULL AS string) AS nothing",
        "array(id % 3) AS a",
        "map('k', id) AS m",
    )


def rows(df):
    return sorted((tuple(r) for r in df.select(SAME).collect()), key=str)


@pytest.fixture
def folder(spark):
    return scratch_dir(spark, "profiled")


def test_only_new_files_are_read(spark, folder):
    some(spark, 50).coalesce(2).write.parquet(f"{folder}/one")
    files = FileProfile.create(spark, f"{folder}-known", some(spark, 1).schema)
    assert files.profile().agg(F.sum("row_count")).first()[0] == 0
    assert len(files.update([folder])) == 2
    assert files.update([folder]) == []
    some(spark, 30, first=1000).coalesce(1).write.parquet(f"{folder}/two")
    (added,) = files.update([folder])
    assert "/two/" in added
    whole = spark.read.schema(files.layout).parquet(f"{folder}/one", f"{folder}/two")
    shown = prof.profile(whole)
    assert rows(files.profile()) == rows(shown)
    about = {r["column_name"]: r["distinct_count"] for r in files.profile().collect()}
    exact = {r["column_name"]: r["distinct_count"] for r in shown.collect()}
    assert about["m"] is None and exact["m"] is None
    for name, n in exact.items():
        if n is not None:
            assert abs(about[name] - n) <= 0.08 * n + 1


def test_files_that_go_or_change_are_forgotten(spark, folder):
    for n in range(3):
        some(spark, 10, first=100 * n).coalesce(1).write.parquet(f"{folder}/{n}")
    files = FileProfile.create(spark, f"{folder}-known", some(spark, 1).schema)
    files.update([folder])
    remove(spark, f"{folder}/0")
    some(spark, 4, first=7000).coalesce(1).write.mode("overwrite").parquet(f"{folder}/1")
    assert len(files.update([folder])) == 1
    whole = spark.read.schema(files.layout).parquet(f"{folder}/1", f"{folder}/2")
    assert rows(files.profile()) == rows(prof.profile(whole))


def test_empty_files_are_known(spark, folder):
    some(spark, 0).coalesce(1).write.parquet(f"{folder}/none")
    files = FileProfile.create(spark, f"{folder}-known", some(spark, 1).schema)
    assert len(files.update([folder])) == 1
    assert files.update([folder]) == []
    assert {r["row_count"] for r in files.profile().collect()} == {0}


def test_the_files_of_the_query_are_written_by_as_many_tasks_as_read_the_table(spark, sf_dir, folder):
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").repartition(5).write.parquet(f"{folder}/lineitem.parquet")
    # What opening a file costs keeps these small ones apart.
    _, files = file_profiles._in_files(spark, folder, "lineitem", "l_orderkey")
    assert files.store.read().select("file").distinct().count() == 3 * 5
