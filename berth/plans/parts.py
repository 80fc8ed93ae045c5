"""Queries over tables in parts and change logs in levels: what several merges leave behind."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from berth.operators import dictionary as dic
from berth.operators.parts import PartTable
from berth.operators.runlog import instant
from berth.plans.dictionary import UPDATED, _upsert_sql, first_entries, next_entries
from berth.plans.registry import query, table
from berth.session import scratch_dir
from berth.streaming import streams as st
from berth.streaming.levels import ChangeLog

_ORDERS = "o_orderkey bigint, o_orderstatus string, o_totalprice double, loaded_at timestamp_ntz"
#: What is new in each load: orders from one day on, and older ones of some keys anew.
_DAYS = ["1996-01-01", "1997-06-01"]
_AGAIN = [50, 70]


def _source(spark, sf_dir, number: int) -> DataFrame:
    """The orders as the source has them at one of three loads."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate AS loaded_at"
    )
    if number < len(_DAYS):
        orders = orders.filter(f"loaded_at < TIMESTAMP_NTZ '{_DAYS[number]}'")
    if number:
        again = f"o_orderkey % {_AGAIN[number - 1]} = 0"
        orders = orders.withColumns(
            {
                "o_orderstatus": F.expr(f"if({again}, concat(o_orderstatus, '{number}'), o_orderstatus)"),
                "loaded_at": F.expr(
                    f"if({again}, greatest(loaded_at, TIMESTAMP_NTZ '{_DAYS[number - 1]}'), loaded_at)"
                ),
            }
        )
    return orders


def _loaded(spark, sf_dir) -> PartTable:
    curated = PartTable.create(
        spark, scratch_dir(spark, "orders-parts"), _ORDERS, ["o_orderkey"], 16, "loaded_at"
    )
    for number in range(3):
        curated.load(_source(spark, sf_dir, number))
    return curated


_FINAL = (
    "SELECT o_orderkey, CASE WHEN o_orderkey % 70 = 0 THEN o_orderstatus || '2' WHEN o_orderkey % 50 = 0 "
    "AND o_orderdate < TIMESTAMP '1997-06-01' THEN o_orderstatus || '1' ELSE o_orderstatus END AS "
    "o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 70 = 0 THEN greatest(o_orderdate, TIMESTAMP "
    "'1997-06-01') WHEN o_orderkey % 50 = 0 AND o_orderdate < TIMESTAMP '1997-06-01' THEN "
    "greatest(o_orderdate, TIMESTAMP '1996-01-01') ELSE o_orderdate END AS loaded_at FROM orders"
)


@query("parts_load", _FINAL)
def parts_load(spark, sf_dir):
    return _loaded(spark, sf_dir).read()


@query(
    "parts_states",
    "SELECT 1 AS state, count(*) AS records, CAST(0 AS BIGINT) AS again FROM orders WHERE o_orderdate < "
    "TIMESTAMP '1996-01-01' UNION ALL SELECT 2, count(*), count(*) FILTER (WHERE o_orderkey % 50 = 0) "
    "FROM orders WHERE o_orderdate < TIMESTAMP '1997-06-01' UNION ALL SELECT 3, count(*), count(*) "
    "FILTER (WHERE o_orderkey % 70 = 0 OR (o_orderkey % 50 = 0 AND o_orderdate < TIMESTAMP '1997-06-01')) "
    "FROM orders",
)
def parts_states(spark, sf_dir):
    curated = _loaded(spark, sf_dir)
    return reduce(
        DataFrame.unionByName,
        [
            curated.read(n).agg(
                F.lit(n).alias("state"),
                F.count("*").alias("records"),
                F.count_if(F.length("o_orderstatus") > 1).alias("again"),
            )
            for n in (1, 2, 3)
        ],
    )


@query(
    "parts_deletes",
    "SELECT l_orderkey, l_linenumber, max(l_quantity) AS l_quantity FROM lineitem "
    "WHERE l_orderkey % 20 <> 7 GROUP BY l_orderkey, l_linenumber",
)
def parts_deletes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    curated = PartTable.create(
        spark, scratch_dir(spark, "lines-parts"), lines.schema, ["l_orderkey", "l_linenumber"], 16
    )
    curated.merge(lines, ["l_quantity"])
    gone = lines.filter("l_orderkey % 20 = 7").withColumn("gone", F.lit(True))
    curated.merge(gone, ["l_quantity"], deleted="gone")
    return curated.read()


@query("parts_dictionary", _upsert_sql())
def parts_dictionary(spark, sf_dir):
    first, following = first_entries(spark, sf_dir), next_entries(spark, sf_dir)
    entries = PartTable.create(
        spark, scratch_dir(spark, "dictionary-parts"), first.schema, dic.DICTIONARY_KEY, 4
    )
    entries.merge(first, ["updated_at"])
    at = instant(UPDATED)
    following = following.withColumns({"created_at": at, "updated_at": at})
    entries.merge(
        following.select(*(c for c in first.columns if c in following.columns)),
        dic.UPDATED_FIELDS,
        keep=["created_at", "description"],
    )
    return entries.read()


_CHANGES = f"{_ORDERS}, gone boolean"


def _change_files(orders: DataFrame, path: str, first: int, last: int) -> None:
    """One file for each remainder of the key."""
    for n in range(first, last):
        orders.filter(F.col("o_orderkey") % 8 == n).coalesce(1).write.mode("append").parquet(path)


@query(
    "stream_change_levels",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 AND o_orderkey % 8 < 4 THEN lower(o_orderstatus) "
    "ELSE o_orderstatus END AS o_orderstatus, o_totalprice, CASE WHEN o_orderkey % 10 = 0 AND "
    "o_orderkey % 8 < 4 THEN o_orderdate + INTERVAL 1 DAY ELSE o_orderdate END AS loaded_at "
    "FROM orders WHERE o_orderkey % 33 <> 0",
)
def stream_change_levels(spark, sf_dir):
    base = scratch_dir(spark, "change-levels")
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate AS loaded_at", "false AS gone"
    )
    changes = ChangeLog(spark, f"{base}/log", _CHANGES, ["o_orderkey"], ["loaded_at"], "gone")
    later = F.col("loaded_at") + F.expr("INTERVAL 1 DAY")
    newer = orders.filter("o_orderkey % 10 = 0").withColumns(
        {"o_orderstatus": F.lower("o_orderstatus"), "loaded_at": later}
    )
    gone = orders.filter("o_orderkey % 33 = 0").withColumns({"gone": F.lit(True), "loaded_at": later + F.expr("INTERVAL 1 DAY")})

    def follow(progress: str) -> None:
        stream = st.read_folder(spark, f"{base}/files", _CHANGES, files_per_batch=2)
        changes.follow(stream, f"{base}/{progress}")

    _change_files(orders, f"{base}/files", 0, 8)
    follow("first")
    changes.compact(fan=2)
    _change_files(newer, f"{base}/files", 0, 4)
    follow("first")
    changes.compact(fan=2)
    # Deletes are read by a stream of its own, which also reads all the rest again.
    _change_files(gone, f"{base}/files", 0, 8)
    follow("second")
    changes.compact(fan=2)
    follow("first")
    return changes.current().drop("gone")
