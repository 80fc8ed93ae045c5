from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from berth.operators import profile as prof
from berth.operators import sensitive as sens
from berth.sources import readers

PEOPLE = """customer_id,first_name,last_name,email,phone,date_of_birth,address,city,state,zip_code,account_created,account_status
1,Ada,Stone,ada@mail.example.org,555-201-0001,1971-01-02,1 Quay St,Alba,WA,10001,2021-01-01,ACTIVE
2,Ben,Reed,ben@mail.example.org,555-201-0002,1972-02-03,2 Quay St,Brin,WA,10002,2021-02-01,ACTIVE
3,Cleo,Marsh,cleo@mail.example.org,555-201-0003,1973-03-04,3 Quay St,Cove,WA,10003,2021-03-01,INACTIVE
4,Dov,Field,dov@mail.example.org,555-201-0004,1974-04-05,4 Quay St,Dale,WA,10004,2021-04-01,ACTIVE
5,Eva,Hill,eva@mail.example.org,555-201-0005,1975-05-06,5 Quay St,Elm,WA,10005,2021-05-01,SUSPENDED
6,Finn,Lake,finn@mail.example.org,555-201-0006,1976-06-07,6 Quay St,Fern,WA,10006,2021-06-01,ACTIVE
7,Gia,Wood,gia@mail.example.org,555-201-0007,1977-07-08,7 Quay St,Glen,WA,10007,2021-07-01,ACTIVE
8,Hal,Moor,hal@mail.example.org,555-201-0008,1978-08-09,8 Quay St,Holt,WA,10008,2021-08-01,INACTIVE
9,Ivy,Ford,ivy@mail.example.org,555-201-0009,1979-09-10,9 Quay St,Isle,WA,10009,2021-09-01,ACTIVE
10,Jon,Beck,jon@mail.example.org,555-201-0010,1980-10-11,10 Quay St,Jade,WA,10010,2021-10-01,ACTIVE
"""


@pytest.fixture(scope="module")
def people(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("people") / "people.csv"
    path.write_text(PEOPLE)
    return readers.read_csv(spark, str(path), infer=True)


def by_name(rows, key="column_name"):
    return {r[key]: r for r in rows.collect()}


def test_customer_file(people):
    rows = by_name(prof.profile(people))
    assert len(rows) == 12
    low = {n for n, r in rows.items() if r["cardinality"] == "LOW"}
    assert low == {"state", "account_status"}
    assert all(r["cardinality"] == "UNIQUE" for n, r in rows.items() if n not in low)
    types = dict(people.dtypes)
    assert types["customer_id"] == types["zip_code"] == "int"
    assert types["date_of_birth"] == types["account_created"] == "date"
    score = prof.quality_score(prof.profile(people)).collect()[0]
    assert (score["column_count"], score["data_quality_score"]) == (12, 98.33)
    issues = prof.quality_issues(prof.profile(people)).collect()
    assert [i["issue_type"] for i in issues] == ["LOW_CARDINALITY"] * 2
    assert {i["description"] for i in issues} == {
        "Column has only 1 distinct values",
        "Column has only 3 distinct values",
    }


def test_customer_file_findings(people):
    columns = prof.column_counts({"people": people})
    named = sens.name_findings(columns)
    found = {r["column_name"] for r in named.filter("pii_type IS NOT NULL").collect()}
    assert found == {"first_name", "last_name", "email", "phone", "address"}
    assert sens.table_risk(named).collect()[0]["pii_risk_level"] == "HIGH"
    values = by_name(sens.value_findings({"people": people}))
    assert {n: r["label"] for n, r in values.items()} == {
        "email": "EMAIL",
        "phone": "PHONE",
        "address": "ADDRESS",
        "date_of_birth": "DATE_OF_BIRTH",
    }
    assert values["email"]["sample_value_masked"] == "ada***"


def test_empty_and_null_tables(spark):
    layout = "a int, b string, c timestamp_ntz"
    empty = by_name(prof.profile(spark.createDataFrame([], layout)))
    assert [r["row_count"] for r in empty.values()] == [0, 0, 0]
    assert {r["cardinality"] for r in empty.values()} == {"UNIQUE"}
    assert {r["null_percentage"] for r in empty.values()} == {0.0}
    nulls = prof.profile(spark.createDataFrame([(None, None, None)] * 4, layout))
    rows = by_name(nulls)
    assert {r["cardinality"] for r in rows.values()} == {"LOW"}
    assert {r["distinct_count"] for r in rows.values()} == {0}
    assert {r["distinct_incl_null"] for r in rows.values()} == {1}
    assert {r["min_value"] for r in rows.values()} == {None}
    kinds = [i["issue_type"] for i in prof.quality_issues(nulls).collect()]
    assert sorted(kinds) == ["ALL_NULLS"] * 3 + ["HIGH_NULL_PERCENTAGE"] * 3
    assert prof.quality_score(nulls).collect()[0]["data_quality_score"] == 60.0
    none = prof.quality_score(nulls.filter("false")).collect()[0]
    assert none["data_quality_score"] == 0.0


def test_odd_types_and_names(spark):
    df = spark.sql(
        "SELECT id AS `a.b`, map('k', id) AS m, array(id % 2) AS l, struct(id AS x) AS s, "
        "id % 3 = 0 AS t, CAST(id AS decimal(20,4)) AS d, CAST(NULL AS date) AS `it's`, "
        "repeat(CAST(id % 4 AS string), 100) AS long FROM range(20)"
    )
    rows = by_name(prof.profile(df))
    assert rows["a.b"]["distinct_count"] == 20 and rows["a.b"]["max_value"] == "19"
    assert rows["m"]["error"].startswith("unsupported type map")
    assert rows["m"]["non_null_count"] == 20 and rows["m"]["cardinality"] is None
    assert rows["l"]["distinct_count"] == 2 and rows["s"]["distinct_count"] == 20
    assert rows["t"]["distinct_count"] == 2 and rows["d"]["max_value"] == "19.0000"
    assert rows["it's"]["null_count"] == 20
    assert rows["long"]["distinct_count"] == 4 and rows["long"]["max_length"] == 100


def test_exact_matches_brute_force_on_skewed_data(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("hot"),
        F.when(F.col("id") % 5 == 0, None).otherwise((F.col("id") % 40).cast("string")).alias("few"),
        (F.col("id") % 11 - 5.0).alias("number"),
    )
    rows = by_name(prof.profile(df))
    for name in df.columns:
        values = [r[0] for r in df.select(name).collect()]
        given = [v for v in values if v is not None]
        assert rows[name]["distinct_count"] == len(set(given))
        assert rows[name]["null_count"] == len(values) - len(given)
        assert rows[name]["min_value"] == str(min(given))
        assert rows[name]["max_value"] == str(max(given))
    approx = by_name(prof.profile(df, distinct="approx"))
    for name, row in rows.items():
        assert abs(approx[name]["distinct_count"] - row["distinct_count"]) <= max(
            2, 0.2 * row["distinct_count"]
        )


def test_percentiles_are_within_their_error(spark):
    df = spark.range(10001).select((F.col("id") * 7 % 10001).alias("v"))
    rows = {r["share"]: r["value"] for r in prof.percentiles(df, ["v"]).collect()}
    for share, value in rows.items():
        assert abs(value - share * 10000) <= 10


def test_profile_per_group_equals_profile_of_each_group(spark):
    df = spark.range(300).select((F.col("id") % 3).alias("g"), (F.col("id") % 17).alias("v"))
    grouped = {r["g"]: r for r in prof.profile(df, by=["g"]).collect()}
    for g, row in grouped.items():
        alone = prof.profile(df.filter(F.col("g") == g).select("v")).collect()[0]
        assert row["distinct_count"] == alone["distinct_count"]
        assert row["row_count"] == alone["row_count"]


def test_text_type_ladder(spark):
    rows = [
        ("1", "1", "1.5", "2024-02-29", "2024-01-01 10:00:00", "true", "x", None),
        ("-7", "9999999999", "2", "2024-01-31", "2024-01-01T11:00:00.25", "FALSE", "1", None),
        (None, "3", "1e3", None, "2024-01-01 10:00", "True", "2", None),
    ]
    df = spark.createDataFrame(rows, "i string, l string, d string, dt string, ts string, "
                                     "b string, s string, n string")
    got = {r["column_name"]: (r["data_type"], r["nullable"]) for r in prof.infer_text_schema(df).collect()}
    assert got == {
        "i": ("int", True),
        "l": ("bigint", False),
        "d": ("double", False),
        "dt": ("date", True),
        "ts": ("timestamp_ntz", False),
        "b": ("boolean", False),
        "s": ("string", False),
        "n": ("string", True),
    }
    bad_day = spark.createDataFrame([("2024-02-30",)], "d string")
    assert prof.infer_text_schema(bad_day).collect()[0]["data_type"] == "string"


def test_declared_schema(spark):
    df = spark.createDataFrame([(1, dt.date(2024, 1, 1))], "a int, b date")
    assert [r["data_type"] for r in prof.declared_schema(df).collect()] == ["int", "date"]


def test_types_give_values_back_as_they_were(spark):
    rows = [
        ("12345678901234567890", "00501", "+5", "1234567890.1234567890", "1e400", "9" * 39, "-0"),
        ("12345678901234567891", "10001", "7", "2", "1", "1", "5"),
    ]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string, f string, g string")
    types = {r["column_name"]: r["data_type"] for r in prof.infer_text_schema(df).collect()}
    assert types == {
        "a": "decimal(38,0)", "b": "string", "c": "string", "d": "decimal(38,18)", "e": "string",
        "f": "string", "g": "double",
    }
    for name, dtype in types.items():
        back = df.selectExpr(f"count(DISTINCT CAST({name} AS {dtype})) AS n").collect()[0]["n"]
        assert back == 2, name


def test_groups_named_by_null_keep_their_distinct_texts(spark):
    df = spark.createDataFrame([(None, "x"), (None, "y"), ("g", "x")], "g string, v string")
    rows = {r["g"]: r for r in prof.profile(df, by=["g"]).collect()}
    assert rows[None]["distinct_count"] == 2 and rows["g"]["distinct_count"] == 1


def test_collated_texts_are_counted_by_their_collation(spark):
    df = spark.sql(
        "SELECT s COLLATE UTF8_LCASE AS c, s AS b FROM VALUES (repeat('Ab', 40)), (repeat('aB', 40)), ('x') AS t(s)"
    )
    rows = by_name(prof.profile(df))
    assert rows["c"]["distinct_count"] == 2 and rows["b"]["distinct_count"] == 3
