from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from berth.functions import sensitive as sens
from berth.operators import sensitive as op

VALUES = {
    "123-45-6789": "SSN",
    "jane.roe@mail.example.org": "EMAIL",
    "+1 555-123-4567": "PHONE",
    "(555) 123-4567": "PHONE",
    "4111 1111 1111 1111": "CREDIT_CARD",
    "4111 1111 1111 1112": None,
    "12 Long Harbour Rd": "ADDRESS",
    "Jane Roe": "NAME",
    "José Ruiz": "NAME",
    "1984-07-09": "DATE_OF_BIRTH",
    "2023-07-09": None,
    "AB1234567": "PASSPORT",
    "MRN 0012345": "MEDICAL_RECORD_NUMBER",
    "HPN12345678": "HEALTH_PLAN",
    "E11.9": "DIAGNOSIS",
    "aspirin 81 mg": "PRESCRIPTION",
    "glucose 99 mg/dL": "LAB_RESULT",
    "jane@mail.example.org\n": None,
    "plain words": None,
    "": None,
}


def test_value_labels(spark):
    df = spark.createDataFrame([(v,) for v in VALUES], "v string")
    got = {r["v"]: r["label"] for r in df.withColumn("label", sens.value_label("v")).collect()}
    assert got == VALUES


def test_share_and_order_decide(spark):
    rows = [("a@b.example.org", "E11.9")] * 6 + [("none", "E11.9")] * 4 + [(None, "x")]
    df = spark.createDataFrame(rows, "c string, d string")
    found = {r["column_name"]: r for r in op.value_findings({"t": df}).collect()}
    assert found["c"]["label"] == "EMAIL" and found["c"]["match_share"] == 0.6
    assert found["d"]["kind"] == "PHI" and found["d"]["sample_value_masked"] == "***REDACTED***"
    assert {r["column_name"] for r in op.value_findings({"t": df}, 0.7).collect()} == {"d"}


def test_masked_text_has_no_match_left(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = op.text_findings(documents, "text")
    assert sum(r["pieces"] for r in before.collect()) > 0
    masked = documents.withColumn("text", sens.redact(F.col("text")))
    assert {r["pieces"] for r in op.text_findings(masked, "text").collect()} == {0}


def test_mask_columns(spark):
    df = spark.createDataFrame([("Jane Roe", "E11.9", 1), (None, None, 2)], "n string, d string, k int")
    rows = op.mask_columns(df, {"n": "NAME", "d": "DIAGNOSIS", "gone": "NAME"}).collect()
    assert [tuple(r) for r in rows] == [("Jan***", "***REDACTED***", 1), (None, None, 2)]
    digests = op.mask_columns(df, {"k": "SSN"}, digest=True).collect()
    assert len(digests[0]["k"]) == 64


def test_tags_stay_with_the_schema(spark):
    df = op.attach_tags(spark.range(1).toDF("a"), {"a": "PII"}).filter("a >= 0")
    assert df.schema["a"].metadata["tag"] == "PII"
    with pytest.raises(ValueError):
        op.attach_tags(df, {"a": "SECRET"})


def test_numbers_and_times_are_searched(spark):
    df = spark.sql(
        "SELECT 4111111111111111 AS card, 2015550123 AS phone, 2015550123 AS amount, "
        "TIMESTAMP '1980-02-03 00:00:00' AS birth_time, TIMESTAMP '1980-02-03 00:00:00' AS sold"
    )
    found = {r["column_name"]: r["label"] for r in op.value_findings({"t": df}).collect()}
    assert found == {"card": "CREDIT_CARD", "phone": "PHONE", "birth_time": "DATE_OF_BIRTH"}


def test_single_values_are_masked_where_a_column_has_no_finding(spark):
    df = spark.createDataFrame([("a@b.example.org",), ("none",), (None,), ("E11.9",)], "remark string")
    rows = [r["remark"] for r in op.mask_columns(df, {}, cells=True).collect()]
    assert rows == ["a@b***", "none", None, "***REDACTED***"]


def test_digits_without_the_check_digit_stay(spark):
    df = spark.createDataFrame([("order 1234567890123, card 4111 1111 1111 1111",), (None,)], "t string")
    rows = [r["t"] for r in df.select(sens.redact(F.col("t")).alias("t")).collect()]
    assert rows == ["order 1234567890123, card [CREDIT_CARD]", None]


def test_known_cards_are_hidden_in_longer_runs_of_digits_too(spark):
    card = "4845168114407329"
    texts = [f"at {card}. then 7536784127813050 {card} end", f"7536784127813050 {card}, {card}-{card[:4]}; {card}"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = [r["t"] for r in df.select(sens.redact(F.col("t")).alias("t")).collect()]
    assert not any(card in t for t in rows)
    assert rows[0] == "at [CREDIT_CARD]. then 7536784127813050 [CREDIT_CARD] end"
