from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from berth.functions import text as tx
from berth.operators import textops as op


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column.alias("x")).collect()[0]["x"]


def test_tokens_and_words(spark):
    assert one(spark, "It's a_1 tést, ok?", tx.token_count(F.col("t"))) == 6
    assert one(spark, None, tx.token_count(F.col("t"))) == 0
    assert one(spark, "Élan, DER x9y", tx.words(F.col("t"))) == ["élan", "der", "x", "y"]


def test_classify(spark):
    df = spark.createDataFrame([("cat dog cat",), ("dog",), ("cat dog",), ("bird",), (None,)], "t string")
    rules = {"feline": ["cat"], "canine": ["dog"]}
    labels = [r["label"] for r in op.classify(df, "t", rules).collect()]
    assert labels == ["feline", "canine", "feline", "other", "other"]


def test_sentiment(spark):
    df = spark.createDataFrame([("good great bad",), ("awful",), ("plain",)], "t string")
    got = [r["sentiment"] for r in op.with_sentiment(df, "t").collect()]
    assert [round(x, 6) for x in got] == [0.333333, -1.0, 0.0]


def test_template(spark):
    df = spark.createDataFrame([("x {1}", None, 3)], "a string, b string, n int")
    filled = tx.fill_template("{0}|{1}|{2}|{0}|50%", F.col("a"), F.col("b"), F.col("n"))
    assert df.select(filled.alias("x")).collect()[0]["x"] == "x {1}||3|x {1}|50%"


def test_json_lists(spark):
    parse = tx.parse_list(F.col("t"), "struct<a: int>")
    assert [r["a"] for r in one(spark, '[{"a": 1}, {"a": 2}]', parse)] == [1, 2]
    assert [r["a"] for r in one(spark, '{"a": 1}', parse)] == [1]
    assert one(spark, "no json", parse) is None


def test_structured(spark):
    df = spark.createDataFrame([('{"a": "x", "b": "y"}',), ('{"a": "x"}',), ("{",), (None,)], "t string")
    rows = op.structured(df, "t", "a string, b string", ["a", "b"]).collect()
    assert [r["is_valid"] for r in rows] == [True, False, False, False]


def test_digest_counts_every_word_of_a_hot_group(spark):
    rows = [("hot", f"w{i % 50} common") for i in range(600)] + [("cold", "b a"), ("cold", "a")]
    df = spark.createDataFrame(rows, "g string, t string").repartition(8)
    got = {(r["g"], r["rank"]): (r["word"], r["frequency"]) for r in op.text_digest(df, "t", ["g"], 2).collect()}
    assert got[("hot", 1)] == ("common", 600) and got[("hot", 2)] == ("w", 600)
    assert got[("cold", 1)] == ("a", 2) and got[("cold", 2)] == ("b", 1)


def test_complete_takes_any_function(spark):
    df = spark.createDataFrame([(1, "one. two"), (2, "three")], "k int, t string")
    assert [r["completion"] for r in op.complete(df, "t").orderBy("k").collect()] == ["one", "three"]
    shout = op.complete(df, "t", lambda s: pd.Series([x.upper() for x in s]))
    assert [r["completion"] for r in shout.orderBy("k").collect()] == ["ONE. TWO", "THREE"]


def test_nearest_matches_brute_force(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    target = op.centroid(df, "embedding")
    got = [r["vec_id"] for r in op.nearest(df, "vec_id", "embedding", target, 7).collect()]
    scored = []
    for r in df.collect():
        v = r["embedding"]
        dot = sum(a * b for a, b in zip(v, target))
        scored.append((-dot / sum(a * a for a in v) ** 0.5, r["vec_id"]))
    assert got == [i for _, i in sorted(scored)[:7]]


def test_quotes_are_doubled(spark):
    assert one(spark, "it's", tx.quote_sql(F.col("t"))) == "it''s"
