"""Operators over text columns. All but the digest are narrow: no shuffle at all."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from berth.functions import text as tx


def classify(
    df: DataFrame, column: str, rules: dict[str, Sequence[str]], default: str = "other"
) -> DataFrame:
    """Add ``label``: the label whose words occur most often in the text."""
    known = tx.known_words(tx.words(F.col(column)), *rules.values())
    return (
        df.withColumn("_known", known)
        .withColumn("label", tx.best_label(F.col("_known"), rules, default))
        .drop("_known")
    )


def text_filter(df: DataFrame, rule: Column) -> DataFrame:
    """Keep the rows for which the rule holds; NULL counts as no."""
    return df.filter(F.coalesce(rule, F.lit(False)))


def with_sentiment(
    df: DataFrame,
    column: str,
    positive: Sequence[str] = tx.POSITIVE_WORDS,
    negative: Sequence[str] = tx.NEGATIVE_WORDS,
) -> DataFrame:
    """Add ``sentiment`` between -1 and 1."""
    known = tx.known_words(tx.words(F.col(column)), positive, negative)
    return (
        df.withColumn("_known", known)
        .withColumn("_good", tx.hits(F.col("_known"), positive))
        .withColumn("_bad", tx.hits(F.col("_known"), negative))
        .withColumn("sentiment", tx.sentiment(F.col("_good"), F.col("_bad")))
        .drop("_known", "_good", "_bad")
    )


def extract(df: DataFrame, column: str, questions: dict[str, str]) -> DataFrame:
    """Add ``answers``: a map from question to all its answers in the text."""
    return df.withColumn("answers", tx.extract(F.col(column), questions))


def token_usage(
    df: DataFrame, column: str, by: Sequence[str], price_per_token: float = 0.0
) -> DataFrame:
    """Rows, tokens and their price per group."""
    return (
        df.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("texts"),
            F.sum(tx.token_count(F.col(column)).cast("bigint")).alias("tokens"),
        )
        .withColumn("cost", F.col("tokens") * F.lit(price_per_token))
    )


def structured(
    df: DataFrame, column: str, schema: str, required: Sequence[str]
) -> DataFrame:
    """Add ``parsed`` (typed by ``schema``) and ``is_valid``: parsed with all required fields."""
    parsed = df.withColumn("parsed", F.from_json(column, schema))
    complete = F.col("parsed").isNotNull()
    for field in required:
        complete = complete & F.col(f"parsed.{field}").isNotNull()
    return parsed.withColumn("is_valid", complete)


def _word_rows(df: DataFrame, column: str, *kept: str) -> DataFrame:
    """One row per word. The outer form spares a second tokenising for a size filter."""
    rows = df.select(*kept, F.explode_outer(tx.words(F.col(column))).alias("word"))
    return rows.filter(F.col("word").isNotNull())


def text_digest(df: DataFrame, column: str, by: Sequence[str], k: int = 10) -> DataFrame:
    """The k most frequent words per group, ties in alphabetical order.

    Words are counted per group with a map-side combine; the rank filter is applied
    to the counted words before they are brought together per group.
    """
    counted = (
        _word_rows(df, column, *by)
        .groupBy(*by, "word")
        .agg(F.count(F.lit(1)).alias("frequency"))
    )
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("frequency"), "word"))
    return counted.withColumn("rank", rank).filter(F.col("rank") <= k)


def first_sentence(prompts: pd.Series) -> pd.Series:
    """Default answer of ``complete``: the text up to its first full stop."""
    return prompts.str.split(".", n=1).str[0]


def complete(
    df: DataFrame,
    prompt: str,
    answer: Callable[[pd.Series], pd.Series] = first_sentence,
) -> DataFrame:
    """Add ``completion`` from any function over a batch of prompts.

    The function is called on Arrow batches where the rows are. It is the place for
    a model of the caller's choice; the default is a rule and calls nothing.
    """
    schema = T.StructType([*df.schema.fields, T.StructField("completion", T.StringType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(completion=answer(batch[prompt]))

    return df.mapInPandas(run, schema)


def hashed_terms(df: DataFrame, key: str, column: str, dimensions: int = 256) -> DataFrame:
    """Sparse term-frequency vector per row: (key, bucket, weight), words hashed to buckets.

    Words are hashed before anything is counted, so a row sends at most ``dimensions`` counts
    through the one shuffle."""
    bucket = F.conv(F.substring(F.md5(F.col("word").cast("binary")), 1, 6), 16, 10).cast("int")
    return (
        _word_rows(df, column, key)
        .groupBy(key, (bucket % dimensions).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("weight"))
    )


def nearest(
    df: DataFrame, key: str, vector: str, target: Sequence[float], k: int = 10
) -> DataFrame:
    """The k rows whose vectors have the largest cosine with the target vector.

    One scan with a bounded heap per task; the target is a parameter, not a table.
    """
    wanted = F.array(*[F.lit(float(x)) for x in target])
    length = sum(float(x) ** 2 for x in target) ** 0.5
    zero = F.lit(0.0)
    dot = F.aggregate(
        F.zip_with(F.col(vector), wanted, lambda a, b: a.cast("double") * b),
        zero,
        lambda total, x: total + x,
    )
    norm = F.sqrt(
        F.aggregate(
            F.col(vector), zero, lambda total, x: total + x.cast("double") * x.cast("double")
        )
    )
    cosine = F.when(norm * F.lit(length) > 0, dot / (norm * F.lit(length))).otherwise(zero)
    return (
        df.select(key, cosine.alias("cosine")).orderBy(F.desc("cosine"), F.asc(key)).limit(k)
    )


def centroid(df: DataFrame, vector: str) -> list[float]:
    """Mean vector; one row per dimension comes back to the driver."""
    means = (
        df.select(F.posexplode(vector).alias("position", "x"))
        .groupBy("position")
        .agg(F.avg("x").alias("mean"))
        .collect()
    )
    return [r["mean"] for r in sorted(means, key=lambda r: r["position"])]
