"""From raw documents to packed sequences: toxic and poor texts go, near copies are thinned to
one each, and what stays is cut and packed.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run`` writes
what a stage returns as Parquet below the shared checkpoint folder and reads it again for the
next one. All stages but the last keep the columns of ``documents``. Labels are read from the
folder of the tables; without labels the first two stages keep everything.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from berth.llm import packing, quality, simhash, toxicity
from berth.llm.common import read, stored

#: No SQL says what the models and the packing do; tests hold the stages against brute force.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_ordinary(docs, model)


def drop_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality", drop_poor),
    ("simhash", drop_near_copies),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
