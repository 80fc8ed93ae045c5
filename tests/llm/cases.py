"""Small tables with what real ones can hold: nulls, empty and long texts, repeats, odd columns."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

LONG = "the quick brown fox said idiot. " * 4000
TEXTS = [
    (1, "The cat sat on the mat and looked at the moon."),
    (2, "The cat sat on the mat and looked at the moon."),
    (3, None),
    (4, ""),
    (5, "   \n\t "),
    (6, "one two"),
    (7, LONG),
    (None, "A row without an id, it has words."),
    (8, "The cat sat on the mat and looked at the moon."),
    (8, "The cat sat on the mat and looked at the moon."),
    (9, "Ünïcödé 漢字 😀 mixed\nlines  and   blanks 12³ x<|endoftext|>y <s>"),
    (10, "released under the MIT License, see Apache LICENSE and the General Public License."),
]


def docs(spark, rows=TEXTS, extra=True):
    """doc_id and text, among columns whose names operators might want for themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if not extra:
        return df
    names = ["fp", "score", "rank", "row", "place", "y", "bucket", "_place", "held_out", "length"]
    return df.select(*(F.lit(k).alias(n) for k, n in enumerate(names)), "doc_id", "text")


def invented(n, seed=1):
    """n texts of invented words; every fifth is toxic, every seventh is junk."""
    draw = random.Random(seed)
    words = ["".join(draw.choice(["ba", "lo", "ti", "ner", "su", "mek"]) for _ in range(draw.randint(1, 4)))
             for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        said = [draw.choice(words) for _ in range(draw.randint(20, 60))]
        toxic, poor = i % 5 == 0, i % 7 == 0
        if toxic:
            for _ in range(3):
                said[draw.randrange(len(said))] = draw.choice(["gronk", "snarf", "vlurg"])
        if poor:
            said = [w.upper() + "!!" for w in said]
        rows.append((i, " ".join(said)))
        labels.append((i, 0 if poor else 1, 1 if toxic else 0))
    return rows, labels


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
