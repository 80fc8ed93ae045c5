"""Expressions over whole text columns: tokens, labels, sentiment, extraction, templates."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD = r"\p{L}+"
TOKEN = r"[A-Za-z0-9_]+"

# A small general lexicon; callers with their own domain pass their own.
POSITIVE_WORDS = ["amazing", "best", "excellent", "good", "great", "happy", "love", "perfect"]
NEGATIVE_WORDS = ["awful", "bad", "broken", "hate", "poor", "sad", "terrible", "worst"]


def words(text: Column) -> Column:
    """Lower-case words of a text, letters of any script."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"), F.lit(1))


def token_count(text: Column) -> Column:
    """Number of runs of ASCII letters, digits and underscores; 0 for no text."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0))


def hits(found: Column, lexicon: Sequence[str]) -> Column:
    """How many of the words belong to the lexicon."""
    return F.size(F.filter(found, lambda w: w.isin(list(lexicon))))


def known_words(found: Column, *lexicons: Sequence[str]) -> Column:
    """Only the words that belong to any of the lexicons, in one pass over the words."""
    every = sorted({w for lexicon in lexicons for w in lexicon})
    return F.filter(found, lambda w: w.isin(every))


def best_label(found: Column, rules: dict[str, Sequence[str]], default: str = "other") -> Column:
    """Label with the most hits; ties go to the label listed first, no hits to the default."""
    scores = {label: hits(found, lexicon) for label, lexicon in rules.items()}
    top = F.array_max(F.array(*scores.values()))
    chain = F.when(top <= 0, default)
    for label, score in scores.items():
        chain = chain.when(score == top, label)
    return F.coalesce(chain, F.lit(default))


def sentiment(good: Column, bad: Column) -> Column:
    """(good - bad) / (good + bad), 0 where the text has neither."""
    return F.when(good + bad > 0, (good - bad) / (good + bad)).otherwise(F.lit(0.0))


def extract(text: Column, questions: dict[str, str]) -> Column:
    """Map from question to all answers; each question is a pattern with one group."""
    pairs = []
    for name, pattern in questions.items():
        pairs += [F.lit(name), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))]
    return F.create_map(*pairs)


def fill_template(template: str, *arguments: Column) -> Column:
    """Put the arguments into a template with places ``{0}``, ``{1}`` and so on."""
    pieces, filled = re.split(r"(\{[0-9]+\})", template), []
    for piece in pieces:
        if re.fullmatch(r"\{[0-9]+\}", piece):
            filled.append(F.coalesce(arguments[int(piece[1:-1])].cast("string"), F.lit("")))
        elif piece:
            filled.append(F.lit(piece))
    return F.concat(*filled)


def parse_list(text: Column, item_schema: str) -> Column:
    """JSON text as an array of items; a single object counts as a list of one.

    NULL for text that is neither, so that callers can fall back to a rule.
    """
    return F.from_json(text, f"array<{item_schema}>")


def quote_sql(text: Column) -> Column:
    """Double the single quotes, for text that goes into generated SQL."""
    return F.replace(text, F.lit("'"), F.lit("''"))
