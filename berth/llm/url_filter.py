"""URL rules by a cascade of Bloom filters, in DataFrame operations only.

A rule (host, path) fits its host and all subdomains if the url's path starts with the rule's.
So a url fits one of a few keys: each suffix of its host with each prefix of its path that is as
long as the path of some rule. Which of these keys are rules is asked of a cascade: level one
encodes the rules' keys; level two those keys of the corpus that level one takes for rules by
mistake; level three the rules that level two takes for mistakes; and so on until a level makes
no mistake. Over the corpus's complete set of keys the answer is exact, so the urls need no join.

The filters are arrays of longs in the plan. Level one makes mistakes so seldom that there are about
as many of them as rules, so the levels grow with the number of rules, not with the corpus (level
one by a few bits a rule as the corpus grows); where a level would have more than MOST_BITS the
keys are joined instead, which is exact at any size.

Defined results: a null url, or one without ``://``, has an empty host and path and fits no rule;
a url that fits no rule is allowed, as a key that is not listed; repeated rows give repeated rows;
a null page_id is kept; of several fitting rules the longest wins (then the longest host); a rule
that is given twice counts once, and as blocked if its verdicts differ; without rules all is
allowed. Other columns of the pages are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from berth.llm.common import stored

#: Share of mistakes that a level may make; the first level has the one that ``first_rate`` says.
RATE = 0.3
#: A level of more bits than this (8 MB) is not put into the plan.
MOST_BITS = 1 << 26
#: Each level holds about RATE times as many keys as the one before the last.
MOST_LEVELS = 60


@dataclass(frozen=True)
class Level:
    """A Bloom filter: the words of its bits, and how many hashes each key has."""

    words: tuple[int, ...]
    hashes: int
    salt: int

    @property
    def bits(self) -> int:
        return 64 * len(self.words)


def host_of(url: str) -> Column:
    """Host of a url, A-Z lower-cased; empty for null or without ``://``."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://([^/?#]*)", 1)
    lowered = F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def path_of(url: str) -> Column:
    """Path of a url; empty for null or without ``://``."""
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://[^/?#]*(/[^?#]*)", 1)
    return F.coalesce(rest, F.lit(""))


def keys_of(host: str, path: str, lengths: Sequence[int]) -> Column:
    """All keys by which a rule could fit, the longest first (then the longest host)."""
    labels = F.split(F.col(host), r"\.")
    suffixes = F.when(
        F.col(host) != "",
        F.transform(
            F.sequence(F.lit(1), F.size(labels)),
            lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
        ),
    ).otherwise(F.array().cast("array<string>"))
    prefixes = F.array(
        *(F.when(F.length(path) >= n, F.substring(path, 1, n)) for n in sorted(set(lengths)))
    ).cast("array<string>")
    pairs = F.flatten(
        F.transform(
            suffixes,
            lambda s: F.transform(
                F.filter(prefixes, lambda p: p.isNotNull()),
                lambda p: F.struct(
                    (-F.length(s) - F.length(p)).alias("shorter"),
                    (-F.length(s)).alias("host"),
                    F.concat(s, p).alias("key"),
                ),
            ),
        )
    )
    return F.transform(F.array_sort(pairs), lambda x: x["key"])


def _positions(key: Column, hashes: int, bits: int, salt: int) -> list[Column]:
    """Where a key stands in a filter."""
    return [F.pmod(F.xxhash64(key, F.lit(64 * salt + k)), F.lit(bits)) for k in range(hashes)]


def contains(level: Level, key: Column) -> Column:
    """Whether the filter takes the key for one of its own."""
    words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")
    found = F.lit(True)
    for at in _positions(key, level.hashes, level.bits, level.salt):
        word = words[F.shiftright(at, 6).cast("int")]
        found = found & (F.getbit(word, (at % 64).cast("int")) == 1)
    return found


def bits_for(count: int, rate: float) -> int:
    return 64 * max(1, math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64))


def first_rate(listed: int, universe: int) -> float:
    """Share of mistakes of the first level that leaves about as many mistakes as there are listed
    keys, however many more the universe has: the levels' sizes follow the list alone."""
    return min(RATE, max(listed / max(universe - listed, 1) / math.sqrt(2), 1e-15))


def build_level(keys: DataFrame, rate: float, salt: int) -> Level | None:
    """A filter of the ``key`` column; None if there are no keys. Its bits are or-ed in the tasks
    and at most MOST_BITS of them come to the driver."""
    count = keys.count()
    if not count:
        return None
    bits = bits_for(count, rate)
    if bits > MOST_BITS:
        raise OverflowError(f"{count} keys need {bits} bits")
    hashes = max(1, round(-math.log2(rate)))
    places = keys.select(F.explode(F.array(*_positions(F.col("key"), hashes, bits, salt))).alias("at"))
    rows = (
        places.groupBy(F.shiftright("at", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, CAST(at % 64 AS INT)))").alias("bits"))
        .collect()
    )
    words = [0] * (bits // 64)
    for row in rows:
        words[row["word"]] = row["bits"]
    return Level(tuple(words), hashes, salt)


def build_cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels over two tables of distinct ``key``: the listed ones, and all that may be asked."""
    rate = first_rate(listed.count(), universe.count())
    ours = listed
    others = universe.join(listed, "key", "left_anti")
    levels: list[Level] = []
    while len(levels) < MOST_LEVELS:
        level = build_level(ours, RATE if levels else rate, len(levels))
        if level is None:
            break
        levels.append(level)
        # What this level wrongly takes for its own is what the next one holds.
        mistaken = others.where(contains(level, F.col("key")))
        ours, others = stored(mistaken, "level"), ours
    else:
        raise OverflowError("the cascade does not end")
    return levels


def in_cascade(levels: Sequence[Level], key: Column) -> Column:
    """Exact membership for keys of the universe: the first level that does not hold the key
    decides, and says no if its number is odd."""
    answer = F.lit(len(levels) % 2 == 1)
    for k in range(len(levels) - 1, -1, -1):
        answer = F.when(contains(levels[k], key), answer).otherwise(F.lit(k % 2 == 1))
    return answer


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, host, path, rule, verdict) of each page; rules are (verdict, host, path)."""
    split = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    given = (
        rules.groupBy(F.concat("host", "path").alias("key"))
        .agg(F.bool_or(F.col("verdict") == "block").alias("blocked"), F.max(F.length("path")).alias("n"))
        .where("key IS NOT NULL")
    )
    given = stored(given, "rules")
    lengths = [r["n"] for r in given.select("n").distinct().collect()]
    count = given.count()
    if not count:
        return split.select("*", F.lit(None).cast("string").alias("rule"), F.lit("allow").alias("verdict"))
    keyed = split.withColumn("keys", keys_of("host", "path", lengths))
    listed, barred = given.select("key"), given.where("blocked").select("key")
    # One row for each different key of the corpus, the listed ones among them.
    universe = stored(
        keyed.select(F.explode("keys").alias("key")).union(listed).distinct(), "keys"
    )
    try:
        rule_levels = build_cascade(listed, universe)
        block_levels = build_cascade(barred, universe)
    except OverflowError:
        return _joined(keyed, given)
    # The keys stand longest first.
    rule = F.get(F.filter("keys", lambda k: in_cascade(rule_levels, k)), F.lit(0))
    ruled = keyed.select("page_id", "host", "path", rule.alias("rule"))
    blocked = F.col("rule").isNotNull() & in_cascade(block_levels, F.col("rule"))
    return ruled.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def _joined(keyed: DataFrame, given: DataFrame) -> DataFrame:
    """The same by joins, for rule lists whose filters would be too large for the plan. Keys are
    joined once for each different host and path, however many pages have them."""
    found = (
        keyed.select("host", "path", "keys")
        .distinct()
        .select("host", "path", F.posexplode("keys").alias("at", "key"))
        .join(given, "key")
        .groupBy("host", "path")
        .agg(F.min(F.struct("at", "key", "blocked")).alias("best"))
    )
    return keyed.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", F.col("best.key").alias("rule"),
        F.when(F.col("best.blocked"), "block").otherwise("allow").alias("verdict"),
    )
