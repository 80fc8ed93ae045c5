"""The queries of this folder, by name, and the SQL twins of those that SQL can say."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from berth.llm import (
    best_position,
    chat,
    context_tree,
    filter_audit,
    licenses,
    multi_index,
    packing,
    pieces,
    quality,
    simhash,
    small_world,
    toxicity,
    url_filter,
)
from berth.llm.common import read
from berth.operators.layout import local_rows

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op5_packing")
def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), added=True)


@query("op2_sentencepiece")
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return pieces.digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return toxicity.score(docs, toxicity.fit(docs, labels))


#: The rules of the url query.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


@query(
    "op9_url_filter",
    r"""
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(/[^?#]*)', 1), '') AS path
  FROM pages),
judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com'))
                   AND starts_with(path, '/en/') THEN 'www.example.com/en/'
              WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
                   AND starts_with(path, '/en/') THEN 'example.com/en/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
              WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
              WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
         END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
""",
)
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = local_rows(spark, RULES, "verdict string, host string, path string")
    return url_filter.judge(read(spark, sf_dir, "pages"), rules)


@query("op7_simhash")
def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.groups(read(spark, sf_dir, "documents"))


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return quality.score(docs, quality.fit(docs, labels))


@query("op10_licenses")
def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read(spark, sf_dir, "documents"))


@query(
    "op3_chat",
    r"""
WITH said AS (
  SELECT conv_id, turn,
         coalesce(nullif(regexp_replace(trim(role), '[^0-9A-Za-z\x{80}-\x{10FFFF}_.-]', '_', 'g'), ''),
                  'unnamed') AS speaker,
         replace(coalesce(text, ''), '<|', '< |') AS text
  FROM conversations),
participants AS (
  SELECT DISTINCT conv_id AS own_conv, speaker AS perspective FROM said WHERE speaker <> 'system'),
seen AS (
  SELECT conv_id, perspective, turn, text,
         CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
              ELSE 'user' END AS role,
         CASE WHEN speaker NOT IN ('system', perspective) THEN speaker END AS name
  FROM said JOIN participants ON conv_id IS NOT DISTINCT FROM own_conv),
headed AS (
  SELECT *, '<|im_start|>' || role || coalesce(' name=' || name, '') || chr(10) AS head FROM seen)
SELECT conv_id, perspective, turn, role, name,
       head || text || '<|im_end|>' || chr(10) AS rendered,
       CAST(CASE WHEN role = 'assistant' THEN length(head) ELSE 0 END AS INTEGER) AS learn_from,
       CAST(CASE WHEN role = 'assistant' THEN length(head) + length(text) + 10 ELSE 0 END AS INTEGER)
         AS learn_to
FROM headed
""",
)
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.rotate(read(spark, sf_dir, "conversations"))


@query("op6_multi_index")
def op6_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multi_index.search(read(spark, sf_dir, "embeddings"), every=20)


@query("op4_small_world")
def op4_small_world(spark: SparkSession, sf_dir: str) -> DataFrame:
    return small_world.near_duplicates(read(spark, sf_dir, "embeddings"))


@query(
    "op11_filter_audit",
    r"""
WITH RECURSIVE said AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text FROM documents),
marks AS (
  SELECT doc_id AS of_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good,
         coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
  FROM labels GROUP BY doc_id),
worded AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM said),
failed AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CAST(len(words) < 200 AS INT)
         + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 2 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
         + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS fails
  FROM worded LEFT JOIN marks ON doc_id = of_id),
counted AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY part, fails),
grown AS (
  SELECT '' AS o
  UNION ALL
  SELECT o || f FROM grown, unnest(['A', 'B', 'C', 'D', 'E']) AS t(f) WHERE NOT contains(o, f)),
steps AS (
  SELECT o, s AS step, 1 << (instr('ABCDE', o[s]) - 1) AS own,
         CAST(list_sum(list_transform(range(1, s), lambda i: 1 << (instr('ABCDE', o[i]) - 1))) AS INT) AS before
  FROM grown, range(1, 6) AS r(s) WHERE length(o) = 5),
told AS (
  SELECT part, o, step, own,
         sum(CASE WHEN (fails & (coalesce(before, 0) | own)) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN (fails & coalesce(before, 0)) = 0 AND (fails & own) > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN (fails & coalesce(before, 0)) > 0 AND (fails & own) > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN (fails & coalesce(before, 0)) = 0 AND (fails & own) > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN (fails & coalesce(before, 0)) = 0 AND (fails & own) > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY ALL)
SELECT part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM told
""",
)
def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op12_context_tree")
def op12_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.score(read(spark, sf_dir, "documents"), across=True)


@query(
    "op13_best_position",
    r"""
WITH said AS (
  SELECT row_number() OVER () AS d, doc_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[0-9a-z\x{80}-\x{10FFFF}]+') AS words
  FROM documents),
sized AS (SELECT d, doc_id, words, len(words) AS n FROM said WHERE len(words) > 0),
whole AS (SELECT count(*) AS all_docs, sum(n) AS all_terms FROM sized),
tf AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(words) AS term FROM sized) GROUP BY d, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, whole GROUP BY term, all_docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[0-9a-z\x{80}-\x{10FFFF}]+')) AS term
    FROM benchmark)
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, d, doc_id,
         CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN tf USING (term) JOIN sized USING (d), whole
  GROUP BY item_id, d, doc_id),
ranked AS (
  SELECT item_id, doc_id, score,
         row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
""",
)
def op13_best_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_position.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
