"""Text queries over the whole documents, conversations, pages and events tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from berth.functions import sensitive as sens
from berth.functions import text as tx
from berth.operators import textops as op
from berth.plans.registry import query, table

def documents(spark, sf_dir, *more):
    return table(spark, sf_dir, "documents").select("doc_id", "text", *more)


# Frequent words of the languages in the documents table.
LANGUAGE_WORDS = {
    "english": ["the", "of", "and", "to", "is"],
    "german": ["der", "die", "und", "das", "von"],
    "french": ["le", "les", "et", "une", "est"],
    "spanish": ["el", "los", "que", "un", "del"],
}
# Words that occur often enough in the invented prose for scores on both sides.
FAVOURABLE = ["the", "with", "for", "und", "les"]
UNFAVOURABLE = ["of", "was", "nicht", "des", "un"]

_WORDS = r"regexp_extract_all(lower(text), '\p{L}+')"


def _hits(words: list[str]) -> str:
    known = ", ".join(f"'{w}'" for w in words)
    return f"len(list_filter(ws, lambda w: w IN ({known})))"


def _classify_sql() -> str:
    scores = ", ".join(f"{_hits(ws)} AS {label}" for label, ws in LANGUAGE_WORDS.items())
    top = f"greatest({', '.join(LANGUAGE_WORDS)})"
    chain = " ".join(f"WHEN {x} = {top} THEN '{x}'" for x in LANGUAGE_WORDS)
    return (
        f"SELECT doc_id, CASE WHEN {top} <= 0 THEN 'other' {chain} END AS label "
        f"FROM (SELECT doc_id, {scores} FROM (SELECT doc_id, {_WORDS} AS ws FROM documents))"
    )


@query("text_classify", _classify_sql())
def text_classify(spark, sf_dir):
    texts = documents(spark, sf_dir)
    return op.classify(texts, "text", LANGUAGE_WORDS).select("doc_id", "label")


@query(
    "text_classify_agreement",
    "SELECT lang, label, count(*) AS documents FROM documents JOIN "
    f"({_classify_sql()}) AS c USING (doc_id) GROUP BY lang, label",
)
def text_classify_agreement(spark, sf_dir):
    labelled = op.classify(documents(spark, sf_dir, "lang"), "text", LANGUAGE_WORDS)
    return labelled.groupBy("lang", "label").agg(F.count(F.lit(1)).alias("documents"))


_TOKENS = f"len(regexp_extract_all(text, '{tx.TOKEN}'))"


@query(
    "text_filter",
    f"SELECT doc_id, lang, CAST({_TOKENS} AS INTEGER) AS tokens FROM documents WHERE {_TOKENS} >= 500 "
    f"OR regexp_matches(text, '{sens.SHAPES['EMAIL']}')",
)
def text_filter(spark, sf_dir):
    tokens = tx.token_count(F.col("text"))
    counted = documents(spark, sf_dir, "lang").withColumn("tokens", tokens)
    rule = (F.col("tokens") >= 500) | F.col("text").rlike(sens.SHAPES["EMAIL"])
    return op.text_filter(counted, rule).select("doc_id", "lang", "tokens")


@query(
    "sentiment",
    "SELECT doc_id, CASE WHEN good + bad > 0 THEN CAST(good - bad AS DOUBLE) / (good + bad) "
    f"ELSE CAST(0 AS DOUBLE) END AS sentiment FROM (SELECT doc_id, {_hits(FAVOURABLE)} AS good, "
    f"{_hits(UNFAVOURABLE)} AS bad FROM (SELECT doc_id, {_WORDS} AS ws FROM documents))",
)
def sentiment(spark, sf_dir):
    texts = documents(spark, sf_dir)
    scored = op.with_sentiment(texts, "text", FAVOURABLE, UNFAVOURABLE)
    return scored.select("doc_id", "sentiment")


QUESTIONS = {
    "Which e-mail addresses?": f"({sens.SHAPES['EMAIL']})",
    "Which network addresses?": r"([0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3})",
    "Which web links?": r"(https?://[A-Za-z0-9./_?=&-]+)",
}


@query(
    "extract",
    " UNION ALL ".join(
        f"SELECT doc_id, '{q}' AS question, CAST(len(a) AS INTEGER) AS answers, "
        f"array_to_string(a, ' | ') AS answer_text FROM (SELECT doc_id, "
        f"regexp_extract_all(text, '{p}', 1) AS a FROM documents) WHERE len(a) > 0"
        for q, p in QUESTIONS.items()
    ),
)
def extract(spark, sf_dir):
    found = op.extract(documents(spark, sf_dir), "text", QUESTIONS)
    return (
        found.select("doc_id", F.explode_outer("answers").alias("question", "found"))
        .filter(F.size("found") > 0)
        .select(
            "doc_id",
            "question",
            F.size("found").alias("answers"),
            F.array_join("found", " | ").alias("answer_text"),
        )
    )


PAGE_QUESTIONS = {"title": "<title>([^<]*)</title>", "link": 'href="([^"]*)"'}


@query(
    "extract_markup",
    " UNION ALL ".join(
        f"SELECT page_id, '{q}' AS question, CAST(len(a) AS INTEGER) AS answers, "
        f"array_to_string(a, ' | ') AS answer_text FROM (SELECT page_id, "
        f"regexp_extract_all(html, '{p}', 1) AS a FROM pages)"
        for q, p in PAGE_QUESTIONS.items()
    ),
)
def extract_markup(spark, sf_dir):
    found = op.extract(table(spark, sf_dir, "pages"), "html", PAGE_QUESTIONS)
    return found.select("page_id", F.explode_outer("answers").alias("question", "found")).select(
        "page_id",
        "question",
        F.size("found").alias("answers"),
        F.array_join("found", " | ").alias("answer_text"),
    )


_PRICE = 0.000002


@query(
    "tokens",
    f"SELECT role, count(*) AS texts, CAST(sum({_TOKENS}) AS BIGINT) AS tokens, "
    f"CAST(sum({_TOKENS}) AS DOUBLE) * CAST({_PRICE:.6f} AS DOUBLE) AS cost "
    "FROM conversations GROUP BY role",
)
def tokens(spark, sf_dir):
    return op.token_usage(table(spark, sf_dir, "conversations"), "text", ["role"], _PRICE)


@query(
    "template",
    "SELECT conv_id, turn, concat('Summarize turn ', CAST(turn AS VARCHAR), ' of the ', role, "
    "' (turn ', CAST(turn AS VARCHAR), '): ', text) AS prompt FROM conversations",
)
def template(spark, sf_dir):
    prompt = tx.fill_template(
        "Summarize turn {0} of the {1} (turn {0}): {2}", F.col("turn"), F.col("role"), F.col("text")
    )
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", prompt.alias("prompt"))


# Every seventh answer is cut off, every eleventh names another field.
_ANSWERS = (
    "CASE WHEN event_id % 7 = 0 THEN substring(props, 1, 4) "
    "WHEN event_id % 11 = 0 THEN replace(props, 'k', 'other') ELSE props END"
)


@query(
    "structured",
    "SELECT event_id, k, k IS NOT NULL AS is_valid FROM (SELECT event_id, "
    f"CASE WHEN json_valid(a) THEN CAST(json_extract_string(a, '$.k') AS BIGINT) END AS k "
    f"FROM (SELECT event_id, {_ANSWERS} AS a FROM events))",
)
def structured(spark, sf_dir):
    answers = table(spark, sf_dir, "events").selectExpr("event_id", f"{_ANSWERS} AS answer")
    parsed = op.structured(answers, "answer", "k bigint", ["k"])
    return parsed.select("event_id", F.col("parsed.k").alias("k"), "is_valid")


@query(
    "structured_invalid",
    "SELECT event_type, count(*) AS answers, CAST(sum(CASE WHEN event_id % 7 = 0 OR "
    "event_id % 11 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS invalid FROM events GROUP BY event_type",
)
def structured_invalid(spark, sf_dir):
    answers = table(spark, sf_dir, "events").selectExpr("event_type", f"{_ANSWERS} AS answer")
    parsed = op.structured(answers, "answer", "k bigint", ["k"])
    return parsed.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("answers"), F.count_if(~F.col("is_valid")).alias("invalid")
    )


# Suggestions as a list, as a single object, and as text that is no JSON.
_SUGGESTIONS = (
    "CASE event_id % 3 WHEN 0 THEN concat('[', props, ',', props, ']') "
    "WHEN 1 THEN props ELSE concat('see ', event_type) END"
)


@query(
    "suggestion_lists",
    "SELECT event_id, 2 AS items, 2 * CAST(json_extract_string(props, '$.k') AS BIGINT) AS total "
    "FROM events WHERE event_id % 3 = 0 UNION ALL "
    "SELECT event_id, 1, CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events "
    "WHERE event_id % 3 = 1 UNION ALL "
    "SELECT event_id, 0, 0 FROM events WHERE event_id % 3 = 2",
)
def suggestion_lists(spark, sf_dir):
    items = tx.parse_list(F.col("answer"), "struct<k: bigint>")
    answers = table(spark, sf_dir, "events").selectExpr("event_id", f"{_SUGGESTIONS} AS answer")
    return answers.withColumn("items", F.coalesce(items, F.array())).select(
        "event_id",
        F.size("items").alias("items"),
        F.aggregate("items", F.lit(0).cast("bigint"), lambda s, x: s + x["k"]).alias("total"),
    )


@query(
    "text_digest",
    "SELECT lang, word, frequency, rank FROM (SELECT lang, word, count(*) AS frequency, "
    "CAST(row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS INTEGER) AS rank "
    "FROM ("
    f"SELECT lang, unnest({_WORDS}) AS word FROM documents) GROUP BY lang, word) WHERE rank <= 10",
)
def text_digest(spark, sf_dir):
    return op.text_digest(documents(spark, sf_dir, "lang"), "text", ["lang"])


@query(
    "text_digest_labels",
    "SELECT quality, word, frequency, rank FROM (SELECT quality, word, count(*) AS frequency, "
    "CAST(row_number() OVER (PARTITION BY quality ORDER BY count(*) DESC, word) AS INTEGER) AS rank "
    "FROM ("
    f"SELECT quality, unnest({_WORDS}) AS word FROM documents JOIN labels USING (doc_id)) "
    "GROUP BY quality, word) WHERE rank <= 10",
)
def text_digest_labels(spark, sf_dir):
    labelled = documents(spark, sf_dir).join(table(spark, sf_dir, "labels"), "doc_id")
    return op.text_digest(labelled, "text", ["quality"])


@query(
    "complete_hook",
    "SELECT conv_id, turn, split_part(text, '.', 1) AS completion FROM conversations",
)
def complete_hook(spark, sf_dir):
    prompts = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    return op.complete(prompts, "text").select("conv_id", "turn", "completion")


@query(
    "hashed_terms",
    "SELECT doc_id, bucket, count(*) AS weight FROM (SELECT doc_id, "
    "CAST(concat('0x', substr(md5(word), 1, 6)) AS INTEGER) % 256 AS bucket FROM ("
    f"SELECT doc_id, unnest({_WORDS}) AS word FROM documents)) GROUP BY doc_id, bucket",
)
def hashed_terms(spark, sf_dir):
    return op.hashed_terms(documents(spark, sf_dir), "doc_id", "text")


@query(
    "embed_topk",
    "WITH pos AS (SELECT unnest(range(1, 65)) AS i), c AS (SELECT i, avg(CAST(embedding[i] AS "
    "DOUBLE)) AS m FROM embeddings, pos GROUP BY i), scored AS (SELECT vec_id, "
    "sum(CAST(embedding[i] AS DOUBLE) * m) / (sqrt(sum(CAST(embedding[i] AS DOUBLE) ** 2)) "
    "* (SELECT sqrt(sum(m * m)) FROM c)) AS cosine FROM embeddings, c GROUP BY vec_id) "
    "SELECT vec_id, round(cosine, 6) AS cosine FROM scored ORDER BY scored.cosine DESC, vec_id "
    "LIMIT 10",
)
def embed_topk(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    top = op.nearest(vectors, "vec_id", "embedding", op.centroid(vectors, "embedding"))
    return top.withColumn("cosine", F.round("cosine", 6))


@query(
    "quote_text",
    "SELECT doc_id, replace(concat(lang, chr(39), 's ', source), chr(39), chr(39) || chr(39)) "
    "AS quoted FROM documents",
)
def quote_text(spark, sf_dir):
    named = F.concat("lang", F.lit("'s "), "source")
    return documents(spark, sf_dir, "lang", "source").select(
        "doc_id", tx.quote_sql(named).alias("quoted")
    )
