"""The driver's query of each corpus operator, beside its SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm import (
    bk_trees,
    chat,
    conversation_repair,
    decontamination,
    lm_score,
    mixing,
    near_dedup,
    quality,
    sharding,
    token_output,
    toxicity,
    url_filter,
    whitening,
)
from starload.llm.common import crc_of_id, table
from starload.session import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", F.col("start").cast("long").alias("start"), "n_words", "similarity")


OP1_SQL = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(lower(text), '.,;:!?"''()[]{}', ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), i AS (
    SELECT item_id, regexp_extract_all(translate(lower(text), '.,;:!?"''()[]{}', ''), '[^\x20\x09-\x0D]+') AS w FROM benchmark
), ds AS (
    SELECT doc_id, len(w) AS n, p, array_to_string(list_slice(w, p + 1, p + 5), ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM d WHERE len(w) > 0)
), gi AS (
    SELECT item_id, len(w) AS n, p, array_to_string(list_slice(w, p + 1, p + 5), ' ') AS g
    FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 4, 1))) AS p FROM i WHERE len(w) > 0)
), places AS (
    SELECT DISTINCT doc_id, gi.n, least(greatest(ds.p - gi.p, 0), greatest(ds.n - gi.n, 0)) AS start
    FROM ds JOIN gi USING (g)
), windows AS (
    SELECT doc_id, n, start, list_slice(w, start + 1, start + n) AS w FROM places JOIN d USING (doc_id)
), ws AS (
    SELECT doc_id, n, start, g, count(*) AS c FROM (
        SELECT doc_id, n, start, array_to_string(list_slice(w, p + 1, p + 5), ' ') AS g
        FROM (SELECT *, unnest(range(greatest(len(w) - 4, 1))) AS p FROM windows)
    ) GROUP BY ALL
), ic AS (SELECT item_id, n, g, count(*) AS c FROM gi GROUP BY ALL),
met AS (
    SELECT doc_id, item_id, start, n, sum(least(ws.c, ic.c)) AS least_sum
    FROM ws JOIN ic USING (n, g) GROUP BY ALL
), wt AS (SELECT doc_id, n, start, sum(c) AS total FROM ws GROUP BY ALL),
it AS (SELECT item_id, sum(c) AS total FROM ic GROUP BY ALL)
SELECT doc_id, item_id, start::BIGINT AS start, n::INT AS n_words,
    least_sum / (wt.total + it.total - least_sum) AS similarity
FROM met JOIN wt USING (doc_id, n, start) JOIN it USING (item_id)
WHERE similarity >= 0.8
"""


def op2_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.withColumn("taken", F.col("size") * F.col("copies"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    measures = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(table(spark, sf_dir, "documents"), measures=measures)


OP3_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents
), w AS (
    SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM d
), windows AS (
    SELECT r, i, list_slice(words, i, i + 7) AS win
    FROM (SELECT r, words, unnest(range(1, len(words) - 6)) AS i FROM w)
), again AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, win) AS n FROM windows) WHERE n > 1
), repeats AS (
    SELECT r, count(DISTINCT p) AS n_repeat_words
    FROM (SELECT r, unnest(range(i, i + 8)) AS p FROM again) GROUP BY r
), m AS (
    SELECT doc_id, text, lines, words, len(words)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN repeats USING (r)
), b AS (
    SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND NOT (
        5 * n_symbols > n_words
        OR length(regexp_replace(text, '[^A-Z]', '', 'g')) > length(regexp_replace(text, '[^a-z]', '', 'g'))
        OR 10 * len(list_filter(range(2, n_words + 1), lambda i: words[i] = words[i - 1])) > 3 * n_words
        OR 10 * n_dup_lines > 5 * len(lines)
        OR 10 * length(regexp_replace(text, '[^0-9]', '', 'g')) > 3 * word_chars
        OR word_chars < 2 * n_words OR word_chars > 20 * n_words
    ) AS kept
FROM b
"""


def op4_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_dir(spark, "token-files")
    token_output.write_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), path)
    return token_output.digests(token_output.read_tokens(spark, path, packed=True))


def op5_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.scored(table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scores = toxicity.scored(docs, toxicity.trained(docs, table(spark, sf_dir, "labels")))
    return scores.select(
        "doc_id", (F.pmod(crc_of_id(F.col("doc_id")), F.lit(5)) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op7_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    sharded = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return sharded.withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_urls(pages, URL_RULES, url_filter.tracking_hosts(pages))


OP10_SQL = r"""
WITH cut AS (
    SELECT page_id, url, CASE WHEN position('://' IN url) > 0
        THEN substring(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*', 0, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1, 's') AS path FROM cut
), hosts AS (
    SELECT host, count(*) AS n, count(*) FILTER (WHERE contains(url, 'utm_source=')) AS marked FROM parts GROUP BY host
), listed AS (
    SELECT host FROM hosts WHERE marked * (SELECT sum(n) FROM hosts) > n * (SELECT sum(marked) FROM hosts)
), ruled AS (
    SELECT *, '.' || host AS dotted, CASE
        WHEN dotted LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN dotted LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN dotted LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN dotted LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN dotted LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
    WHEN host IN (SELECT host FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


def op11_whiten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk_trees.linked_documents(table(spark, sf_dir, "documents"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


ENTRIES: dict[str, tuple[Query, str | None]] = {
    "op1_decontaminate": (op1_decontaminate, OP1_SQL),
    "op2_mix": (op2_mix, None),
    "op3_quality": (op3_quality, OP3_SQL),
    "op4_tokens": (op4_tokens, None),
    "op5_score": (op5_score, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_shards": (op7_shards, None),
    "op8_chat": (op8_chat, None),
    "op9_near_dedup": (op9_near_dedup, None),
    "op10_urls": (op10_urls, OP10_SQL),
    "op11_whiten": (op11_whiten, None),
    "op12_simhash": (op12_simhash, None),
    "op13_repair": (op13_repair, None),
}
