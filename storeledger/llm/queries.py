"""Registered queries of the operators, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storeledger.llm import (
    hard_negatives,
    mixing,
    near_dup,
    packing,
    quality,
    secrets,
    substring_dedup,
    token_counts,
    topk,
    toxicity,
    turn_repair,
    url_filter,
    warc,
)
from storeledger.llm.common import word_count

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}

# The URL rules of the contract.
URL_RULES = (
    url_filter.UrlRule("allow", "com", "/"),
    url_filter.UrlRule("block", "example.com", "/en/"),
    url_filter.UrlRule("allow", "www.example.com", "/en/"),
    url_filter.UrlRule("block", "net", "/es/"),
    url_filter.UrlRule("block", "net", "/fr/"),
)


def _register(name: str, sql: str | None = None):
    def add(build: Query) -> Query:
        _QUERIES[name] = build
        if sql is not None:
            _SQL[name] = sql
        return build

    return add


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def _sized(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))


_WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _quality_sql() -> str:
    stop = ", ".join("'" + w.replace("'", "''") + "'" for w in quality._stop_forms())
    ratio = "CASE WHEN {1} = 0 THEN 0.0::DOUBLE ELSE {0}::DOUBLE / {1} END"
    measures = {
        "mean_word_chars": ("word_chars", "n_words"),
        "symbol_ratio": ("n_symbols", "n_words"),
        "stop_word_ratio": ("n_stop_words", "n_words"),
        "echo_ratio": ("n_echo_words", "n_words"),
        "dup_line_ratio": ("n_dup_lines", "n_lines"),
        "ellipsis_line_ratio": ("n_ellipsis_lines", "n_lines"),
        "bullet_line_ratio": ("n_bullet_lines", "n_lines"),
    }
    tests = []
    for rule in quality.RULES:
        value = ratio.format(*measures[rule.measure])
        tests += [f"({value}) >= {rule.low}"] if rule.low is not None else []
        tests += [f"({value}) <= {rule.high}"] if rule.high is not None else []
    return rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS t, {_WORDS_SQL} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         row_number() OVER () AS r
  FROM documents
), windows AS (
  SELECT r, i, array_to_string(w[i:i + 7], ' ') AS said
  FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM base)
), twice AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, said) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT r, count(DISTINCT i + k) AS n
  FROM twice, (SELECT unnest(range(0, 8)) AS k) GROUP BY r
), counted AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(lines) AS n_lines,
         len(list_filter(w, lambda x: x IN ({stop}))) AS n_stop_words,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_echo_words,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis_lines,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•·▪◦‣]'))) AS n_bullet_lines
  FROM base LEFT JOIN covered c USING (r)
), judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {" AND ".join(tests)} AS kept
FROM judged
"""


@_register("op1_quality_rules", _quality_sql())
def op1_quality_rules(spark, sf_dir):
    return quality.quality_rules(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


@_register(
    "op2_warc",
    """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages
), k AS (
  SELECT *, CASE WHEN payload_bytes >= 1000
                 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS keeper
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN keeper IS NOT NULL AND page_id IS DISTINCT FROM keeper
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM keeper THEN keeper END AS refers_to
FROM k
""",
)
def op2_warc(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    # The pages table has no capture times; a page's is its id in seconds.
    at = F.date_format(F.timestamp_seconds(F.lit(1_700_000_000) + F.coalesce("page_id", F.lit(0))),
                       "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return warc.archive_captures(pages, captured_at=at).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@_register("op3_best_fit_packing")
def op3_best_fit_packing(spark, sf_dir):
    return packing.pack(_documents(spark, sf_dir), word_count(F.col("text")))


@_register("op4_token_counts")
def op4_token_counts(spark, sf_dir):
    return token_counts.length_histogram(token_counts.token_lengths(_documents(spark, sf_dir)))


@_register(
    "op5_mixing",
    rf"""
WITH d AS (
  SELECT doc_id, source, len({_WORDS_SQL})::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight,
         row_number() OVER (ORDER BY source NULLS LAST) AS no
  FROM d GROUP BY source
), f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (
              ORDER BY source_size / weight, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
              AS room,
         sum(weight) OVER (
              ORDER BY source_size / weight, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
              AS rest
  FROM s
), g AS (
  SELECT *, weight * room > 3 * source_size * rest AS stops FROM f
), t AS (
  SELECT *, CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE
           (weight * first_value(CASE WHEN NOT stops THEN room END IGNORE NULLS) OVER w)::DOUBLE
           / (first_value(CASE WHEN NOT stops THEN rest END IGNORE NULLS) OVER w)::DOUBLE END AS target
  FROM g
  WINDOW w AS (ORDER BY source_size / weight, no
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
), plan AS (
  SELECT no, ceil(floor(target) / 1024)::BIGINT AS blocks,
         (sum(ceil(floor(target) / 1024)) OVER (ORDER BY no))::BIGINT AS high,
         (sum(ceil(floor(target) / 1024)) OVER ())::BIGINT AS n
  FROM t
), step AS (
  SELECT any_value(n) AS n, coalesce(nullif(arg_min(s, (abs(s - near), s)) % any_value(n), 0), 1) AS s
  FROM (SELECT n, greatest(1, round(n * ((sqrt(5) - 1) / 2)))::BIGINT AS near,
               unnest(range(1, 2 * n + 2)) AS s FROM (SELECT max(n) AS n FROM plan))
  WHERE gcd(s, n) = 1
), slots AS (
  SELECT no, slot, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS block
  FROM (SELECT slot, slot * s % n AS point FROM (SELECT unnest(range(n)) AS slot, s, n FROM step))
  JOIN plan ON point >= high - blocks AND point < high
), laid AS (
  SELECT doc_id, size, source_size, target, no, floor(target)::BIGINT AS quota,
         (sum(size) OVER (PARTITION BY no ORDER BY h, size
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size)::BIGINT AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, quota - start)) + greatest(0, least(size, quota - start - source_size))
        + greatest(0, least(size, quota - start - 2 * source_size)))::BIGINT AS taken,
       slot AS first_slot
FROM laid LEFT JOIN slots
  ON slots.no = laid.no AND block = start // 1024 AND size > 0 AND start < quota
""",
)
def op5_mixing(spark, sf_dir):
    return mixing.words_taken(_sized(_documents(spark, sf_dir)))


@_register("op6_substring_dedup")
def op6_substring_dedup(spark, sf_dir):
    return substring_dedup.substring_dedup(_documents(spark, sf_dir))


@_register(
    "op7_exact_topk",
    """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.vec, c.vec)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
""",
)
def op7_exact_topk(spark, sf_dir):
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


@_register(
    "op8_minhash_near_dup",
    rf"""
WITH RECURSIVE d AS (
  SELECT doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 2 THEN [w[1]]
                          ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s
    FROM d)
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
), no AS MATERIALIZED (
  SELECT doc_id, n, dense_rank() OVER (ORDER BY s) AS s FROM sh JOIN n USING (doc_id)
), both_in AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i, any_value(a.n) AS nx, any_value(b.n) AS ny
  FROM no a JOIN no b ON a.s = b.s AND a.doc_id < b.doc_id
   AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id
), link AS MATERIALIZED (
  SELECT x, y FROM both_in WHERE 100 * i >= 80 * (nx + ny - i)
), ways AS MATERIALIZED (
  SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach(id, node) AS (
  SELECT doc_id, doc_id FROM d
  UNION
  SELECT r.id, w.y FROM reach r JOIN ways w ON w.x = r.node
), comp AS (
  SELECT id, min(node) AS component_id FROM reach GROUP BY id
)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id,
       d.doc_id = component_id AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN comp ON comp.id = d.doc_id
""",
)
def op8_minhash_near_dup(spark, sf_dir):
    found = near_dup.near_duplicates(_documents(spark, sf_dir), shingle=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@_register("op9_secret_scan")
def op9_secret_scan(spark, sf_dir):
    return secrets.secret_scan(_documents(spark, sf_dir)).drop("n_confirmed")


@_register("op10_url_filter")
def op10_url_filter(spark, sf_dir):
    labelled = spark.createDataFrame(url_filter.labelled_urls(), "url string, blocked int")
    model = url_filter.train(labelled)
    judged = url_filter.url_filter(_table(spark, sf_dir, "pages"), URL_RULES, model)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@_register("op11_toxicity")
def op11_toxicity(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    machine = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.toxicity(docs, machine)


@_register("op12_turn_repair")
def op12_turn_repair(spark, sf_dir):
    conversations = _table(spark, sf_dir, "conversations")
    return turn_repair.repair(conversations, turn_repair.damaged(conversations))


@_register(
    "op13_hard_negatives",
    """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS vec
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r, a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         list_dot_product(a.vec, c.vec)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id <> c.vec_id
  WHERE a.vec_id % 50 = 0
), p AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS place FROM s WHERE same
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score,
         s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.r, p.place ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM p JOIN s ON p.r = s.r
  WHERE p.place <= 5 AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
""",
)
def op13_hard_negatives(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"), label=label)
