"""Registered queries of this subpackage: whole tables in, full results out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    decontamination,
    embedding_dedup,
    exact_dedup,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    quality,
    secret_scan,
    suffix_dedup,
    toxicity,
    url_filter,
    whitening,
)
from tidemark.llm.tables import read


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.scan(read(spark, sf_dir, "documents"), secret_scan.fresh_ledger(spark))
    sha = F.sha2(F.col("base_spans").cast("binary"), 256)
    return found.select("doc_id", "n_assign", "n_access", "n_hex", sha.alias("base_sha256"), "spans")


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(url_filter.dated_captures(pages), url_filter.dated_entries(pages))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.deduplicate(read(spark, sf_dir, "documents"))
    # Something is removed, or a passage of over 50 words, which may have fewer than 400 bytes, repeats across documents.
    return found.withColumn("holds_repeats", (F.col("n_removed") > 0) | F.col("shares_passage")).drop("shares_passage")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, sf_dir, "labels")))


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(read(spark, sf_dir, "documents"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup(read(spark, sf_dir, "documents"))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


OP10_SQL = """
WITH t AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents
)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256)
"""

OP4_SQL = r"""
WITH u AS (
  SELECT page_id, nullif(regexp_replace(regexp_replace(regexp_extract(regexp_replace(
    translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]*([a-z][a-z0-9+.-]*://)?', ''),
    '^[^/?#\x20\x09-\x0D]*', 0), '^.*@', ''), '(:[0-9]*|\.)+$', ''), '') AS host
  FROM pages
), c AS (
  SELECT page_id, host, DATE '2020-01-01' + CAST((page_id * 7919) % 1461 AS INTEGER) AS fetched FROM u
), l AS (
  SELECT CASE WHEN page_id % 5 = 0 THEN regexp_extract(host, '([^.]+\.[^.]+)$', 1) ELSE host END AS suffix,
    DATE '2020-01-01' + CAST((page_id * 104729) % 1461 AS INTEGER) AS day,
    CASE WHEN page_id % 3 = 0 THEN 'allow' ELSE 'block' END AS action
  FROM u WHERE host IS NOT NULL
), d AS (SELECT suffix, day, max(action) AS action FROM l WHERE suffix <> '' GROUP BY ALL),
i AS (
  SELECT suffix, action, day AS valid_from,
    coalesce(lead(day) OVER (PARTITION BY suffix ORDER BY day), DATE '9999-12-31') AS valid_to
  FROM d
), h AS (
  SELECT c.page_id, arg_max(struct_pack(s := i.suffix, f := i.valid_from, a := i.action), length(i.suffix)) AS b
  FROM c JOIN i ON (c.host = i.suffix OR ends_with(c.host, '.' || i.suffix))
    AND i.valid_from <= c.fetched AND c.fetched < i.valid_to
  GROUP BY c.page_id
)
SELECT c.page_id, c.host, c.fetched, b.s AS suffix, b.f AS valid_from, coalesce(b.a, 'unlisted') AS verdict
FROM c LEFT JOIN h USING (page_id)
"""

OP9_SQL = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g
  FROM t
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * m >= 80 * (x.n + y.n - m)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM documents d LEFT JOIN n USING (doc_id)
JOIN (SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY node) c USING (doc_id)
"""

OP12_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
), m AS (
  SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY text) AS first_id FROM t
), f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
    CASE WHEN len(words) < 100 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 10 * length(text) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
  FROM w LEFT JOIN m USING (doc_id)
), c AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY part, fails
), x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM x a, x b, x c, x d, x e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), p AS (
  SELECT *, CASE WHEN fails = '' THEN 6 ELSE list_min(list_transform(string_split(fails, ''), lambda k: strpos(filter_order, k))) END AS falls
  FROM c, o
), r AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, substr(filter_order, step, 1) AS own,
    sum(CASE WHEN falls > step THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN falls = step THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN falls < step AND contains(fails, substr(filter_order, step, 1)) THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN fails = substr(filter_order, step, 1) THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN falls = step THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN falls = step THEN toxic ELSE 0 END) AS toxic_lost
  FROM p, (SELECT CAST(unnest(range(1, 6)) AS INTEGER) AS step) GROUP BY part, filter_order, step
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM r
"""

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality": op1_quality,
    "op2_mixing": op2_mixing,
    "op3_secret_scan": op3_secret_scan,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_decontamination": op7_decontamination,
    "op8_toxicity": op8_toxicity,
    "op9_ngram_join": op9_ngram_join,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_embedding_dedup": op11_embedding_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_whitening": op13_whitening,
}

LLM_ORACLES: dict[str, str] = {
    "op4_url_filter": OP4_SQL,
    "op9_ngram_join": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_filter_audit": OP12_SQL,
}
