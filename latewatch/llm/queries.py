"""The corpus queries of the driver contract: Spark callables and, where SQL can say it, DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontam, divergence, exactdedup, langid, negatives, pii, quality, simhash, substring, tokenfile, toxicity, urlfilter
from .common import table

#: A-Z and a-z, for SQL's translate.
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: (host, path, verdict) of the contract.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"), pii.EXAMPLE_KEY)


def op2_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.read_documents(tokenfile.write_shards(table(spark, sf_dir, "documents")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlfilter.judge(table(spark, sf_dir, "pages"), rules)


OP3_SQL = r"""
WITH r(host, path, verdict) AS (VALUES
  ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
s AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        CASE WHEN substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1, 1) = '/'
             THEN regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') ELSE '' END AS path FROM u),
m AS (SELECT s.page_id, max_by(r.host || r.path, length(r.host || r.path)) AS rule, max_by(r.verdict, length(r.host || r.path)) AS verdict
      FROM s JOIN r ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY s.page_id)
SELECT s.page_id, s.host, s.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM s LEFT JOIN m ON m.page_id = s.page_id"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP4_SQL = rf"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(text, {_LOWER}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(list_slice(w, i, i + least(len(w), 13) - 1), ' ') AS s
        FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 12, 1))) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT doc_id, i, lens.n AS n, array_to_string(list_slice(w, i, i + lens.n - 1), ' ') AS s
         FROM (SELECT doc_id, w, unnest(generate_series(1, len(w))) AS i FROM dw WHERE len(w) > 0) JOIN lens ON i + lens.n - 1 <= len(w)),
occ AS (SELECT doc_id, i, dwin.n AS n, item_id FROM dwin JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS j FROM (SELECT DISTINCT doc_id, i, n FROM occ)) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(coalesce(len(dw.w), 0) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(dw.w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.judge(table(spark, sf_dir, "documents"))


OP5_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), {_LOWER}) AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM d WINDOW w AS (PARTITION BY t)"""


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.judge(table(spark, sf_dir, "documents"))


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.code(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.mine(table(spark, sf_dir, "embeddings"))


OP11_SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
             list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS own, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE own
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT own AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10"""


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
win AS (SELECT r, i, array_to_string(list_slice(w, i, i + 34), ' ') AS s FROM (SELECT r, w, unnest(generate_series(1, len(w) - 34)) AS i FROM d)),
hit AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT r, unnest(generate_series(i, i + 34)) AS i FROM hit),
word AS (SELECT r, unnest(w) AS x, unnest(generate_series(1, len(w))) AS i FROM d),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)"""


def op13_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


OP13_SQL = rf"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
g AS (SELECT DISTINCT lang, source FROM d),
occ AS (SELECT lang, source, t, count(*) AS n FROM (SELECT lang, source, unnest(w) AS t FROM d) GROUP BY ALL),
kept AS (SELECT lang, t FROM (SELECT lang, unnest(list_distinct(w)) AS t FROM d) GROUP BY ALL HAVING count(*) >= 10),
v AS (SELECT lang, 2 * count(*) AS v2 FROM kept GROUP BY lang),
c AS (SELECT g.lang, g.source, kept.t, coalesce(occ.n, 0) AS n FROM g JOIN kept ON kept.lang = g.lang
      LEFT JOIN occ ON occ.lang = g.lang AND occ.source = g.source AND occ.t = kept.t),
p AS (SELECT lang, source, t, n, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang, source) + v2) AS p FROM c JOIN v USING (lang)),
q AS (SELECT lang, t, 1 + (CAST(1000000000 AS HUGEINT) * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + v2) AS q
      FROM (SELECT lang, t, sum(n) AS n FROM c GROUP BY ALL) JOIN v USING (lang)),
s AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS f
      FROM p a JOIN p b ON a.lang = b.lang AND a.t = b.t AND a.source <> b.source GROUP BY ALL),
r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
      UNION ALL SELECT p.lang, source, 'term', p.t, (p - q) * (p - q) // (p + q) FROM p JOIN q ON q.lang = p.lang AND q.t = p.t WHERE n > 0 AND p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 10"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii_pseudonyms, op2_wavelet_tokens, op3_url_filter, op4_decontamination, op5_exact_dedup,
        op6_language_id, op7_toxicity, op8_quality, op9_simhash_near_dedup, op10_bpe_codec,
        op11_hard_negatives, op12_substring_dedup, op13_divergence_audit)}
SQL: dict[str, str] = {"op3_url_filter": OP3_SQL, "op4_decontamination": OP4_SQL, "op5_exact_dedup": OP5_SQL,
                      "op11_hard_negatives": OP11_SQL, "op12_substring_dedup": OP12_SQL, "op13_divergence_audit": OP13_SQL}
