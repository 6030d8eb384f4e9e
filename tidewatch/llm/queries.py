"""The registered ``opN_<name>`` queries and, where SQL expresses one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import embedding_dedup, fingerprint, html_field, license_scan, mixing, ngram_join, pieces, quality_crf, resharding, url_filter
from tidewatch.llm.common import scratch_path, table

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids of every whole text and whether they decode to it; null or empty texts have no ids, repeated rows stay."""
    return pieces.encode_documents(table(spark, sf_dir, "documents"), pieces.read_model())


def op2_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of cosine 0.93 or more within a label; unusable vectors and null labels link with nothing, rows of one id keep their own rows."""
    return embedding_dedup.find_links(table(spark, sf_dir, "embeddings"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page; null or empty html gives an empty text."""
    return html_field.extract_pages(table(spark, sf_dir, "pages"))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices of every whole text; null or empty texts have no words and no labels."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op5_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every whole text and of its edited text; a null text counts as empty, equal texts have equal digests."""
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles overlap by 75 %; texts without words link with nothing."""
    return ngram_join.join_documents(table(spark, sf_dir, "documents"))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every url by the rules above; a null or malformed url has an empty host and path and is allowed."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), URL_RULES)


MIX_WEIGHTS, MIX_SHARE = [5, 2, 1], 1.5


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; a null text has size 0, a null source comes last."""
    mixed = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source"), MIX_WEIGHTS, MIX_SHARE)
    return mixed.select("doc_id", "_mix.size", "_mix.source_size", "_mix.target", (F.col("_mix.size") * F.col("_mix.copies")).alias("taken"))


OLD_SHARDS, NEW_SHARDS = 16, 24


def op9_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New shard and slot of every document by the law ``bytes``, from the shard files written; a null text has 8 bytes, equal texts of an old shard stay together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    old = F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(OLD_SHARDS))
    placed = resharding.write_shards(docs, old, [1] * NEW_SHARDS, scratch_path(spark, "shards"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "rewritten"
    )


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every whole text, learnt from labels outside the held-out third; a null text is scored as empty."""
    docs = table(spark, sf_dir, "documents")
    return quality_crf.score_documents(docs, quality_crf.train(docs, table(spark, sf_dir, "labels")))


OP2_SQL = r"""
WITH RECURSIVE usable AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0))),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, least(e.vec_id, coalesce(m, e.vec_id)) AS component_id,
       coalesce(e.vec_id <= coalesce(m, e.vec_id), false) AS kept
FROM embeddings e LEFT JOIN low ON low.a = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

OP6_SQL= r"""
WITH RECURSIVE spoken AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingled AS (
  SELECT doc_id, CASE WHEN len(w) = 0 OR w IS NULL THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM spoken),
sets AS (SELECT list_sort(s) AS s, min(doc_id) AS rep FROM shingled WHERE len(s) > 0 GROUP BY 1),
cells AS (SELECT rep, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.rep AS a, b.rep AS b FROM cells a JOIN cells b
    ON a.g = b.g AND a.rep <> b.rep AND 4 * a.n >= 3 * b.n AND 4 * b.n >= 3 * a.n
  GROUP BY a.rep, b.rep HAVING 100 * count(*) >= 75 * (any_value(a.n) + any_value(b.n) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT d.doc_id, len(d.s) AS n_shingles, coalesce(least(t.rep, m), d.doc_id) AS component_id
FROM shingled d LEFT JOIN sets t ON len(d.s) > 0 AND t.s = list_sort(d.s) LEFT JOIN low ON low.a = t.rep
"""

OP7_SQL = r"""
WITH seen AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
rules(r_host, r_path, verdict) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fits AS (
  SELECT host, path, r_host || r_path AS rule, verdict,
         row_number() OVER (PARTITION BY host, path ORDER BY length(r_host || r_path) DESC, length(r_host) DESC, verdict DESC) AS k
  FROM (SELECT DISTINCT host, path FROM seen) s JOIN rules r
    ON (s.host = r.r_host OR ends_with(s.host, '.' || r.r_host)) AND starts_with(s.path, r.r_path))
SELECT s.page_id, s.host, s.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM seen s LEFT JOIN fits f ON s.host = f.host AND s.path = f.path AND f.k = 1
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_embedding_near_dedup": op2_embedding_near_dedup,
    "op3_html_extraction": op3_html_extraction,
    "op4_license_scans": op4_license_scans,
    "op5_document_fingerprints": op5_document_fingerprints,
    "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
    "op7_url_filters": op7_url_filters,
    "op8_source_mixing": op8_source_mixing,
    "op9_resharding": op9_resharding,
    "op10_quality_classifier": op10_quality_classifier,
}

ORACLE_SQL: dict[str, str] = {"op2_embedding_near_dedup": OP2_SQL, "op6_ngram_jaccard_join": OP6_SQL, "op7_url_filters": OP7_SQL}
