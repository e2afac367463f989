"""The registered queries of the operators, over whole tables, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelstrata.llm import (
    fingerprint, html, langid, lexical, license, linededup, lm, mixing, ngram_join, pieces, quality, repair, tokencount,
)
from reelstrata.llm.common import documents, ship


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, folder)
    return quality.quality_rules(docs, quality.fit(docs, spark.read.parquet(f"{folder}/labels.parquet")))


def op2_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(documents(spark, folder))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    return license.scan(docs, license.fit(docs))


def op4_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint.fingerprints(documents(spark, folder))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    docs = documents(spark, folder)
    return langid.identify(docs, langid.fit(docs))


def op6_piece_encoding(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return pieces.encode(documents(spark, folder), pieces.vocabulary(spark))


def op7_main_text(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return html.extract(spark.read.parquet(f"{folder}/pages.parquet"))


def op8_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return lm.score(documents(spark, folder))


def op9_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return ngram_join.join(documents(spark, folder))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return tokencount.document_tokens(documents(spark, folder))


def op11_structure_repair(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return repair.repaired_conversations(spark.read.parquet(f"{folder}/conversations.parquet"))


def op12_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    ship(spark)
    return lexical.search(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"))


def op13_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return linededup.line_dedup(documents(spark, folder))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_source_mixing, op3_license_scan, op4_fingerprints, op5_language_id,
        op6_piece_encoding, op7_main_text, op8_lm_scores, op9_ngram_join, op10_token_counts,
        op11_structure_repair, op12_lexical_search, op13_line_dedup,
    )
}

JOIN_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i+3], ' '))) AS s
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, least(d.doc_id, min(r.b)) AS component_id
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id LEFT JOIN reach r ON r.a = d.doc_id GROUP BY d.doc_id"""

ORACLES: dict[str, str] = {
    "op2_source_mixing": mixing.mix_sql(),
    "op9_ngram_join": JOIN_SQL,
    "op11_structure_repair": repair.REPAIR_SQL,
    "op12_lexical_search": lexical.SEARCH_SQL,
    "op13_line_dedup": linededup.LINE_SQL,
}
