"""Registered queries of the pipeline operators: name -> Spark query, and DuckDB SQL where SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanloom.llm import (
    ann,
    exact_dedup,
    hard_negatives,
    html_extract,
    jaccard_join,
    language_id,
    line_dedup,
    lm_score,
    mixing,
    repair,
    segmentation,
    suffix_dedup,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql
        return fn

    return add


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@_query("op1_suffix_dedup")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = suffix_dedup.suffix_dedup(_table(spark, sf, "documents"), keep_text=False)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@_query("op2_language_id")
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return language_id.identify(_table(spark, sf, "documents"))


@_query("op3_nearest", """
    WITH v AS (
        SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
        WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0
          AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
    pairs AS (
        SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x) AS score
        FROM v q, v c WHERE q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x))
    SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id, score
    FROM pairs QUALIFY rank <= 20""")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return ann.nearest(_table(spark, sf, "embeddings"))


@_query("op4_lm_score")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return lm_score.score_documents(_table(spark, sf, "documents"))


@_query("op5_exact_dedup", """
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           max(doc_id) OVER w = doc_id AS kept, sha256(coalesce(text, '')) AS text_sha256
    FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf, "documents"))


@_query("op6_line_dedup")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    found = line_dedup.line_dedup(_table(spark, sf, "documents"))
    return found.select("doc_id", "n_lines", "n_chunks", "n_removed_chunks", "n_removed_lines",
                        F.sha2("kept_text", 256).alias("kept_sha256"))


@_query("op7_toxicity")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.classify(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


@_query("op10_jaccard_join")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf, "documents"))


@_query("op8_mixing")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.report(_table(spark, sf, "documents"))


@_query("op9_segmentation")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    return segmentation.digest(segmentation.encode(_table(spark, sf, "documents")))


@_query("op11_html_extract")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.extract(_table(spark, sf, "pages")).select("page_id", "url", "text", "n_chars")


@_query("op12_hard_negatives", """
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS x
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
          AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
    pairs AS (
        SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
        FROM v a, v c WHERE a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.x) = len(c.x)),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
           vec_id AS negative_id, positive_score, score AS negative_score
    FROM positives JOIN pairs USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
    QUALIFY rank <= 5""")
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return hard_negatives.hard_negatives(_table(spark, sf, "embeddings"))


@_query("op13_repair")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return repair.repair(repair.damaged(_table(spark, sf, "conversations")))
