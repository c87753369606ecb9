"""A training-corpus pipeline over ``documents``: the stages run in order, each on what its predecessor kept."""

from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from loanloom.llm import exact_dedup, jaccard_join, language_id, mixing, segmentation  # noqa: E402
from loanloom.llm.tables import materialize  # noqa: E402

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found stay; texts without letters and those no language fits go."""
    return language_id.keep_identified(docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts the one with the largest doc_id stays."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles the least doc_id stays."""
    return jaccard_join.keep_one_of_component(docs, width=5, num=80, den=100)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are drawn to the budgets of the domain-language-source tree; some leaves go round twice."""
    return mixing.mixed_documents(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of each text, as piece ids with their scores."""
    return segmentation.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", keep_known_languages),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("segmentation", encode_pieces),
]

#: SQL cannot state the stages that learn or sample; tests hold them against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
