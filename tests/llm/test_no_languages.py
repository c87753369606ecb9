from helpers import edge_docs, edge_rows
from pyspark.sql import functions as F

import corpus_pipeline
from loanloom.llm import language_id


def _lettered():
    return sorted(str(r[0]) for r in edge_rows() if any(c.isalpha() for c in r[1] or ""))


def test_without_a_model_clean_documents_stay(spark):
    docs = edge_docs(spark).withColumn("lang", F.lit(None).cast("string"))
    got = corpus_pipeline.keep_known_languages(spark, docs, "")
    assert got.columns == docs.columns and sorted(str(r.doc_id) for r in got.collect()) == _lettered()


def test_labels_that_are_all_held_out_teach_nothing(spark):
    docs = edge_docs(spark).withColumn("lang", F.when(language_id.held_out(), F.lit("en")))
    assert docs.where("lang is not null").count() > 0
    assert sorted(str(r.doc_id) for r in language_id.keep_identified(docs).collect()) == _lettered()
