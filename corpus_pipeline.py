"""The corpus pipeline over ``documents``: each stage is one operator of ``tillroll.llm``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import language_id, line_dedup, packing, quality_nbsvm, simhash_neardup
from tillroll.llm.common import fold_of, table
from tillroll.llm.queries import quality_model
from tillroll.llm.shipping import ship_package
from tillroll.sources.workspace import land


def recognised_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts without a letter and below the calibrated score go."""
    ship_package(spark)
    known = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(known.where(fold_of("doc_id", 3) != 1))
    return language_id.keep_recognised(docs, model)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality model scores 0.7 or more."""
    ship_package(spark)
    known = table(spark, sf_dir, "documents")
    return quality_nbsvm.keep_good(docs, quality_model(known, table(spark, sf_dir, "labels")))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier line; n_chars follows the text."""
    ship_package(spark)
    cleaned = line_dedup.drop_repeated_lines(docs)
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    ship_package(spark)
    return simhash_neardup.keep_first(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their ids and places in sequences of 4096 tokens."""
    ship_package(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", recognised_languages),
    ("quality_classifier", good_quality),
    ("line_dedup", without_repeated_lines),
    ("simhash_near_dedup", near_duplicates),
    ("best_fit_packing", packed),
]

#: SQL cannot express the learned stages; tests compare each stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order, each result written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = land(stage(spark, docs, sf_dir), name)
    return docs
