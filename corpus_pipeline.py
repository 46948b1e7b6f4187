"""From raw documents to token ids: each stage reads what the one before it wrote.

Language ID drops documents that have no language, the n-gram join leaves the smallest document of each group of
near duplicates, substring dedup cuts repeated passages out of the texts, decontamination drops documents that hold
a benchmark passage, and SentencePiece turns the rest into ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm import decontaminate, jaccard_join, language, pieces, substring_dedup
from shelfcast.llm.graph import stored


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.identify(docs).filter("keep").select("doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.first_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A text that loses nothing stays as it is; ``n_chars`` follows the text, where there is such a column."""
    kept = substring_dedup.shortened(docs)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.char_length("text").cast("long"))
    return kept


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.digests(pieces.encode_and_decode(docs))


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("decontamination", benchmark_passages),
    ("sentencepiece", token_ids),
]
ORACLE_SQL = None
"""Similarity, text models and merges are beyond SQL; tests hold the stages against brute force."""


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
