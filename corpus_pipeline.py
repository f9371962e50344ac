"""Corpus preparation: the stages that turn ``documents`` into token ids, each over all that
the one before it kept. Every stage is written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from respfeat.llm import decontaminate, exact_dedup, near_dedup, quality, sentencepiece_codec
from respfeat.llm.common import table, written


def by_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier doesn't reject."""
    model = quality.train(docs, quality.graded(table(spark, sf_dir, "labels")))
    return quality.kept_documents(docs, model)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text."""
    return exact_dedup.kept_documents(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by similarity 0.8 of five-word shingles."""
    return near_dedup.kept_documents(docs, size=5, percent=80)


def without_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_ids, ids, round_trip."""
    return sentencepiece_codec.encode(docs)


STAGES = [
    ("quality", by_quality),
    ("exact_dedup", without_copies),
    ("near_dedup", without_near_copies),
    ("decontaminate", without_benchmarks),
    ("sentencepiece", to_ids),
]

#: The classifier, the signatures and the search for pieces are not SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
