"""Corpus pipeline: toxicity, exact dedup, near duplicates, benchmark decontamination, source mix.

Each stage works on what its predecessor kept, written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from waymeld.llm import decontaminate, exact_dedup, jaccard_join, source_mix, toxicity
from waymeld.llm._store import table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model, fitted on all labels, does not reject."""
    return toxicity.without_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the largest doc_id of each text."""
    return exact_dedup.kept_documents(docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least doc_id of each group that links lead through, at five words and 80 percent."""
    return jaccard_join.one_of_each_group(docs, shingle=5, percent=80)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: doc_id, size, source_size, target, taken of every document."""
    return source_mix.source_mix(docs)


STAGES = [("toxicity", without_toxic), ("exact dedup", one_of_each_text), ("n-gram Jaccard join", one_of_each_group), ("benchmark decontamination", without_leaks), ("source mix", mixed)]
#: A trained model and a budget fit are not SQL; tests hold the rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
