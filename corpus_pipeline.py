"""From raw documents to packed sequences, each stage one operator of gravita.llm."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gravita.llm import exact, language, nearjoin, packing, queries, substrings
from gravita.llm.common import Scratch, table


def identify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; texts without a letter and unclear texts go."""
    return language.keep_identified(spark, docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact.drop_exact_duplicates(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the smallest id."""
    return nearjoin.drop_near_duplicates(spark, docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat across or within them."""
    return substrings.drop_repeats(spark, docs)


def fill_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences, related documents side by side."""
    return packing.pack(spark, docs, queries.vocabulary())


STAGES = [
    ("language", identify),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("repeats", cut_repeats),
    ("packing", fill_windows),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and reread for the next."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = scratch.write(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
