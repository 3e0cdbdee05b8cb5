"""From raw documents to token counts: language, shared lines, near copies, benchmark leaks, BPE.

Every stage takes what its predecessor kept, written as Parquet and read again. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from editstream.llm import bpe, decontaminate, language_id, line_dedup, near_dedup
from editstream.llm.common import stage, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no language is found, as they have no letter, go."""
    return language_id.in_some_language(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that many documents share stay in one of them."""
    return line_dedup.without_shared_lines(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document of the smallest id stays."""
    return near_dedup.one_of_each(docs)


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the documents that are left."""
    return bpe.digests(docs)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("leaks", leaks),
    ("tokens", tokens),
]

# No SQL can express language models, sampling or BPE; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
