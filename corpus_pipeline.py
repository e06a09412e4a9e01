"""Training-corpus pipeline over ``documents``: five stages, each written and read again.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chromaloom.llm.decontaminate import without_leaks
from chromaloom.llm.line_dedup import dedup_lines
from chromaloom.llm.mixture import mix_sources
from chromaloom.llm.ngram_join import keep_one_of_each
from chromaloom.llm.shared import Workspace
from chromaloom.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that score 0.3 or more."""
    return without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated passages of three lines, and documents of which nothing is left by that."""
    return dedup_lines(docs).filter("not _ld_all").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of the n-gram Jaccard join."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that leak a benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often the mix takes each document."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

#: The classifier and the join have no SQL form; tests compare the stages with their operators.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    space = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = space.table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
