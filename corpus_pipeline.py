"""A corpus pipeline: five stages, each written as Parquet and read again as the next one's input.

    classify -> keep one of near copies -> drop benchmark leaks -> mask secrets -> mix

Every stage works on all that its predecessor kept, and what it decides takes effect.  All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roadlark.llm import decontaminate, mixing, ngram_join, quality, secrets
from roadlark.llm.common import Scratch, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps."""
    scored = quality.classify(docs, table(spark, sf_dir, "labels"))
    return scored.filter("keep").select(docs.columns)


def keep_one(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least id of each group of near copies."""
    return ngram_join.representatives(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets masked."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The final mix: one row per emitted copy, with its source's size and target."""
    return mixing.emitted(mixing.mix(docs))


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one),
    ("benchmark decontamination", drop_leaks),
    ("secret scans", mask_secrets),
    ("mixing sources to target weights", mix),
]

# Models, alignments and draws have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, scratch = table(spark, sf_dir, "documents"), Scratch(spark, "pipeline")
    for _, stage in STAGES[:-1]:
        docs = scratch.keep(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
