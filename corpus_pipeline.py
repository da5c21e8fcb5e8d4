"""The corpus pipeline: stages over ``documents``, each written as Parquet and read by the next.

Every stage is one operator of ``tagweave.llm`` at work on what the stage before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tagweave.llm.common import table
from tagweave.llm.cotrain import keep_accepted
from tagweave.llm.decontaminate import remove_contaminated
from tagweave.llm.lines import drop_repeated_lines
from tagweave.llm.mixing import mix_sources
from tagweave.llm.queries import MIX, MIX_REST
from tagweave.llm.simhash import keep_one_each
from tagweave.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifier accepts."""
    return keep_accepted(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat earlier ones; those left without a word go."""
    return drop_repeated_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return keep_one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark, without long stretches of its items."""
    return remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the target mixture, in a random order over all of them."""
    return mix_sources(docs, MIX, rest=MIX_REST)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
]

# The classifier and the fingerprints are not SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
