"""Corpus pipeline: quality rules, near-duplicates, benchmark decontamination, mixing, sharding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are
written as Parquet in the shared folder and read again as the next stage's
documents, so a lost executor costs no finished stage. All stages but the last
return the columns of their input.

Defined results: those of the operators; rows without a doc_id pass every stage
that does not reject their text; an empty table passes as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm import decontam, mixing, neardup, quality, resharding
from sluice.llm.common import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule or a risk-controlled rule rejects go."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one of the least id."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark passages go."""
    return decontam.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of the documents by their calibrated probabilities stays."""
    return mixing.sample(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of each document, and how its bytes move there."""
    return resharding.query(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix_sources", mix_sources),
    ("shard", shard),
]

#: The near-duplicate and raking stages have no SQL form; tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
