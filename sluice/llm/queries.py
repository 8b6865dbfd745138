"""Registered queries of the operators: name -> (query, DuckDB SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, collocations, decontam, langid, mixing, neardup, periodic, quality, resharding, secrets, suffixes, urlfilter, vectors
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(query: Callable[..., DataFrame], *names: str) -> Query:
    return lambda spark, sf_dir: query(*[table(spark, sf_dir, n) for n in names])


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def llm_queries() -> dict[str, tuple[Query, str | None]]:
    return {
        "op1_secret_scan": (_over(secrets.query, "documents"), None),
        "op2_bagminhash": (_over(neardup.query, "documents"), None),
        "op3_chat_format": (_over(chat.query, "conversations"), chat.ORACLE),
        "op4_mix_sources": (_over(mixing.query, "documents"), None),
        "op5_reshard": (_over(resharding.query, "documents"), None),
        "op6_suffix_dedup": (_over(suffixes.query, "documents"), None),
        "op7_quality_rules": (_over(quality.query, "documents", "labels"), None),
        "op8_url_cascade": (_over(urlfilter.query, "pages"), urlfilter.ORACLE),
        "op9_language_id": (_over(langid.query, "documents"), None),
        "op10_decontaminate": (_over(decontam.query, "documents", "benchmark"), None),
        "op11_periodic_runs": (_over(periodic.query, "documents"), None),
        "op12_collocations": (_over(collocations.query, "documents"), collocations.ORACLE),
        "op13_embedding_neardup": (_over(vectors.query, "embeddings"), None),
        "pipeline": (_pipeline, None),
    }
