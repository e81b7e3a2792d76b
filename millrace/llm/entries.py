"""Queries and SQL of the corpus operators, and the pipeline over documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import chat, fingerprint, jaccard, language, mixing, ngram, packing, records, search, toxicity


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprint": fingerprint.query,
        "op2_packing": packing.query,
        "op3_ngram": ngram.query,
        "op4_records": records.query,
        "op5_mixing": mixing.query,
        "op6_toxicity": toxicity.query,
        "op7_language": language.query,
        "op8_chat": chat.query,
        "op9_topk": search.query,
        "op10_jaccard": jaccard.query,
        "pipeline": _pipeline,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op8_chat": chat.SQL,
        "op9_topk": search.SQL,
    }
