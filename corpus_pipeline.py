"""The corpus pipeline: language, toxicity, near duplicates, mixture, packing.

Every stage takes (spark, docs, sf_dir) and returns the documents that it keeps, with
the columns of ``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import jaccard, language, mixing, packing, toxicity
from millrace.llm.common import shared_dir, stored

STAGES = [
    ("language", language.stage),
    ("toxicity", toxicity.stage),
    ("near_duplicates", jaccard.stage),
    ("mixing", mixing.stage),
    ("packing", packing.stage),
]

# Trained models and groups of near duplicates are beyond SQL: tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    work = shared_dir(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, f"{work}/{i}-{name}")
    return docs
