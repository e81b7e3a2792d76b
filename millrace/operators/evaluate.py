"""Attempts at reading a sample, scored and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators import compare

# What a passed and a failed record, an offer and a fault count.
PASSED, FAILED, VIOLATION = 1000, -2000, -50


def evaluation(outcomes: DataFrame, *keys: str) -> DataFrame:
    """Counts of outcomes (ok, n_offers, problems: array of texts) by keys, and their ``score``.

    A failed record counts a fault for each problem, one at least.
    """
    faults = F.when(~F.col("ok"), F.greatest(F.lit(1), F.size("problems"))).otherwise(0)
    got = outcomes.groupBy(*keys).agg(F.count_if("ok").alias("passed"), F.count_if(~F.col("ok")).alias("failed"), F.coalesce(F.sum("n_offers"), F.lit(0)).alias("offers"), F.coalesce(F.sum(faults), F.lit(0)).alias("violations"))
    return got.withColumn("score", PASSED * F.col("passed") + F.col("offers") + FAILED * F.col("failed") + VIOLATION * F.col("violations"))


def best_attempt(outcomes: DataFrame, group: str, attempt: str) -> DataFrame:
    """(group, attempt): the attempt of the highest score in each group, of equal ones the first."""
    scored = evaluation(outcomes, group, attempt)
    return compare.best_by(scored, [group], attempt, [F.col("score"), -F.col(attempt)], attempt)


def split_prints(sample: DataFrame) -> DataFrame:
    """(split, fingerprints): the structural groups that each split of a bounded sample covers."""
    return sample.groupBy("split").agg(F.array_sort(F.collect_set("fingerprint")).alias("fingerprints"))


def to_repair(outcomes: DataFrame, records: DataFrame, order: str) -> DataFrame:
    """The first failed outcome's record, by its id, with its problems."""
    bad = outcomes.where(~F.col("ok")).orderBy(order).limit(1).select("source_record_id", "problems")
    return records.join(F.broadcast(bad), "source_record_id")


def run_counters(rows: DataFrame) -> DataFrame:
    """One row of counters of the model path, from rows (cached, n_offers, availability, error)."""
    fine = F.col("error").isNull()
    return rows.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(fine & ~F.col("cached")).alias("llm_calls"), F.count_if(fine & F.col("cached")).alias("cache_hits"),
        F.coalesce(F.sum(F.when(fine, F.col("n_offers"))), F.lit(0)).alias("offers"), F.count_if(fine & (F.col("availability") == "unavailable")).alias("unavailable"), F.count_if(~fine).alias("errors"),
    )
