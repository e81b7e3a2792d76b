"""Incremental runs: new snapshot files through Structured Streaming, once each.

A checkpoint remembers what was read and written, so a second run adds nothing: failed
records are done as well. ``retry_failed`` gives the other contract, by keys found in
the output. Ids seen before are dropped; with a watermark, only within it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.plans.normalize import normalize
from millrace.sources.snapshots import records


def stream_rows(spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet", files_per_batch: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def distinct_rows(rows: DataFrame, keys: list[str], event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """Rows with new keys; with an event time, state older than the delay is let go."""
    if event_time is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def run(spark: SparkSession, folder: str, schema: str, output: str, checkpoint: str, provider: str | None = None, pattern: str = "*.parquet") -> None:
    """Read all files that came since the last run; append their offers, errors and outcomes."""

    def batch(df: DataFrame, number: int) -> None:
        # A batch that is run again overwrites its own folder, and what its first try wrote isn't done.
        got = normalize(records(df, folder, provider), completed=done(number))
        for name, part in (("offers", got.offers), ("errors", got.errors), ("records", got.records.select("source_record_id", "provider", "ok", "skipped", "n_offers"))):
            if name == "offers":
                part = part.withColumn("raw_offer", F.to_json("raw_offer"))
            part.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{output}/{name}/run={number}")

    def done(number: int) -> DataFrame | None:
        from pyspark.errors import AnalysisException

        try:
            return spark.read.parquet(f"{output}/records").where(F.col("run") != number).select("source_record_id")
        except AnalysisException:  # the first batch
            return None

    q = stream_rows(spark, folder, schema, pattern).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def retry_failed(rows: DataFrame, cards: DataFrame, key: str = "row_key", force: bool = False) -> DataFrame:
    """Rows without a card yet: failed ones wrote none, so they come again; ``force`` takes all."""
    return rows if force else rows.join(cards.select(key).distinct(), key, "left_anti")
