"""The model-assisted path behind an injected client, with a cache table.

``client`` is a picklable callable from a reduced page's text to the answer's JSON
text. Answers are kept by a hash of model, version and text, so only new texts are
asked about; asking runs in Arrow batches, one client for each task.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "1"
TRIES, PAUSE = 3, 1.5


def cache_key(model: str, text, version: str = VERSION):
    return F.sha2(F.concat_ws("\0", F.lit(model), F.lit(version), text), 256)


def asked(client: Callable[[str], str], text: str, tries: int = TRIES, pause: float = PAUSE) -> tuple[str | None, str | None]:
    """(answer, error) after some tries with growing pauses."""
    error = None
    for i in range(tries):
        try:
            return client(text), None
        except Exception as e:  # the client's own errors become the row's error
            error = f"{type(e).__name__}: {e}"
            if i + 1 < tries:
                time.sleep(pause * (i + 1))
    return None, error


def answers(pages: DataFrame, client: Callable[[str], str], model: str, cache: str | None = None, text: str = "text", pause: float = PAUSE) -> DataFrame:
    """``pages`` with ``answer``, ``error`` and ``cached``; new answers are added to the cache table (a folder)."""
    spark: SparkSession = pages.sparkSession
    keyed = pages.withColumn("key", cache_key(model, F.col(text)))
    wanted = keyed.select("key", F.col(text).alias("text")).dropDuplicates(["key"])
    known = spark.createDataFrame([], "key string, answer string")
    if cache is not None:
        from pyspark.errors import AnalysisException

        try:
            known = spark.read.schema("key string, answer string").parquet(cache)
        except AnalysisException:  # not written yet
            pass
        wanted = wanted.join(known.select("key"), "key", "left_anti")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            got = [asked(client, t, pause=pause) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.string())], names=["key", "answer", "error"])

    fresh = wanted.mapInArrow(run, "key string, answer string, error string")
    if cache is not None:
        fresh = fresh.persist()  # asked once: written to the cache and joined below
        fresh.where("answer is not null").select("key", "answer").write.mode("append").parquet(cache)
    both = known.select("key", "answer", F.lit(None).cast("string").alias("error"), F.lit(True).alias("cached")).unionByName(fresh.withColumn("cached", F.lit(False)))
    return keyed.join(both, "key", "left")


def grounded(offer, block):
    """An answer's offer with what its source block doesn't hold taken out; null where its price isn't there."""
    from millrace.functions import text as T

    keep = lambda c: F.when(T.number_in_text(offer[c].cast("double"), block), offer[c])
    ok = T.number_in_text(offer["price"], block)
    out = offer
    for c in ("price_old", "connection_cost", "internet_speed_mbps", "tv_channels", "mobile_minutes", "mobile_data_gb"):
        out = out.withField(c, keep(c))
    out = out.withField("technology", F.when(F.contains(F.lower(block), F.lower(offer["technology"])), offer["technology"]))
    found = F.filter(offer["evidence"], lambda e: F.contains(T.folded(block), T.folded(e)))
    out = out.withField("evidence", F.when(F.size(found) > 0, found).otherwise(F.slice(T.lines(block), 1, 4)))
    return F.when(ok, out)
