"""Conflict-constrained best-fit packing of documents into sequences.

A document is cut into pieces of at most ``capacity``; pieces of one document never
share a bin with one another, with a piece of the same duplicate cluster, or with a
piece of the same source (``source_limit`` pieces of one source, if above 1). Bins
are kept in the order of their free room and carry two bitmaps: sources (one bit for
each source and use) and clusters. A piece looks at the bins from the least room that
holds it upward and takes the first, hence tightest, whose bitmaps don't meet its
own; none means a new bin. Pieces come by falling size.

Documents are dealt to shards by a hash, so shards hold a bounded number of pieces
whatever sources and clusters look like, and each is packed alone; only ids, lengths
and hashes are shuffled. Offsets are code points of the text.

Defined results: null or empty text makes one piece of length 0. Null source is a
source, null id an id. Repeated rows are rows of their own, in one cluster (equal
text), so they land in different bins. An empty table gives no bins.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship_package, table

CAPACITY = 8192
SOURCE_LIMIT = 4
SHARD_ROWS = 2048


class Packer:
    """Bins by free room. ``add`` gives the number of the bin that takes a piece."""

    def __init__(self, capacity: int, source_limit: int):
        self.capacity, self.source_limit = capacity, source_limit
        self.free: list[tuple[int, int]] = []  # (room, bin), ascending
        self.sources: list[int] = []
        self.clusters: list[int] = []

    def _source_bit(self, used: int, source: int) -> int:
        """A free bit among the source's ``source_limit`` bits; 0 if all are taken."""
        for j in range(self.source_limit):
            bit = 1 << (source * self.source_limit + j)
            if not used & bit:
                return bit
        return 0

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """(bin, offset within the bin)."""
        mark = 1 << cluster
        for i in range(bisect_left(self.free, (size, -1)), len(self.free)):
            room, b = self.free[i]
            if self.clusters[b] & mark:
                continue
            bit = self._source_bit(self.sources[b], source)
            if bit:
                del self.free[i]
                break
        else:
            room, b, bit = self.capacity, len(self.sources), self._source_bit(0, source)
            self.sources.append(0)
            self.clusters.append(0)
        self.sources[b] |= bit
        self.clusters[b] |= mark
        insort(self.free, (room - size, b))
        return b, self.capacity - room


def pack(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", cluster: Column | None = None, capacity: int = CAPACITY, source_limit: int = SOURCE_LIMIT, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(shard, bin, at, doc_id, source, piece, start, length), a row for each piece.

    ``cluster`` names the duplicates; by default documents of equal text are.
    """
    ship_package(docs.sparkSession)
    cluster = F.xxhash64(text) if cluster is None else cluster
    thin = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), F.coalesce(F.length(text), F.lit(0)).cast("long").alias("size"), cluster.cast("long").alias("cluster")
    ).select("*", F.monotonically_increasing_id().alias("row"))
    n_shards = max(1, -(-docs.select(F.lit(1)).count() // shard_rows))
    piece = F.posexplode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.col("size") - 1), F.lit(capacity).cast("long"))).alias("piece", "start")
    # Pieces of a long text spread over shards as well; equal rows are told apart by their place.
    pieces = thin.select("*", piece).withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", F.pmod("row", F.lit(1 << 33))), F.lit(n_shards)).cast("int"))

    def run(key, rows: pd.DataFrame) -> pd.DataFrame:
        rows["length"] = (rows["size"] - rows["start"]).clip(upper=capacity)
        rows["cluster"] = rows["cluster"].fillna(0).astype("int64")
        rows["__s"] = rows["source"].fillna("\x00")
        rows = rows.sort_values(["length", "doc_id", "piece", "cluster", "__s"], ascending=[False, True, True, True, True], kind="stable").reset_index(drop=True)
        sources, clusters = pd.factorize(rows["__s"], sort=True)[0], pd.factorize(rows["cluster"], sort=True)[0]
        packer = Packer(capacity, source_limit)
        got = [packer.add(int(n), int(s), int(c)) for n, s, c in zip(rows["length"], sources, clusters)]
        rows["bin"], rows["at"] = [b for b, _ in got], [a for _, a in got]
        return rows[["shard", "bin", "at", "doc_id", "source", "piece", "start", "length"]]

    kind = dict(thin.dtypes)["doc_id"]
    return pieces.groupBy("shard").applyInPandas(run, f"shard int, bin int, at long, doc_id {kind}, source string, piece int, start long, length long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The last stage: where each piece of each document goes."""
    return pack(docs)
