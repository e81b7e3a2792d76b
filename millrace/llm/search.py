"""Exact top-k inner-product search by block-at-a-time pruning.

Components are integers, floor(scale * x). Vectors are dealt to shards of bounded
size; within a shard they are reordered by recursive halving along the widest
component, and cut into document-range blocks. A block keeps, for each component
(term), its largest and smallest weight, and a forward index: its vectors' rows. For
a query, a block's bound is the sum over terms of the larger of weight times maximum
or minimum. Blocks are scored through their forward index in falling order of bounds,
until the bound is below the query's k-th score (an equal bound is still scored, for
ties go to the smaller id). Shards' results meet in a final top k by score.

Queries go to every shard in blocks of bounded size: (shard, query block) is a group,
so neither side is ever broadcast or gathered whole.

Scores are exact: float64 products where all partial sums stay below 2**53, Python
integers beyond; a score outside 64 bits becomes the nearest 64-bit integer.

Defined results: vectors that are null, or hold null, NaN or infinite components, and
rows with a null id take no part. Vectors of another length than the query's are no
candidates. Rows that repeat an id are candidates each; as a query the id counts once
(its largest vector in array order), and no row of its own id is its candidate. Fewer
candidates than k: all of them. An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import ship_package, table

SCALE = 256
K = 5
BLOCK = 64
SHARD_ROWS = 4096
QUERY_ROWS = 1024


def _order(x: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows in blocks of at most BLOCK, by halving along the component of largest spread."""
    todo, out = [rows], []
    while todo:
        r = todo.pop()
        if len(r) <= BLOCK:
            out.append(r)
            continue
        v = x[r].astype(float)
        wide = int(np.argmax(v.max(axis=0) - v.min(axis=0)))
        r = r[np.argsort(v[:, wide], kind="stable")]
        todo += [r[: len(r) // 2], r[len(r) // 2 :]]
    return out


class BlockIndex:
    """Blocks of vectors x (rows of integers) with ids, bounds and forward index."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        parts = _order(x, np.arange(len(ids)))
        self.ids = [ids[p] for p in parts]
        self.forward = [x[p] for p in parts]
        self.high = np.array([f.max(axis=0) for f in self.forward]).reshape(len(parts), x.shape[1])
        self.low = np.array([f.min(axis=0) for f in self.forward]).reshape(len(parts), x.shape[1])

    def top(self, own: int, q: np.ndarray, k: int, counted: list | None = None) -> list[tuple[int, int]]:
        """The k best (score, id) of one query, by falling score, then rising id."""
        bounds = self.high @ np.maximum(q, 0) + self.low @ np.minimum(q, 0)
        scores, ids = np.zeros(0, q.dtype), np.zeros(0, np.int64)
        for b in np.argsort(-bounds, kind="stable"):
            if len(scores) >= k and bounds[b] < scores[k - 1]:
                break
            ok = self.ids[b] != own
            scores = np.concatenate([scores, (self.forward[b] @ q)[ok]])
            ids = np.concatenate([ids, self.ids[b][ok]])
            if counted is not None:
                counted.append(len(self.ids[b]))
            best = np.lexsort((ids, -scores))[:k] if scores.dtype != object else sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
            scores, ids = scores[best], ids[best]
        return [(int(s), int(i)) for s, i in zip(scores, ids)]


def search(vectors: DataFrame, queries: DataFrame, k: int = K, scale: int = SCALE, vec_id: str = "vec_id", embedding: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query row its k best of ``vectors``."""
    ship_package(vectors.sparkSession)

    def clean(df: DataFrame) -> DataFrame:
        def whole(v: Column) -> Column:
            y = v.cast("double") * F.lit(float(scale))
            # From 2**53 on doubles are integers, and floor() to 64 bits might overflow.
            return F.when(F.abs(y) >= float(2**53), y).otherwise(F.floor(y).cast("double"))

        x = F.transform(F.col(embedding), whole)
        fine = F.forall(F.col(embedding), lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
        return df.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull() & fine).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))

    data = clean(vectors)
    asked = clean(queries).groupBy("vec_id").agg(F.max("x").alias("x"))
    shards = max(1, -(-vectors.select(F.lit(1)).count() // shard_rows))
    blocks = max(1, -(-queries.select(F.lit(1)).count() // QUERY_ROWS))
    spread = lambda n, salt: F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    # Rows of one id (copies of a very common one) are parted by their vector.
    where = F.pmod(F.xxhash64("vec_id", "x"), F.lit(shards)).cast("int")
    left = data.withColumn("shard", where).withColumn("part", every(blocks))
    right = asked.withColumn("part", spread(blocks, 1)).withColumn("shard", every(shards))

    def run(key, rows: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(rows) and len(wanted):
            lengths = rows["x"].map(len)
            for n, qs in wanted.groupby(wanted["x"].map(len)):
                own = rows[lengths == n].sort_values("vec_id", kind="stable")
                if not len(own) or n == 0:
                    continue
                x, q = (np.array(list(c), np.float64) for c in (own["x"], qs["x"]))
                if n * np.abs(x).max() * max(1.0, np.abs(q).max()) >= 2**53:
                    x, q = (np.array([[int(v) for v in r] for r in m], dtype=object) for m in (x, q))
                index = BlockIndex(own["vec_id"].to_numpy(), x)
                for own_id, v in zip(qs["vec_id"], q):
                    out += [(own_id, i, max(-(2**63), min(2**63 - 1, s))) for s, i in index.top(own_id, v, k)]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    got = left.groupBy("shard", "part").cogroup(right.groupBy("shard", "part")).applyInPandas(run, "query_id long, vec_id long, score long")
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = got.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return search(rows, rows.where(F.col("vec_id") % 50 == 0))


SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as x from embeddings
  where embedding is not null and vec_id is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), s as (
  select q.vec_id as query_id, d.vec_id as vec_id,
    cast(list_sum(list_transform(list_zip(q.x, d.x), lambda p: p[1] * p[2])) as bigint) as score
  from (select * from v where vec_id % 50 = 0) q join v d on q.vec_id <> d.vec_id and len(q.x) = len(d.x)
), r as (
  select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as rank from s
)
select query_id, rank, vec_id, score from r where rank <= 5
"""
