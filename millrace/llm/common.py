"""Shared folders, written tables and byte-level text primitives of the operators.

Texts are handled as one UTF-8 buffer with offsets, so that words, shingles and
rolling hashes are numpy operations over whole chunks. Hashes are 64-bit and
their seeds are fixed: equal inputs hash equally on every executor.
"""

from __future__ import annotations

import atexit
import gc
import math
import os
import sys
import tempfile
import time
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_BYTES = 1 << 20
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


# -- folders and tables ----------------------------------------------------------


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir``, removed when the session's process ends.

    Where that is unset, a temporary folder serves a local session; on a cluster it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.conf.set("spark.checkpoint.dir", root)
    path = f"{root.rstrip('/')}/millrace-{name}-{uuid.uuid4().hex}"
    atexit.register(remove, spark, path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Best effort: at the end of the process the session may be gone."""
    try:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    except Exception as e:  # noqa: BLE001  nothing depends on it
        print(f"left behind: {path}: {type(e).__name__}", file=sys.stderr)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet and read it back: cuts lineage and survives lost executors."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished jobs now, not when the driver happens to collect its garbage."""
    for _ in range(2):  # what the first round frees may hold others
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.3)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors, once for each context; keep Arrow batches of texts small."""
    sc = spark.sparkContext
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", None) is None:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if getattr(sc, "_millrace_shipped", False):
        return
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    out = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace_pkg.zip")
    with zipfile.ZipFile(out, "w") as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("millrace", os.path.relpath(full, here)))
    sc.addPyFile(out)
    sc._millrace_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns that are named like results (Spark tells names apart without case): the results replace them."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


def crc_fold(col: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo; null for null."""
    return F.crc32(F.encode(col.cast("string"), "UTF-8")) % F.lit(modulus)


def key_buckets(df: DataFrame, key: str, n: int) -> tuple[Column, list]:
    """Bucket numbers that follow the order of a numeric key, with about as many rows each.

    The bounds are approximate quantiles (``n`` - 1 numbers on the driver); a null key
    falls into bucket 0. The rule is explicit, so a recomputed task deals rows alike.
    """
    cuts = [i / n for i in range(1, n)]
    got = df.select(F.percentile_approx(F.col(key), cuts, 10000).alias("q")).first()["q"] if cuts else None
    bounds = sorted(set(got or []))
    if not bounds:
        return F.lit(0), bounds
    # Number of bounds <= key: first among every width-th bound, then within its stretch.
    width = math.isqrt(len(bounds)) + 1
    reached = lambda arr: F.size(F.filter(arr, lambda b: b <= F.col(key)))
    coarse = F.greatest(reached(F.lit(bounds[::width])) - 1, F.lit(0)) * width
    at = coarse + reached(F.slice(F.lit(bounds), coarse + 1, F.lit(width)))
    return F.when(F.col(key).isNull(), F.lit(0)).otherwise(at), bounds


# -- sums of vectors -----------------------------------------------------------

VECTOR_ROWS = "id int, draw double, vec binary"


def vector_rows(rows: list[tuple[int, float, np.ndarray]]) -> pa.RecordBatch:
    ids, draws, vecs = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(draws, pa.float64()), pa.array([v.astype(float).tobytes() for v in vecs], pa.binary())], names=["id", "draw", "vec"])


def vector_totals(parts: DataFrame) -> dict[int, np.ndarray]:
    """Of the vectors of each id their sum; of a negative id that with the smallest draw."""

    def add(batches):
        got: dict[int, tuple[float, np.ndarray]] = {}
        for b in batches:
            for i, draw, vec in zip(*(c.to_pylist() for c in b.columns)):
                v = np.frombuffer(vec)
                if i >= 0:
                    got[i] = (0.0, got[i][1] + v if i in got else v)
                elif i not in got or draw < got[i][0]:
                    got[i] = (draw, v)
        if got:
            yield vector_rows([(i, d, v) for i, (d, v) in got.items()])

    return {r["id"]: np.frombuffer(r["vec"]) for r in parts.repartition("id").mapInArrow(add, VECTOR_ROWS).collect()}


# -- bytes -----------------------------------------------------------------------


def splitmix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection of 64-bit numbers."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = x + np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


BYTE_CODE = splitmix(np.arange(1, 257, dtype=np.uint64))
BASE = 0x5851F42D4C957F2D
BASE_INVERSE = pow(BASE, -1, 1 << 64)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** (0 .. n-1) modulo 2**64."""
    got = _powers.get(base)
    if got is None or len(got) < n:
        size = max(n, 1 << 16)
        seq = np.full(size, base, dtype=np.uint64)
        seq[0] = 1
        with np.errstate(over="ignore"):
            got = _powers[base] = np.multiply.accumulate(seq)
        if size > 1 << 24:  # of a very long text: not kept
            del _powers[base]
    return got[:n]


def utf8(arr: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks() if arr.num_chunks != 1 else arr.chunk(0)
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    arr = pc.fill_null(arr.cast(pa.large_string()), "")
    _, offs, data = arr.buffers()
    off = np.frombuffer(offs, np.int64)[arr.offset : arr.offset + len(arr) + 1]
    buf = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return buf[off[0] : off[-1]], off - off[0]


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES, rows: int = 1 << 30):
    """Slices of the batch with about ``limit`` bytes of text and at most ``rows`` rows each, one row at least."""
    if batch.num_rows == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    at, done = 0, 0
    while at < batch.num_rows:
        to = max(at + 1, min(at + rows, int(np.searchsorted(ends, done + limit, "right"))))
        yield batch.slice(at, to - at)
        done, at = int(ends[to - 1]), to


def word_spans(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words (runs of other bytes than 0x20 and 0x09-0x0D) and, for each text, where its words begin."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    solid = ~IS_SPACE[buf]
    begin, end = solid.copy(), solid.copy()
    begin[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    first = off[:-1][off[1:] > off[:-1]]
    begin[first] = solid[first]
    last = off[1:][off[1:] > off[:-1]] - 1
    end[last] = solid[last]
    starts = np.flatnonzero(begin)
    return starts, np.flatnonzero(end) + 1, np.searchsorted(starts, off)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans, each from two prefix values of one polynomial."""
    with np.errstate(over="ignore"):
        prefix = np.zeros(len(buf) + 1, np.uint64)
        np.cumsum(BYTE_CODE[buf] * powers(BASE, len(buf)), out=prefix[1:])
        h = (prefix[ends] - prefix[starts]) * powers(BASE_INVERSE, len(buf) + 1)[starts]
        return splitmix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def words(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased (A-Z) words and, for each text, where its words begin."""
    buf, off = utf8(arr)
    buf = LOWER[buf]
    starts, ends, first = word_spans(buf, off)
    return span_hashes(buf, starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> list[np.ndarray]:
    """For each text its sorted distinct hashes of k consecutive words; of all words where there are fewer."""
    with np.errstate(over="ignore"):
        m = len(hashes)
        roll = np.zeros(max(0, m - k + 1), np.uint64)
        for j in range(k):
            roll += hashes[j : m - k + 1 + j] * np.uint64(pow(BASE, j + 1, 1 << 64)) if m >= k else roll
        roll = splitmix(roll)
        out = []
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= k:
                out.append(np.unique(roll[a : b - k + 1]))
            elif b > a:
                h = np.uint64(b - a)
                for x in hashes[a:b]:
                    h = splitmix(h * np.uint64(BASE) + x)
                out.append(np.array([h], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def passing(schema, extra: str = ""):
    """A DDL of the schema's fields and further ones, for mapInArrow."""
    own = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    return own + (", " + extra if extra else "")
