"""Document fingerprints by context-triggered piecewise hashing.

A rolling hash of the last 7 bytes runs over the UTF-8 text. At block size 2**b a
chunk ends where the low b bits of that hash are all ones, so boundaries depend on
nearby bytes only and those of a larger block size are among those of a smaller one.
The block size follows the length (about ``USUAL`` chunks); it grows while there are
more than ``MOST`` boundaries and shrinks while there are fewer than ``LEAST``. Of a
symbol that comes more than ``RUN`` times in a row, as in texts that repeat
themselves, as many stay. Every chunk
gives a symbol of 12 bits (two base-64 characters). A fingerprint is
``b:signature at 2**b:at 2**(b+1):at 2**(b+2)``.

Two fingerprints are compared at block sizes that both have: one minus the edit
distance (insertions and deletions of symbols) over the summed signature lengths,
largest over these sizes; without a common size 0. Equal fingerprints are 1 alike,
an empty text (fingerprint ``0:::``) is unlike any other.

The edited text of a document needs the next one in id order. Rows are dealt to
buckets that follow the ids, sorted within, and each bucket also gets the first row
of the next non-empty one, so no row passes through one task.

Defined results: null text is empty. Null ids come first. Rows that repeat an id are
ordered by their text; each has a result. A single row follows itself. Extra columns
are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BASE, BYTE_CODE, chunks, key_buckets, partitions, powers, ship_package, span_hashes, splitmix, table, utf8

ROLL = 7
LEAST_BITS = 1
USUAL, LEAST, MOST, RUN = 48, 8, 1024, 3
LEVELS = 3
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_SYMBOLS = np.array([a + b for a in ALPHABET for b in ALPHABET])


def boundaries(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, number of low one bits) of all bytes whose rolling hash ends in a one bit."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = BYTE_CODE[buf]
    weight = powers(BASE, ROLL + 1)
    roll = np.zeros(n, np.uint64)
    since = np.arange(n) - np.repeat(off[:-1], np.diff(off))  # bytes before this one in its text
    with np.errstate(over="ignore"):
        for j in range(min(ROLL, n)):
            part = code[: n - j] * weight[j + 1]
            part[since[j:] < j] = 0
            roll[j:] += part
    roll = splitmix(roll)
    at = np.flatnonzero(roll & np.uint64(1))
    # Low one bits: the zero bits below the lowest one of the successor.
    up = roll[at] + np.uint64(1)
    ones = np.bitwise_count((up & (~up + np.uint64(1))) - np.uint64(1)).astype(np.int64)
    return at, ones


def fingerprints(arr: pa.Array) -> list[str]:
    """The fingerprints of all texts."""
    buf, off = utf8(arr)
    at, ones = boundaries(buf, off)
    first = np.searchsorted(at, off)
    out = []
    spans, meta = [], []
    for d in range(len(off) - 1):
        if off[d + 1] == off[d]:
            meta.append((0, []))
            continue
        mine, bits = at[first[d] : first[d + 1]], ones[first[d] : first[d + 1]]
        counts = np.bincount(np.minimum(bits, 64), minlength=66)[::-1].cumsum()[::-1]
        b = max(LEAST_BITS, int((off[d + 1] - off[d]) // USUAL).bit_length())
        while counts[min(b, 65)] > MOST:
            b += 1
        while b > LEAST_BITS and counts[min(b, 65)] < LEAST and counts[min(b, 65) - 1] <= MOST:
            b -= 1
        sizes = []
        for level in range(b, b + LEVELS):
            ends = mine[bits >= level] + 1 if level <= 64 else mine[:0]
            if not len(ends) or ends[-1] != off[d + 1]:
                ends = np.append(ends, off[d + 1])
            spans.append((np.concatenate([[off[d]], ends[:-1]]), ends))
            sizes.append(len(ends))
        meta.append((b, sizes))
    if spans:
        starts, ends = (np.concatenate(x).astype(np.int64) for x in zip(*spans))
        symbols = _SYMBOLS[(span_hashes(buf, starts, ends) >> np.uint64(52)).astype(np.int64)]
    k = 0
    for b, sizes in meta:
        parts = []
        for n in sizes:
            one = symbols[k : k + n]
            if n > RUN:
                same = one[1:] == one[:-1]
                if same.any():
                    since = np.arange(n) - np.maximum.accumulate(np.where(np.append(True, ~same), np.arange(n), 0))
                    one = one[since < RUN]
            parts.append("".join(one))
            k += n
        out.append(f"{b}:" + ":".join(parts or [""] * LEVELS))
    return out


def common_length(a: list[str], b: list[str]) -> int:
    """Length of the longest common subsequence, a bit for each symbol of ``a``."""
    where: dict[str, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


def likeness(x: str, y: str) -> float:
    """From 0 to 1; 1 for equal fingerprints."""
    if x == y:
        return 1.0
    bx, *sx = x.split(":")
    by, *sy = y.split(":")
    best = 0.0
    mine = {int(bx) + i: s for i, s in enumerate(sx) if s}
    for i, t in enumerate(sy):
        s = mine.get(int(by) + i)
        if s and t:
            a, b = ([z[j : j + 2] for j in range(0, len(z), 2)] for z in (s, t))
            distance = len(a) + len(b) - 2 * common_length(a, b)
            best = max(best, 1 - distance / (len(a) + len(b)))
    return best


def edited(own: str, following: str) -> str:
    """``own`` with its last half of code points replaced by the first as many of ``following``."""
    half = len(own) // 2
    return own[: len(own) - half] + following[:half]


def in_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, __b bucket, __next: belongs to a later bucket), sorted within partitions by bucket and id.

    Every bucket ends with a row of the next non-empty bucket (the first bucket's for the last).
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    bucket, _ = key_buckets(docs, "doc_id", 4 * partitions(spark))
    rows = docs.withColumn("__b", bucket)
    # The least id of each bucket, and the bucket that needs it: as many rows as buckets.
    heads = rows.groupBy("__b").agg(F.min("doc_id").alias("doc_id"), F.max(F.col("doc_id").isNull()).alias("__null")).withColumn("doc_id", F.when(~F.col("__null"), F.col("doc_id")))
    listed = sorted(((r["__b"], r["doc_id"]) for r in heads.select("__b", "doc_id").collect()), key=lambda r: r[0])
    if not listed:
        return rows.withColumn("__next", F.lit(False))
    moved = spark.createDataFrame([(b, listed[i - 1][0], i == 0) for i, (b, _) in enumerate(listed)], "__b int, __to int, __wrap boolean")
    ids = spark.createDataFrame(listed, "__b int, __least long")
    first = rows.join(F.broadcast(ids), "__b").where(F.col("doc_id").eqNullSafe(F.col("__least"))).drop("__least")
    # Of rows that share the least id, the first by text.
    w = Window.partitionBy("__b").orderBy(F.col("text").asc_nulls_first())
    first = first.withColumn("__r", F.row_number().over(w)).where("__r = 1").join(F.broadcast(moved), "__b")
    first = first.select("doc_id", "text", F.col("__to").alias("__b"), F.lit(True).alias("__next"))
    both = rows.withColumn("__next", F.lit(False)).unionByName(first)
    order = ["__b", "__next", F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return both.repartition(partitions(spark), "__b").sortWithinPartitions(*order)


def fingerprint_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of all texts, of their edited forms, and the likenesses."""
    ship_package(docs.sparkSession)

    def run(batches):
        held = None  # (doc_id, text, bucket, fingerprint) whose follower is still to come
        for batch in batches:
            for c in chunks(batch, "text"):
                prints = fingerprints(c.column("text"))
                done = []
                for doc_id, text, b, lent, fp in zip(c.column("doc_id").to_pylist(), c.column("text").to_pylist(), c.column("__b").to_pylist(), c.column("__next").to_pylist(), prints):
                    text = text or ""
                    if held is not None and held[2] == b:
                        done.append((*held, edited(held[1], text), likeness(held[3], fp)))
                    held = None if lent else (doc_id, text, b, fp)
                new = fingerprints(pa.array([d[4] for d in done], pa.string()))
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": pa.array([d[0] for d in done], pa.int64()),
                        "n_chars": pa.array([len(d[1]) for d in done], pa.int64()),
                        "edited_sha256": pa.array([hashlib.sha256(d[4].encode()).hexdigest() for d in done], pa.string()),
                        "fingerprint": pa.array([d[3] for d in done], pa.string()),
                        "edited_fingerprint": pa.array(new, pa.string()),
                        "near_edited": pa.array([likeness(d[3], e) for d, e in zip(done, new)], pa.float64()),
                        "near_next": pa.array([d[5] for d in done], pa.float64()),
                    }
                )

    return in_order(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_pairs(table(spark, sf_dir, "documents"))
