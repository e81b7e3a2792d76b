"""Language identification by nearest centroids of TF-IDF n-gram vectors.

A text becomes the counts of its hashed letter n-grams (1 to 3 bytes of the
lower-cased text, everything but letters taken as one space), damped by 1 + log,
weighted by inverse document frequency and scaled to length 1. Every language has
several centroids from spherical k-means. A text takes the language of the
centroid with the highest cosine; it is rejected where that is lower than all but
``REJECT_QUANTILE`` of the training texts of its language and length have it.

All of it comes from all training texts. Their counts are written once, in the shared
folder, one row for each distinct text of a language with its number of copies. Document
frequencies count every copy; k-means++ seeds, k-means and quantiles take every distinct text,
each step a pass over those rows whose sums are formed on the executors. A text's cosine for
the quantiles is to centroids without that text (its vector is taken out of the sum), rounded
down to a multiple of 1 / ``GRID``. Where a language has too few of a length, those of all
languages count, then those of the next longer lengths too.

Defined results: null text or text without a letter: ``und``, score 0, rejected.
Null or repeated ids change nothing, each row is judged by its own text. Without
any training text every text is ``und``. Extra columns pass through; one that is named
like a result column is replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import VECTOR_ROWS, chunks, crc_fold, passing, remove, shared_dir, ship_package, splitmix, stored, table, utf8, vector_rows, vector_totals, without

BINS = 4096
ORDERS = 3
ROWS = 256  # texts whose dense count vectors are held at a time
CENTROIDS = 4
LENGTH_BANDS = 8  # by powers of 4 of the n-gram count
REJECT_QUANTILE = 0.02  # of the cosines of training texts, by language and length band
GRID = 1 << 13  # steps of a cosine that the quantiles tell apart
ENOUGH = 100  # texts for a quantile of their own
LETTER = re.compile(r"[^\W\d_]")

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
# Upper-case accented Latin letters (U+00C0-U+00DE) are 0xC3 0x80-0x9E in UTF-8.
_SEED = splitmix(np.arange(1, ORDERS + 1, dtype=np.uint64))


def count_vectors(arr: pa.Array) -> np.ndarray:
    """A row of n-gram counts for each text."""
    buf, off = utf8(arr)
    docs = len(off) - 1
    low = _FOLD[buf].astype(np.uint32)
    if len(low):
        upper = np.zeros(len(low), bool)
        upper[1:] = (buf[:-1] == 0xC3) & (buf[1:] >= 0x80) & (buf[1:] <= 0x9E)
        low[upper] += 0x20
    doc = np.repeat(np.arange(docs, dtype=np.int64), np.diff(off))
    out = np.zeros(docs * BINS, np.float32)
    for k in range(1, ORDERS + 1):
        m = len(low) - k + 1
        if m <= 0:
            break
        gram = np.zeros(m, np.uint32)
        letter = np.zeros(m, bool)
        for j in range(k):
            gram = gram * np.uint32(256) + low[j : m + j]
            letter |= low[j : m + j] != 32
        ok = letter & (doc[:m] == doc[k - 1 :])
        h = (gram[ok] * np.uint32(2654435769 + 2 * k)) ^ np.uint32(_SEED[k - 1] & np.uint64(0xFFFFFFFF))
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        out += np.bincount(doc[:m][ok] * BINS + (h >> np.uint32(20)), minlength=docs * BINS)
    return out.reshape(docs, BINS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts), idf)


def unit(damped: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = damped * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.where(norm > 0, norm, 1)[:, None]


def length_band(counts: np.ndarray) -> np.ndarray:
    n = counts.sum(axis=1)
    return np.clip(np.log2(np.maximum(n, 1)) // 2, 0, LENGTH_BANDS - 1).astype(int)


@dataclass
class Model:
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray  # language index of each centroid
    languages: list[str]
    floor: np.ndarray  # smallest accepted cosine by language and length band

    def predict(self, arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Languages, cosines and rejections of the texts."""
        lang, cos, rejected, _ = self.judge(arr)
        return lang, cos, rejected

    def judge(self, arr: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Languages, cosines, rejections and length bands of the texts."""
        n = len(arr)
        letters = np.array([bool(LETTER.search(t)) if t else False for t in arr.to_pylist()], bool)
        if not n or not self.languages:
            return ["und"] * n, np.zeros(n), np.ones(n, bool), np.zeros(n, int)
        counts = count_vectors(arr)
        cos = weighted(counts, self.idf) @ self.centroids.T
        best = cos.argmax(axis=1)
        top = np.clip(cos[np.arange(n), best].astype(float), 0, 1)
        band = length_band(counts)
        rejected = ~letters | (top < self.floor[self.owner[best], band])
        lang = [self.languages[self.owner[b]] if ok else "und" for b, ok in zip(best, letters)]
        return lang, np.where(letters, top, 0.0), rejected, band


def _encoded(arr: pa.Array) -> tuple[list[bytes], list[bytes]]:
    """Of each text a bit for each bin that it has, and their counts in as few bytes each as hold the largest."""
    x = count_vectors(arr)
    bins = np.packbits(x > 0, axis=1)
    some = [r[r > 0] for r in x]
    wide = [np.min_scalar_type(int(r.max())) if len(r) else np.uint8 for r in some]
    return [r.tobytes() for r in bins], [r.astype(w).tobytes() for r, w in zip(some, wide)]


def _decoded(bins: list[bytes], counts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(which bins the texts have, their counts in that order)."""
    has = np.unpackbits(np.frombuffer(b"".join(bins), np.uint8).reshape(-1, BINS // 8), axis=1).view(bool)
    sizes = has.sum(axis=1)
    return has, np.concatenate([np.frombuffer(c, f"u{len(c) // n}" if n else "u1").astype(np.float32) for c, n in zip(counts, sizes)])


def _slices(batches):
    for b in batches:
        for i in range(0, b.num_rows, ROWS):
            c = b.slice(i, ROWS)
            yield c, *_decoded(c.column("bins").to_pylist(), c.column("counts").to_pylist())


def _units(has: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.zeros(has.shape, np.float32)
    x[has] = np.log1p(counts)
    return unit(x, idf)


@dataclass
class _Texts:
    """All distinct texts of a language, by their number and the vector of one."""

    n: int
    first: np.ndarray

    def __len__(self) -> int:
        return self.n


def _kmeans(x: _Texts, k: int, rounds: int = 12):
    """Spherical k-means from k-means++ seeds; no more centroids than texts.

    A generator: it yields centroids and is sent what a pass over all of ``x`` finds, another
    seed (False) or the sums of the vectors by nearest centroid (True). So one pass serves all
    languages. Returns the last centroids asked about, the sums by them, and the sums' directions.
    """
    c = x.first[None].astype(np.float32)
    while len(c) < min(k, len(x)):
        c = np.concatenate([c, (yield False, c)[None].astype(np.float32)])
    for _ in range(rounds):
        before, sums = c, (yield True, c)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 0, sums / np.maximum(norm, 1e-12), before).astype(np.float32)
        if np.abs(c - before).max() < 1e-6:  # further rounds change nothing
            break
    return before, sums, c


def _answers(texts: DataFrame, idf: np.ndarray, index: dict[str, int], asked: dict[int, tuple[bool, np.ndarray]]) -> dict[int, np.ndarray]:
    """What the languages' k-means ask for, from one pass over all texts."""
    cents = np.concatenate([c for _, c in asked.values()])
    owner = np.concatenate([np.full(len(c), i) for i, (_, c) in asked.items()])
    summed = np.concatenate([np.full(len(c), s) for s, c in asked.values()])

    def run(batches):
        sums, seeds = np.zeros((len(cents), BINS)), {}
        for c, has, counts in _slices(batches):
            lang = np.array([index[k] for k in c.column("lang").to_pylist()])
            x = _units(has, counts, idf)
            cos = np.where(owner == lang[:, None], x @ cents.T, -2)
            of = cos.argmax(axis=1)
            near = cos[np.arange(len(x)), of]
            near[near == -2] = 1  # of languages that ask for nothing more
            hot = (of[:, None] == np.arange(len(cents))) & (owner == lang[:, None])
            sums += hot.T.astype(np.float32) @ x
            # Texts are drawn in proportion to their squared distance: the smallest of exponential waiting times.
            number = np.frombuffer(b"".join(k[:8] for k in c.column("key").to_pylist()), np.uint64)
            luck = (splitmix(number + np.uint64(len(cents))).astype(float) + 0.5) / 2.0**64
            draw = -np.log(np.minimum(luck, 1 - 1e-16)) / np.maximum(1 - near, 1e-9)
            for i, (s, _) in asked.items():
                if not s and len(at := np.flatnonzero(lang == i)):
                    j = at[draw[at].argmin()]
                    if i not in seeds or draw[j] < seeds[i][0]:
                        seeds[i] = (draw[j], x[j])
        out = [(i, 0.0, v) for i, v in enumerate(sums) if summed[i] and v.any()] + [(-1 - i, d, v) for i, (d, v) in seeds.items()]
        if out:
            yield vector_rows(out)

    got = vector_totals(texts.mapInArrow(run, VECTOR_ROWS))
    zero = np.zeros(BINS)
    return {i: np.array([got.get(j, zero) for j in np.flatnonzero(owner == i)]) if s else got[-1 - i] for i, (s, _) in asked.items()}


def _floors(seen: np.ndarray) -> np.ndarray:
    """Smallest accepted cosines by language and length band, from the numbers of texts by language, band and step of the cosine."""
    out = np.zeros(seen.shape[:2])
    if not seen.any():
        return out
    every = seen.sum(axis=0)
    for i in range(len(seen)):
        for b in range(LENGTH_BANDS):
            at = seen[i, b] if seen[i, b].sum() >= ENOUGH else every[b]
            to = b
            while at.sum() < ENOUGH and to + 1 < LENGTH_BANDS:
                to += 1
                at = at + every[to]
            for down in range(b - 1, -1, -1):  # nothing longer is left
                if at.sum() < ENOUGH:
                    at = at + every[down]
            out[i, b] = np.searchsorted(np.cumsum(at), np.floor(REJECT_QUANTILE * (at.sum() - 1)), "right") / GRID
    # Shorter texts are never asked for more than longer ones.
    return np.minimum.accumulate(out[:, ::-1], axis=1)[:, ::-1]


def fit(train: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Learn from all rows of ``train`` whose language and text are not null. The files of training are removed at the end."""
    work = shared_dir(train.sparkSession, "language")
    try:
        return _fit(train, text, lang, work)
    finally:
        remove(train.sparkSession, work)


def _fit(train: DataFrame, text: str, lang: str, work: str) -> Model:
    spark = train.sparkSession
    ship_package(spark)
    rows = train.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.unhex(F.sha2(F.col(text).cast("binary"), 256)).alias("key"))

    def vectors(batches):
        for b in batches:
            for c in chunks(b, "text", rows=ROWS):
                bins, counts = _encoded(c.column("text"))
                yield pa.RecordBatch.from_arrays([c.column("lang"), c.column("key"), pa.array(bins, pa.binary()), pa.array(counts, pa.binary())], names=["lang", "key", "bins", "counts"])

    texts = rows.mapInArrow(vectors, "lang string, key binary, bins binary, counts binary")
    texts = texts.groupBy("lang", "key").agg(F.first("bins").alias("bins"), F.first("counts").alias("counts"), F.count(F.lit(1)).alias("n"))
    texts = stored(texts, f"{work}/texts")

    def frequencies(batches):
        df = np.zeros(BINS + 1)
        for c, has, _ in _slices(batches):
            n = c.column("n").to_numpy().astype(float)
            df += [*(n @ has), n.sum()]
        yield vector_rows([(0, 0.0, df)])

    df = vector_totals(texts.mapInArrow(frequencies, VECTOR_ROWS)).get(0, np.zeros(BINS + 1))
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)
    texts = texts.where(F.length("counts") > 0)  # others have no direction
    one = F.min(F.struct("key", "bins", "counts")).alias("one")
    sizes = {r["lang"]: r for r in texts.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), one).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model(idf, np.zeros((0, BINS), np.float32), np.zeros(0, int), [], np.zeros((0, LENGTH_BANDS)))
    index = {k: i for i, k in enumerate(languages)}
    first = [_units(*_decoded([bytes(sizes[k]["one"]["bins"])], [bytes(sizes[k]["one"]["counts"])]), idf)[0] for k in languages]
    running = {i: _kmeans(_Texts(sizes[k]["n"], first[i]), CENTROIDS) for i, k in enumerate(languages)}
    answers: dict[int, np.ndarray | None] = dict.fromkeys(running)
    done = {}
    while running:
        asked = {}
        for i, g in list(running.items()):
            try:
                asked[i] = g.send(answers[i])
            except StopIteration as e:
                done[i] = e.value
                del running[i]
        if asked:
            answers = _answers(texts, idf, index, asked)
    before, sums, cents = (np.concatenate([done[i][j] for i in range(len(languages))]).astype(np.float32) for j in range(3))
    owner = np.concatenate([np.full(len(done[i][0]), i) for i in range(len(languages))])
    model = Model(idf, cents, owner, languages, np.zeros((len(languages), LENGTH_BANDS)))
    square = np.einsum("ij,ij->i", sums, sums, dtype=float)

    def cosines(batches):
        seen = np.zeros((len(languages) * LENGTH_BANDS, GRID + 1))
        for c, has, counts in _slices(batches):
            lang = np.array([index[k] for k in c.column("lang").to_pylist()])
            x = _units(has, counts, idf)
            at = np.arange(len(x))
            member = np.where(owner == lang[:, None], x @ before.T, -2).argmax(axis=1)
            dot = (x @ sums.T)[at, member].astype(float)
            rest = square[member] - 2 * dot + 1  # of the sum without the text; 1 at least if it has another
            cos = x @ cents.T
            cos[at, member] = np.where(rest > 0.5, (dot - 1) / np.sqrt(np.maximum(rest, 0.5)), 0)
            best = cos.argmax(axis=1)
            whole = np.zeros(has.shape, np.float32)
            whole[has] = counts
            step = np.floor(np.clip(cos[at, best], 0, 1) * GRID).astype(int)
            np.add.at(seen, (owner[best] * LENGTH_BANDS + length_band(whole), step), 1)
        if seen.any():
            yield vector_rows([(i, 0.0, v) for i, v in enumerate(seen) if v.any()])

    seen = np.zeros((len(languages) * LENGTH_BANDS, GRID + 1))
    for i, v in vector_totals(texts.mapInArrow(cosines, VECTOR_ROWS)).items():
        seen[i] = v
    model.floor = _floors(seen.reshape(len(languages), LENGTH_BANDS, GRID + 1))
    return model


def classify(docs: DataFrame, model: Model, text: str = "text", pred: str = "lang_pred", score: str = "score", rejected: str = "rejected") -> DataFrame:
    """``docs`` with the predicted language, its cosine and whether it is rejected."""
    ship_package(docs.sparkSession)
    docs = without(docs, pred, score, rejected)

    def run(batches):
        for b in batches:
            for c in chunks(b, text, rows=ROWS):
                lang, cos, out = model.predict(c.column(text))
                cols = [*c.columns, pa.array(lang, pa.string()), pa.array(cos, pa.float64()), pa.array(out, pa.bool_())]
                yield pa.RecordBatch.from_arrays(cols, names=[*c.schema.names, pred, score, rejected])

    return docs.mapInArrow(run, passing(docs.schema, f"`{pred}` string, `{score}` double, `{rejected}` boolean"))


def training_rows(docs: DataFrame) -> DataFrame:
    """Rows that op7 and the pipeline may learn from."""
    return docs.where(F.coalesce(crc_fold(F.col("doc_id"), 3) != 1, F.lit(True)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(training_rows(docs))
    held = F.coalesce(crc_fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")
    return classify(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "lang_pred", "score", "rejected")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is recognised; the rejected ones go."""
    model = fit(training_rows(docs))
    return classify(docs, model, pred="__llm_lang", score="__llm_cos", rejected="__llm_out").where(~F.col("__llm_out")).select(*docs.columns)
