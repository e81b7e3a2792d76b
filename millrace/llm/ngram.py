"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are the lower-cased (A-Z) words of a text and one end token; the end token
also stands before the first. Level 1 has every distinct training token: a 63-bit
hash, by which tokens are found, and its exact count. A node of level k is a context
(a 64-bit hash of the k - 1 words before) and a word (40 bits of its hash, which tell
the words of one context apart). Every observed n-gram is a node.

A level lies in files, each a range of the contexts' hashes; a context that alone has
more than its share of a file is several files, by ranges of its words. A file has the
distinct contexts (Elias-Fano), the start of each one's words (a monotone pointer,
Elias-Fano), and the words, made monotone by the context's rank. A query goes to its
file, finds the context, and searches the word's successor within the context's range.

Probabilities are absolutely discounted and interpolated:
p(w|c) = (n(cw) - D) / n(c) + D kinds(c) / n(c) p(w|c'), kinds(c) being the number of c's
distinct words, and p(w) = (n(w) + 0.5) / (N + 0.5 (V + 1)). A node keeps n(cw) - D, a
context n(c) and the weight of the lower order, as one byte each: an index into 256
values of the file.

Counting: a task sums the n-grams of a few million tokens, then sends each file's range
one compressed block of sorted contexts, words and counts, so the shuffle has few rows.
Files are named anew by each task and listed in a table once written (a task run again
leaves an unlisted file), in the shared folder, and mapped by each executor for a visit,
not loaded.

Defined results: null or empty text has the end token only. A null id is not held out
and is learned from. Repeated rows count and are scored each. An empty training set
gives every token log10(0.5 / 0.5) = 0. Extra columns are not read.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import chunks, crc_fold, partitions, release, remove, shared_dir, ship_package, splitmix, stored, table, words
from .eliasfano import EliasFano, mapped, named, opened, pack

ORDER = 3
DISCOUNT = 0.75
FILE_ROWS = 1_000_000  # n-grams, about, that a file holds
CHUNK = 2 << 20
SCORED = 6 << 20  # bytes of text that are scored together
END = (1 << 63) - 1
COUNT_ROWS = 2_000_000  # n-grams that a task gathers before it sums them
WORD_BITS = 40


def tokens(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and where each text's begin."""
    h, first = words(arr)
    h = np.minimum(h >> np.uint64(1), np.uint64(END - 1))
    n = np.diff(first)
    start = first + np.arange(len(first))
    out = np.full(len(h) + len(n), END, np.uint64)
    out[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
    return out, start


# -- files -----------------------------------------------------------------------


def local_path(uri: str) -> str:
    """A path that can be mapped: the file itself on a mounted store, else a copy that goes with the process."""
    parts = urlparse(uri)
    if parts.scheme in ("", "file"):
        return parts.path
    store, path = pafs.FileSystem.from_uri(uri)
    fd, out = tempfile.mkstemp(prefix="millrace-")
    with os.fdopen(fd, "wb") as f, store.open_input_stream(path) as g:
        while block := g.read(1 << 24):
            f.write(block)
    return out


def write_file(folder: str, name: str, data: bytes) -> str:
    """Write under a name of its own, which is returned."""
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    name = f"{name}-{uuid.uuid4().hex}"
    with store.open_output_stream(f"{base}/{name}") as f:
        f.write(data)
    return name


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, values) of positive numbers: the 128 most frequent as they are, means of equal stretches of the logarithm for the others."""
    u, at, size = np.unique(x, return_inverse=True, return_counts=True)
    if len(u) <= 256:
        return at.astype(np.uint8), u.astype(np.float64)
    often = np.argsort(-size, kind="stable")[:128]
    other = np.setdiff1d(np.arange(len(u)), often)
    edges = np.linspace(math.log(u[other[0]]), math.log(u[other[-1]]), 129)[1:-1]
    code = np.zeros(len(u), np.int64)
    code[often] = np.arange(128)
    code[other] = 128 + np.searchsorted(edges, np.log(u[other]), "right")
    weight = np.bincount(code, size, minlength=256)
    values = np.bincount(code, size * u, minlength=256) / np.maximum(weight, 1)
    return code[at].astype(np.uint8), values


class Words:
    """A file of level 1: sorted hashes, and counts of a byte each; 255 stands for those kept apart."""

    def __init__(self, path: str):
        a, m = mapped(path)
        self.hashes = opened("hashes", a, m)
        self.small, self.at, self.large = (a[k] for k in ("small", "at", "large"))

    @staticmethod
    def data(key: np.ndarray, n: np.ndarray) -> bytes:
        at = np.flatnonzero(n >= 255)
        arrays, meta = {"small": np.minimum(n, 255).astype(np.uint8), "at": at, "large": n[at].astype(np.int64)}, {}
        named("hashes", EliasFano.build(key), arrays, meta)
        return pack(arrays, meta)

    def find(self, key: np.ndarray) -> np.ndarray:
        return self.hashes.find(key)

    def counts(self, at: np.ndarray) -> np.ndarray:
        out = self.small[at].astype(np.int64)
        large = np.flatnonzero(out == 255)
        out[large] = self.large[np.searchsorted(self.at, at[large])]
        return out


class Grams:
    """A file of a level from 2 on."""

    def __init__(self, path: str):
        a, m = mapped(path)
        self.contexts, self.starts, self.words = (opened(k, a, m) for k in ("contexts", "starts", "words"))
        self.least = np.uint64(m["least"])
        self.counts, self.totals, self.rests = ((a[f"{k}.codes"], a[f"{k}.values"]) for k in ("counts", "totals", "rests"))

    @staticmethod
    def data(context: np.ndarray, word: np.ndarray, n: np.ndarray, whole: tuple[int, int] | None = None) -> tuple[bytes, int]:
        """The file of sorted n-grams, and its number of contexts; ``whole``: count and kinds of its one context in all files."""
        begin = np.flatnonzero(np.concatenate([[True], context[1:] != context[:-1]]))
        kinds = np.diff(np.append(begin, len(context)))
        total = np.add.reduceat(n, begin).astype(float)
        if whole:
            total, known = np.array([float(whole[0])]), np.array([float(whole[1])])
        else:
            known = kinds.astype(float)
        arrays, meta = {}, {}
        for name, x in (("counts", n - DISCOUNT), ("totals", total), ("rests", DISCOUNT * known / total)):
            arrays[f"{name}.codes"], arrays[f"{name}.values"] = quantised(x.astype(float))
        rank = np.repeat(np.arange(len(begin), dtype=np.uint64), kinds)
        # A file's contexts lie in one range: the distance from the least needs fewer bits.
        meta["least"] = int(context[0])
        named("contexts", EliasFano.build(context[begin] - context[0]), arrays, meta)
        named("starts", EliasFano.build(np.append(begin, len(context))), arrays, meta)
        named("words", EliasFano.build((rank << np.uint64(WORD_BITS)) | word), arrays, meta)
        return pack(arrays, meta), len(begin)

    def look(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(share, rest) for queries sorted by context: the node's share of its context (0 if absent), the weight of the lower order (1 if the context is absent)."""
        share, rest = np.zeros(len(context)), np.ones(len(context))
        new = np.concatenate([[True], context[1:] != context[:-1]])
        context = context[new]
        j = np.full(len(context), -1, np.int64)
        above = np.flatnonzero(context >= self.least)
        j[above] = self.contexts.find(context[above] - self.least)
        lo = np.zeros(len(j), np.int64)
        hi = lo.copy()
        there = np.flatnonzero(j >= 0)
        lo[there], hi[there] = (v.astype(np.int64) for v in self.starts.pair(j[there]))
        at = np.cumsum(new) - 1
        ok = np.flatnonzero(j[at] >= 0)
        of = j[at[ok]]
        pos = self.words.find((of.astype(np.uint64) << np.uint64(WORD_BITS)) | word[ok], lo[at[ok]], hi[at[ok]])
        rest[ok] = self.rests[1][self.rests[0][of]]
        hit = pos >= 0
        share[ok[hit]] = self.counts[1][self.counts[0][pos[hit]]] / self.totals[1][self.totals[0][of[hit]]]
        return share, rest


class Level:
    """All files of level 1, in the order of their keys."""

    def __init__(self, folder: str, files: list[tuple[int, str, int]]):
        self.folder, self.files = folder, files  # (least key, name, entries)
        self.least = np.array([f[0] for f in files], np.uint64)
        self.paths: dict[int, str] = {}

    def __reduce__(self):
        return Level, (self.folder, self.files)

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """Counts of the tokens; 0 where unknown."""
        uniq, back = np.unique(keys, return_inverse=True)
        got = np.zeros(len(uniq))
        at = np.append(np.searchsorted(uniq, self.least), len(uniq))
        for i in np.flatnonzero(np.diff(at) > 0):
            if i not in self.paths:
                self.paths[i] = local_path(f"{self.folder}/{self.files[i][1]}")
            file = Words(self.paths[i])  # mapped for this visit alone
            j = file.find(uniq[at[i] : at[i + 1]])
            ok = np.flatnonzero(j >= 0)
            got[at[i] + ok] = file.counts(j[ok])
        return got[back]


class Ranges:
    """Where the n-grams of a level lie: ranges of contexts, and of words for contexts that are common."""

    def __init__(self, ranges: int, hot: list[tuple[int, int, int]]):
        """``hot``: (context, count, distinct words or 0 if not known) of contexts with more than a file's share."""
        hot = sorted(hot)
        self.ranges, self.hot = ranges, hot
        self.context = np.array([h[0] for h in hot], np.uint64)
        self.width = np.array([-(-h[1] // FILE_ROWS) for h in hot], np.int64)
        self.first = ranges + np.cumsum(self.width) - self.width

    def files(self) -> int:
        return self.ranges + int(self.width.sum())

    def of(self, context: np.ndarray, word: np.ndarray) -> np.ndarray:
        out = (((context >> np.uint64(32)) * np.uint64(self.ranges)) >> np.uint64(32)).astype(np.int64)
        if len(self.context):
            k = np.minimum(np.searchsorted(self.context, context), len(self.context) - 1)
            at = np.flatnonzero(self.context[k] == context)
            k = k[at]
            out[at] = self.first[k] + ((word[at] * self.width[k].astype(np.uint64)) >> np.uint64(WORD_BITS)).astype(np.int64)
        return out


class Nodes:
    """All files of a level from 2 on."""

    def __init__(self, folder: str, ranges: Ranges, names: dict[int, str]):
        self.folder, self.ranges, self.names = folder, ranges, names
        self.paths: dict[int, str] = {}

    def __reduce__(self):
        return Nodes, (self.folder, self.ranges, self.names)

    def raise_order(self, p: np.ndarray, context: np.ndarray, word: np.ndarray, ok: np.ndarray) -> None:
        """Put the probabilities of this level in place of the lower order's in ``p``, for the tokens ``ok``."""
        order = ok[np.argsort(context[ok])]
        of = self.ranges.of(context[order], word[order])
        if len(self.ranges.hot):
            again = np.argsort(of, kind="stable")
            order, of = order[again], of[again]
            del again
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]])
        for lo, hi in zip(cuts[:-1], cuts[1:]) if len(of) else []:
            i = int(of[lo])
            if i in self.names:
                if i not in self.paths:
                    self.paths[i] = local_path(f"{self.folder}/{self.names[i]}")
                rows = order[lo:hi]
                share, rest = Grams(self.paths[i]).look(context[rows], word[rows])  # mapped for this visit alone
                p[rows] = share + rest * p[rows]


# -- the model -------------------------------------------------------------------


def below(h: np.ndarray) -> np.ndarray:
    """The bits by which the words of one context are told apart."""
    return h >> np.uint64(63 - WORD_BITS)


def contexts(h: np.ndarray, start: np.ndarray, order: int):
    """(context hashes, tokens that have one) of level 2, 3 and so on, the end token standing before each text."""
    padded = np.empty(len(h), np.uint64)
    padded[1:] = h[:-1]
    padded[start[:-1]] = END
    last, c = below(padded), splitmix(padded)
    del padded
    yield c, np.arange(len(h))
    inside = np.arange(len(h)) - np.repeat(start[:-1], np.diff(start))
    for k in range(3, order + 1):  # a context is the one before its last word, and that word
        longer = np.zeros(len(h), np.uint64)
        longer[1:] = c[:-1]
        c = longer_context(longer, last, k)
        yield c, np.flatnonzero(inside >= k - 2)


def longer_context(context: np.ndarray, word: np.ndarray, k: int) -> np.ndarray:
    """The hash of a context of level k, from that of level k - 1 and the bits of its last word."""
    with np.errstate(over="ignore"):
        return splitmix(context * np.uint64(0x9FB21C651E98DF25) + word + np.uint64(k))


class Trie:
    def __init__(self, n_tokens: int, n_distinct: int, first: Level | None):
        self.n, self.v, self.first = n_tokens, n_distinct, first
        self.levels: list[Nodes] = []

    def unigram(self, counts: np.ndarray) -> np.ndarray:
        return (counts + 0.5) / (self.n + 0.5 * (self.v + 1))

    def walk(self, h: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(counts, probabilities) of all tokens."""
        counts = self.first.counts(h) if self.first else np.zeros(len(h))
        p = self.unigram(counts)
        word = below(h)
        for nodes, (context, ok) in zip(self.levels, contexts(h, start, len(self.levels) + 1)):
            nodes.raise_order(p, context, word, ok)
        return counts, p


def _words_files(df: DataFrame, folder: str, rows: int) -> Level:
    """Write the sorted words of level 1 as files of about FILE_ROWS."""
    n = max(1, -(-rows // FILE_ROWS))

    def run(batches):
        got = [b for b in batches if b.num_rows]
        if got:
            t = pa.Table.from_batches(got)
            key, count = (t.column(c).to_numpy() for c in ("key", "n"))
            name = write_file(folder, "level1", Words.data(key.astype(np.uint64), count))
            yield pa.RecordBatch.from_arrays([pa.array([int(key[0])], pa.int64()), pa.array([name]), pa.array([len(t)], pa.int64())], names=["least", "file", "n"])

    out = stored(df.select("key", "n").repartitionByRange(n, "key").sortWithinPartitions("key").mapInArrow(run, "least long, file string, n long"), f"{folder}/list1")
    return Level(folder, sorted((r["least"], r["file"], r["n"]) for r in out.collect()))


def _taken(held: list) -> list[np.ndarray]:
    """The columns of all parts, which are let go."""
    out = [np.concatenate(x) for x in zip(*held)]
    held.clear()
    return out


def _summed(context: np.ndarray, word: np.ndarray, n: np.ndarray | None = None):
    """Sorted distinct (context, word) with their counts; without ``n`` each row counts once."""
    if not len(context):
        return context, word, np.zeros(0, np.int64)
    # Columns are large: each goes as soon as it has served.
    order = np.argsort(context)
    context = context[order]
    word = word[order]
    new = np.concatenate([[True], context[1:] != context[:-1]])
    rank, uniq = np.cumsum(new), context[new]
    rank -= 1
    del context, new
    if rank[-1] >> (64 - WORD_BITS):  # too many contexts for a key of rank and word
        again = np.lexsort((word, rank))
    else:
        key = rank.astype(np.uint64)
        key <<= np.uint64(WORD_BITS)
        key |= word
        if n is None:
            del order, rank, word
            key.sort()
            begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            size = np.diff(begin, append=len(key))
            key = key[begin]
            return uniq[(key >> np.uint64(WORD_BITS)).astype(np.int64)], key & np.uint64((1 << WORD_BITS) - 1), size
        again = np.argsort(key)
        del key
    rank, word = rank[again], word[again]
    n = np.ones(len(rank), np.int64) if n is None else n[order[again]]
    begin = np.flatnonzero(np.concatenate([[True], (rank[1:] != rank[:-1]) | (word[1:] != word[:-1])]))
    return uniq[rank[begin]], word[begin], np.add.reduceat(n, begin)


_CODEC = "zstd"


def _planes(x: np.ndarray, width: int) -> bytes:
    return np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(len(x), -1).T[:width]).tobytes()


def _block(context: np.ndarray, word: np.ndarray, n: np.ndarray) -> bytes:
    """Sorted n-grams as compressed byte planes: differences of contexts, places in the sorted list of distinct words, counts, and that list's differences."""
    listed, at = np.unique(word, return_inverse=True)
    step = lambda x: np.diff(x, prepend=np.uint64(0))
    planes = _planes(step(context), 8) + _planes(at, 4) + _planes(n, 8) + _planes(step(listed), WORD_BITS // 8)
    return len(n).to_bytes(8, "little") + len(listed).to_bytes(8, "little") + pa.Codec(_CODEC, 1).compress(planes, asbytes=True)


def _unblock(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    m, d = int.from_bytes(raw[:8], "little"), int.from_bytes(raw[8:16], "little")
    shape = ((m, 8), (m, 4), (m, 8), (d, WORD_BITS // 8))
    x = np.frombuffer(pa.Codec(_CODEC).decompress(raw[16:], sum(r * w for r, w in shape), asbytes=True), np.uint8)
    out, at = [], 0
    for r, w in shape:
        full = np.zeros((r, 8), np.uint8)
        full[:, :w] = x[at : at + w * r].reshape(w, r).T
        out.append(full.reshape(-1).view(np.uint64))
        at += w * r
    step, place, n, listed = out
    return np.cumsum(step, dtype=np.uint64), np.cumsum(listed, dtype=np.uint64)[place.astype(np.int64)], n.astype(np.int64)


def train(texts: DataFrame, order: int = ORDER) -> Trie:
    """Build the trie from all rows of ``texts`` (text)."""
    spark = texts.sparkSession
    ship_package(spark)
    folder = shared_dir(spark, "ngram")
    texts = texts.select("text")

    def count_words(batches):
        held, size = [], 0

        def out():
            h, n = _taken(held)
            u, at = np.unique(h, return_inverse=True)
            return pa.RecordBatch.from_arrays([pa.array(u.astype(np.int64)), pa.array(np.bincount(at, n).astype(np.int64))], names=["key", "n"])

        for b in batches:
            for c in chunks(b, "text", CHUNK):
                held.append(np.unique(tokens(c.column("text"))[0], return_counts=True))
                size += len(held[-1][0])
                if size > COUNT_ROWS:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    level1 = stored(texts.mapInArrow(count_words, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), f"{folder}/words")
    total = level1.agg(F.count(F.lit(1)).alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()
    if not total["v"]:
        return Trie(0, 0, None)
    trie = Trie(total["n"], total["v"], _words_files(level1, folder, total["v"]))
    # At most total / FILE_ROWS words can be that frequent.
    hot = [(int(splitmix(np.uint64(r["key"]))), r["n"], 0) for r in level1.where(F.col("n") > FILE_ROWS).collect()]
    remove(spark, f"{folder}/words")  # level 1 has them
    for k in range(2, order + 1):
        nodes, hot = _add_level(texts, folder, k, total["n"], hot)
        trie.levels.append(nodes)
        release(spark)
    return trie


def _add_level(texts: DataFrame, folder: str, k: int, n_tokens: int, hot: list) -> tuple[Nodes, list]:
    """The nodes of level k, and the contexts of the next level with more than a file's share."""
    ranges = Ranges(max(1, -(-n_tokens // FILE_ROWS)), hot)

    def count(batches):
        held, size = [], 0

        def out():
            context, word, n = _summed(*_taken(held))
            of = ranges.of(context, word)
            by = np.argsort(of, kind="stable")
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(of[by])) + 1, [len(by)]])
            for lo, hi in zip(cuts[:-1], cuts[1:]):
                rows = by[lo:hi]
                if len(rows):
                    yield pa.RecordBatch.from_arrays([pa.array([int(of[rows[0]])], pa.int64()), pa.array([_block(context[rows], word[rows], n[rows])], pa.binary())], names=["file", "block"])

        for b in batches:
            for c in chunks(b, "text", CHUNK):
                h, start = tokens(c.column("text"))
                *_, (context, ok) = contexts(h, start, k)
                held.append((context[ok], below(h)[ok]))
                size += len(ok)
                if size > COUNT_ROWS:
                    yield from out()
                    held, size = [], 0
        if held:
            yield from out()

    def merged(batches):
        """(file, context, word, n) of each file of the partition, whose blocks stand together."""
        file, held, size = None, [], 0
        for b in batches:
            for f, raw in zip(b.column("file").to_pylist(), b.column("block")):
                if f != file:
                    if held:
                        yield file, *_summed(*_taken(held))
                    file, held, size = f, [], 0
                held.append(_unblock(raw.as_py()))
                size += len(held[-1][0])
                if size > 4 * FILE_ROWS and len(held) > 1:  # blocks of many tasks repeat n-grams
                    held = [_summed(*_taken(held))]
                    size = len(held[0][0]) // 2
        if held:
            yield file, *_summed(*_taken(held))

    def build(batches):
        for file, context, word, n in merged(batches):
            if not len(n):
                continue
            whole = file >= ranges.ranges
            if whole:  # the context lies in several files: its sums come with the second pass
                name = write_file(folder, f"part{k}-{file:08d}", _block(context, word, n))
            else:
                name = write_file(folder, f"level{k}-{file:08d}", Grams.data(context, word, n)[0])
            big = np.flatnonzero(n > FILE_ROWS)
            ahead = longer_context(context[big], word[big], k + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int64()), pa.array([name]), pa.array([int(n.sum())], pa.int64()), pa.array([len(n)], pa.int64()), pa.array([ahead.view(np.int64).tolist()], pa.list_(pa.int64())), pa.array([n[big].tolist()], pa.list_(pa.int64()))],
                names=["file", "name", "total", "kinds", "ahead", "count"],
            )

    spark = texts.sparkSession
    blocks = texts.mapInArrow(count, "file long, block binary")
    width = min(max(1, ranges.files()), partitions(spark))
    dealt = blocks.repartition(width, "file").sortWithinPartitions("file")
    done = stored(dealt.mapInArrow(build, "file long, name string, total long, kinds long, ahead array<long>, count array<long>"), f"{folder}/list{k}").collect()
    names = {r["file"]: r["name"] for r in done}
    if ranges.hot:
        names |= _whole_contexts(spark, folder, k, ranges, [r for r in done if r["file"] >= ranges.ranges])
    ahead = [(int(np.int64(c).astype(np.uint64)), n, 0) for r in done for c, n in zip(r["ahead"], r["count"])]
    return Nodes(folder, ranges, names), ahead


def _whole_contexts(spark: SparkSession, folder: str, k: int, ranges: Ranges, parts: list) -> dict[int, str]:
    """Files of the contexts that lie in several, given what each holds of them."""
    sums: dict[int, list[int]] = {}
    owner = {}
    for r in parts:
        i = int(np.searchsorted(ranges.first, r["file"], "right")) - 1
        owner[r["file"]] = i
        s = sums.setdefault(i, [0, 0])
        s[0] += r["total"]
        s[1] += r["kinds"]

    def build(batches):
        for b in batches:
            for file, name, total, kinds in zip(*(b.column(c).to_pylist() for c in ("file", "name", "total", "kinds"))):
                store, base = pafs.FileSystem.from_uri(folder)
                with store.open_input_stream(f"{base}/{name}") as f:
                    rows = _unblock(f.read())
                out = write_file(folder, f"level{k}-{file:08d}", Grams.data(*rows, whole=(total, kinds))[0])
                yield pa.RecordBatch.from_arrays([pa.array([file], pa.int64()), pa.array([out])], names=["file", "name"])

    if not parts:
        return {}
    todo = spark.createDataFrame([(r["file"], r["name"], *sums[owner[r["file"]]]) for r in parts], "file long, name string, total long, kinds long")
    done = stored(todo.repartition(min(len(parts), partitions(spark)), "file").mapInArrow(build, "file long, name string"), f"{folder}/whole{k}")
    return {r["file"]: r["name"] for r in done.collect()}


def score(docs: DataFrame, trie: Trie) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for rows (doc_id, held_out, text)."""
    ship_package(docs.sparkSession)

    names = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def scored(held: list) -> pa.RecordBatch:
        ids, outs, parts, sizes = zip(*held)
        h, start = np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        held.clear()
        del parts
        counts, p = trie.walk(h, start)
        total = lambda x: np.add.reduceat(x, start[:-1])  # noqa: E731  every text has a token
        sums = [np.diff(start), total((counts > 0).astype(np.int64)), np.full(len(start) - 1, trie.n, np.int64), total(np.log10(trie.unigram(counts))), total(np.log10(p))]
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(outs), *map(pa.array, sums)], names=names)

    def run(batches):
        held, size = [], 0
        for b in batches:
            for c in chunks(b, "text", CHUNK):
                h, start = tokens(c.column("text"))  # hashing takes some 40 bytes a byte of text
                held.append((c.column("doc_id"), c.column("held_out"), h, np.diff(start)))
                size += c.nbytes
                if size > SCORED:  # the more queries at a time, the fewer visits to each file
                    yield scored(held)
                    size = 0
        if held:
            yield scored(held)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.coalesce(crc_fold(F.col("doc_id"), 5) == 1, F.lit(False))
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), held.alias("held_out"), "text")
    return score(docs, train(docs.where(~F.col("held_out"))))
