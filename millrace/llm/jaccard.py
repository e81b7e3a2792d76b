"""N-gram Jaccard join by PartEnum signatures, and the groups that its links form.

A document's set holds the hashes of its distinct runs of k words. Two documents
link when ``den`` * |intersection| >= ``num`` * |union|.

Sizes fall into bands whose bounds grow by den/num. Band t's tag covers the pairs whose
smaller set lies in it, so a set is signed under its own band and under the one below.
The symmetric difference of such a pair is at most ``k``. The hashed feature domain is
cut into n1 parts of n2 partitions each; a part in which a pair differs by at most k2
elements has a subset of n2 - k2 partitions without difference, and a signature is the
content of one such subset. Small k: one part, n2 = k + 2, k2 = k. Larger ones: n2 = 3,
k2 = 1, and ``spare`` parts more than are needed, so a linked pair shares signatures in
``spare`` + 1 parts at least.

The spare parts are what each set may leave out. Subsets without an element are left out
first: they say nothing and would be alike in all sets of a band. Then a set leaves out
its most frequent signatures (by a count that all sets see alike) while they touch no more
than the spare parts left: of the shared signatures the rarest is then left out by neither
set. A set with empty subsets in more parts than are spare leaves out none but those, and is
signed again under further hash functions until it has few enough; a pair meets under the
first hash function that suits one of the two.

Equal sets form classes first, and one text signs for each. Sets with a common
signature are compared with one of them, the one that shares most signatures (a star,
not all pairs). What doesn't link with it is compared with the rest in blocks of
bounded size: by the triangle inequality only with others outside the star, and with
the star's members where the distance to the centre allows it. The comparison uses
parity sketches, whose distance never exceeds the true one; what remains is verified
on the whole texts. Components come from repeated large-star and small-star steps. Joins
by a star's centre or a copied text are salted.

Defined results: null or empty text, or text without a word: the set is empty and the
row is alone (``component_id`` is its own id). A null id gets a null component. Rows
that repeat an id are one document with several texts; each returns, and all their links
count. Extra columns are not read by the join; the stage passes them through.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import chunks, partitions, shared_dir, shingles, ship_package, splitmix, stored, table, words

BLOCK = 128  # rows of a side in one comparison of the rest
BROADCAST_IDS = 4_000_000  # ids (8 bytes each) that a broadcast may hold; beyond, the join shuffles
FAN = 512  # rows of one key that a salted join gives a task
SMALL_K = 4
ROUNDS = 8  # hash functions; sets that suit none of them keep their empty subsets
PART_BITS = 15  # low bits of a signature that hold its part


class Layout(NamedTuple):
    parts: int
    cells: int
    differences: int  # that a part may hold
    spare: int


class Scheme:
    """Bands, partitions and signatures for one threshold num/den."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    @lru_cache(maxsize=None)
    def band(self, i: int) -> tuple[int, int]:
        """Least and largest size of band i."""
        lo = 1 if i == 0 else self.band(i - 1)[1] + 1
        return lo, lo * self.den // self.num

    @lru_cache(maxsize=1 << 16)
    def band_of(self, size: int) -> int:
        i = 0
        while self.band(i)[1] < size:
            i += 1
        return i

    def differences(self, total):
        """The largest symmetric difference of linked sets with ``total`` elements together."""
        return (self.den - self.num) * total // (self.den + self.num)

    @lru_cache(maxsize=None)
    def layout(self, tag: int) -> Layout | None:
        """Of the pairs whose smaller set lies in the band; None: only equal sets link."""
        hi = self.band(tag)[1]
        k = self.differences(hi + hi * self.den // self.num)
        if k == 0:
            return None
        if k <= SMALL_K:
            return Layout(1, k + 2, k, 0)
        n1 = (k + 2) // 2
        spare = 1 + n1 // 4
        return Layout(n1 + spare, 3, 1, spare)

    def tags(self, size: int) -> list[int]:
        """The bands under which a set of this size is signed."""
        if not size:
            return []
        own = self.band_of(size)
        return [own] + [t for t in (own - 1,) if t >= 0 and size * self.num <= self.band(t)[1] * self.den]

    def sketch_bits(self, size: int) -> int:
        k = max(1, self.differences(2 * size))
        return int(min(1 << 16, max(256, 1 << int(8 * k - 1).bit_length())))

    def sketch(self, s: np.ndarray) -> bytes:
        """Parities of the elements in each of a power of two of bins."""
        bits = self.sketch_bits(len(s))
        odd = np.bincount((s >> np.uint64(17)).astype(np.int64) & (bits - 1), minlength=bits) & 1
        return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()

    def signatures(self, sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, signature, group) of all signatures of the sets.

        A group holds a set's signatures of one tag and hash function: its low 19 bits
        are the number of parts that the set may leave out, the others tell groups apart.
        """
        todo = [(i, t) for i, s in enumerate(sets) for t in self.tags(len(s)) if self.layout(t)]
        out: list[tuple] = []
        for r in range(ROUNDS):
            again = []
            shapes: dict = {}
            for x in todo:
                lay = self.layout(x[1])
                shapes.setdefault((lay.cells, lay.differences), []).append(x)
            for (cells, gone), jobs in shapes.items():
                again += self._signed(sets, jobs, cells, gone, r, out)
            todo = again
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*out))

    def _signed(self, sets, jobs, cells: int, gone: int, r: int, out: list) -> list:
        """Append the signatures of jobs (set, tag) of one shape; those that must be signed again."""
        rows, tags = (np.array(x, np.int64) for x in zip(*jobs))
        parts = np.array([self.layout(t).parts for _, t in jobs], np.int64)
        spare = np.array([self.layout(t).spare for _, t in jobs], np.int64)
        base = np.cumsum(parts) - parts
        x = np.concatenate([sets[i] for i in rows])
        of = np.repeat(np.arange(len(jobs)), [len(sets[i]) for i in rows])
        mixed = splitmix(x ^ splitmix(np.uint64(0x5DEECE66D + r)))
        part = base[of] + (((mixed >> np.uint64(32)) * parts[of].astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        cell = part * cells + (((mixed & np.uint64(0xFFFFFFFF)) * np.uint64(cells)) >> np.uint64(32)).astype(np.int64)
        total = int(parts.sum())
        value = splitmix(x)
        sums = [np.bincount(cell, v.astype(float), minlength=total * cells).astype(np.uint64) for v in (value & np.uint64(0xFFFFFFFF), value >> np.uint64(32))]
        held = np.bincount(cell, minlength=total * cells).reshape(total, cells)
        job = np.repeat(np.arange(len(jobs)), parts)
        index = np.arange(total) - base[job]
        picks = np.array(list(combinations(range(cells), cells - gone)))
        with np.errstate(over="ignore"):
            content = (sums[0] + (sums[1] << np.uint64(32))).reshape(total, cells)
            inside = held[:, picks].sum(axis=2)
            tag = splitmix(tags.astype(np.uint64) * np.uint64(0x1F123BB5) + np.uint64(r))
            name = splitmix(tag[job] + index.astype(np.uint64))[:, None] + np.arange(len(picks)).astype(np.uint64)
            sig = splitmix(content[:, picks].sum(axis=2, dtype=np.uint64) ^ splitmix(name))
        low = np.uint64((1 << PART_BITS) - 1)
        sig = (sig & ~low) | (index.astype(np.uint64)[:, None] & low)
        empty = inside == 0
        hollow = np.bincount(job, empty.any(axis=1), minlength=len(jobs)).astype(np.int64)
        fine = hollow <= spare
        keep = ~empty if r + 1 < ROUNDS else ~empty | ~fine[job][:, None]
        may = np.where(fine & (parts <= 1 << PART_BITS), np.minimum(spare - hollow, (1 << 19) - 1), 0)
        group = ((np.int64(r) << 20) | ((tags & 1) << 19)) | may
        at = np.broadcast_to(job[:, None], keep.shape)[keep]
        out.append((rows[at], sig[keep], group[at]))
        return [jobs[i] for i in np.flatnonzero(~fine)]

    def linked(self, a: np.ndarray, b: np.ndarray) -> bool:
        if not len(a) or not len(b):
            return False
        both = len(np.intersect1d(a, b, assume_unique=True))
        return self.den * both >= self.num * (len(a) + len(b) - both)

    def limit(self, n, m):
        """Largest distance of a linked pair of these sizes."""
        return self.differences(n + m)

    def near_limit(self, centre, other):
        """Beyond this distance to the centre, ``other`` can't link with what links with the centre."""
        reach = centre * self.den // self.num
        return self.differences(2 * reach + centre + other) + 2


def folded(x: bytes, y: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Two sketches at their common width (halves of a wider one meet by exclusive or)."""
    a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    while len(a) > len(b):
        a = a[: len(a) // 2] ^ a[len(a) // 2 :]
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return a, b


def sketch_distance(x: bytes, y: bytes) -> int:
    a, b = folded(x, y)
    return int(np.bitwise_count(a ^ b).sum())


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x, pa.int64())


def set_keys(sets: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each whole set: the class number and a check of it."""
    with np.errstate(over="ignore"):
        sums = [np.array([splitmix(s ^ np.uint64(c)).sum(dtype=np.uint64) + np.uint64(len(s)) for s in sets], np.uint64) for c in (0, 0xABCDEF12345)]
        return splitmix(sums[0] + splitmix(sums[1] + np.uint64(seed))), sums[1]


def features(docs: DataFrame, scheme: Scheme, k: int, seed: int) -> DataFrame:
    """doc_id, n (set size), cls (hash of the whole set), another hash of it, sketch."""

    def run(batches):
        for b in batches:
            for c in chunks(b, "text"):
                sets = shingles(*words(c.column("text")), k)
                cls, check = set_keys(sets, seed)
                yield pa.RecordBatch.from_arrays(
                    [c.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()), _long(cls), _long(check), pa.array([scheme.sketch(s) if len(s) else None for s in sets], pa.binary())],
                    names=["doc_id", "n", "cls", "proof", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n long, cls long, proof long, sketch binary")


def signature_rows(docs: DataFrame, scheme: Scheme, k: int, seed: int) -> DataFrame:
    """(sig, cls, grp) of all signatures of the documents' sets."""

    def run(batches):
        for b in batches:
            for c in chunks(b, "text"):
                sets = shingles(*words(c.column("text")), k)
                row, sig, group = scheme.signatures(sets)
                cls, _ = set_keys(sets, seed)
                yield pa.RecordBatch.from_arrays([_long(sig), _long(cls[row]), pa.array(group.astype(np.int32), pa.int32())], names=["sig", "cls", "grp"])

    return docs.where(F.col("text").isNotNull()).select("text").mapInArrow(run, "sig long, cls long, grp int")


def class_texts(docs: DataFrame, ids: DataFrame, classes: DataFrame, k: int, seed: int) -> DataFrame:
    """(cls, text): a text (or equal ones) of each of the classes, given their documents' ids."""

    def run(batches):
        for b in batches:
            for c in chunks(b, "text"):
                cls, _ = set_keys(shingles(*words(c.column("text")), k), seed)
                yield pa.RecordBatch.from_arrays([_long(cls), c.column("text")], names=["cls", "text"])

    rows = chosen(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids).where(F.col("text").isNotNull())
    return rows.select("text").mapInArrow(run, "cls long, text string").join(classes, "cls", "left_semi")


def chosen(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id is in ``ids`` (doc_id): by broadcast where the counted ids fit, else by shuffle."""
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    return docs.join(ids, "doc_id", "left_semi")


def beside(pairs: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """``pairs`` joined with ``right`` by ``key``, which may be hot.

    ``pairs`` has ``many``, which bounds a key's rows or says how common it may be; the
    rows of a hot key are dealt to many / FAN salted keys, for which ``right`` is copied.
    """
    other = next(c for c in ("a", "b") if c != key)
    width = F.ceil(F.col("many") / FAN).cast("int")
    salted = pairs.withColumn("__m", F.greatest(F.lit(1), width)).withColumn("__s", F.expr(f"cast(pmod(xxhash64(`{other}`), __m) as int)"))
    wanted = salted.select(key, "__m", "__s").distinct()
    return salted.join(wanted.join(right, key), [key, "__m", "__s"]).drop("__m", "__s")


def near_pairs(pairs: DataFrame, nodes: DataFrame, scheme: Scheme, work: str) -> DataFrame:
    """Pairs (a, b, many) with ``state``: 0 far, 1 too far to link but near, 2 may link, by sketches."""
    a = nodes.select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa"))
    b = nodes.select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))

    def run(batches):
        for t in batches:
            state = []
            for na, nb, sa, sb in zip(*(t.column(c).to_pylist() for c in ("na", "nb", "sa", "sb"))):
                d = sketch_distance(sa, sb)
                fits = scheme.den * min(na, nb) >= scheme.num * max(na, nb)
                state.append(2 if d <= scheme.limit(na, nb) and fits else 1 if d <= scheme.near_limit(na, nb) else 0)
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b"), t.column("many"), pa.array(state, pa.int32())], names=["a", "b", "many", "state"])

    got = beside(pairs.join(b, "b"), a, "a").select("a", "b", "many", "na", "nb", "sa", "sb")
    return stored(got.mapInArrow(run, "a long, b long, many long, state int"), work)


def verified(pairs: DataFrame, texts, scheme: Scheme, k: int, work: str) -> DataFrame:
    """The pairs (a, b) of classes that link, by the sets of their whole texts."""
    pairs = pairs.select("a", "b", "many")
    texts = texts(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct())

    def run(batches):
        kept: tuple = (None, None)
        for t in batches:
            ok = []
            for x, y in zip(t.column("ta"), t.column("tb")):
                x, y = x.as_py(), y.as_py()
                if kept[0] != x:
                    kept = (x, shingles(*words(pa.array([x], pa.string())), k)[0])
                ok.append(scheme.linked(kept[1], shingles(*words(pa.array([y], pa.string())), k)[0]))
            yield pa.RecordBatch.from_arrays([t.column("a"), t.column("b")], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    a = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    b = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))
    both = beside(pairs.join(b, "b"), a, "a").select("a", "b", "ta", "tb")
    return stored(both.mapInArrow(run, "a long, b long").distinct(), work)


def components(links: DataFrame, work: str) -> DataFrame:
    """(doc, root): the least id of each node's component, for all nodes of the links (a, b)."""
    edges = stored(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{work}-links")
    last = None
    for step in range(1000):
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both, "v > u")
        small = _with_least(large, "v <> m", itself=False)
        low = large.groupBy("u").agg(F.min("v").alias("v"))
        edges = stored(small.union(low).where("u <> v").distinct(), f"{work}-{step}")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == last:
            break
        last = state
    return edges.select(F.col("u").alias("doc"), F.col("v").alias("root"))


def _with_least(edges: DataFrame, where: str, itself: bool = True) -> DataFrame:
    """Edges (v, m) for the edges (u, v) that pass, m being the least of u's neighbours (and u itself).

    A hub's edges are dealt to salted keys, as in ``beside``.
    """
    sizes = edges.groupBy("u").agg(F.min("v").alias("m"), F.ceil(F.count(F.lit(1)) / FAN).alias("__m"))
    if itself:
        sizes = sizes.withColumn("m", F.least("u", "m"))
    # Hubs have FAN edges or more, so there are at most edges / FAN of them.
    hubs = sizes.where("__m > 1")
    many = hubs.count()
    if not many:
        return edges.join(sizes, "u").where(where).select(F.col("v").alias("u"), F.col("m").alias("v"))
    hubs = F.broadcast(hubs) if many <= BROADCAST_IDS // 4 else hubs
    of_hubs = edges.join(hubs, "u").where(where)
    others = edges.join(hubs.select("u"), "u", "left_anti").join(sizes.where("__m <= 1"), "u").where(where)
    return of_hubs.select("v", "m").union(others.select("v", "m")).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _rooted(df: DataFrame, roots: DataFrame, key: str, out: str) -> DataFrame:
    r = roots.select(F.col("doc").alias(key), F.col("root").alias("__root"))
    return df.join(r, key, "left").withColumn(out, F.coalesce("__root", key)).drop("__root")


def kept_signatures(live: DataFrame) -> DataFrame:
    """(sig, cls) without the most frequent signatures that a group may leave out.

    live (sig, cls, grp, c: the signature's rows). A group's signatures, from the most
    frequent on, are left out while they touch no more parts than it may leave out.
    """
    part = F.col("sig").bitwiseAND((1 << PART_BITS) - 1)
    heat = [F.desc("c"), F.desc("sig")]
    first = F.row_number().over(Window.partitionBy("cls", "grp", "part").orderBy(*heat)) == 1
    touched = F.sum("first").over(Window.partitionBy("cls", "grp").orderBy(*heat).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = live.withColumn("part", part).repartition(partitions(live.sparkSession), "cls", "grp")
    rows = rows.withColumn("first", first.cast("int")).withColumn("touched", touched)
    return rows.where(F.col("touched") > F.col("grp").bitwiseAND((1 << 19) - 1)).select("sig", "cls")


def rest_pairs(live: DataFrame, stars: DataFrame, roots: DataFrame, nodes: DataFrame, scheme: Scheme) -> DataFrame:
    """Pairs within signature groups that the stars leave open and that sketches don't rule out.

    live (sig, doc, pivot), stars (a: pivot, b: doc, state: 0 far, 1 near, 3 linked); a doc is a class here.
    """
    seen = stars.select(F.col("a").alias("pivot"), F.col("b").alias("doc"), "state")
    rows = live.join(seen, ["pivot", "doc"], "left").withColumn("state", F.when(F.col("doc") == F.col("pivot"), 3).otherwise(F.coalesce("state", F.lit(0))))
    rows = _rooted(rows, roots, "doc", "label")
    out, star = F.col("state") < 3, F.col("state") == 3
    groups = rows.groupBy("sig").agg(
        F.sum(out.cast("long")).alias("n_out"), F.sum(star.cast("long")).alias("n_star"), F.sum((F.col("state") == 1).cast("long")).alias("n_near"),
        F.min(F.when(out, F.col("label"))).alias("out_lo"), F.max(F.when(out, F.col("label"))).alias("out_hi"),
        F.min("label").alias("lo"), F.max("label").alias("hi"),
    )
    groups = groups.where((F.col("out_lo") != F.col("out_hi")) | ((F.col("n_near") > 0) & (F.col("lo") != F.col("hi"))))
    rows = rows.join(groups.drop("lo", "hi", "out_lo", "out_hi"), "sig").where(out | (F.col("n_near") > 0))
    rows = rows.join(nodes.select(F.col("cls").alias("doc"), "n", "sketch"), "doc")
    blocks = lambda c: F.greatest(F.lit(1), F.ceil(F.col(c) / BLOCK)).cast("int")
    rows = rows.withColumn("bo", blocks("n_out")).withColumn("bs", blocks("n_star"))
    at = lambda n: F.expr(f"cast(pmod(xxhash64(doc), {n}) as int)")
    key = lambda side, kind, i, j: F.struct(F.lit(side).alias("side"), F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    none = F.array().cast("array<struct<side:int,kind:int,i:int,j:int>>")
    outer = F.transform(upto("bo"), lambda j: key(0, 0, F.least(at("bo"), j), F.greatest(at("bo"), j)))
    near = F.when(F.col("state") == 1, F.transform(upto("bs"), lambda j: key(0, 1, at("bo"), j))).otherwise(none)
    mine = F.when(star & (F.col("n_near") > 0), F.transform(upto("bo"), lambda i: key(1, 1, i, at("bs")))).otherwise(none)
    rows = rows.withColumn("k", F.explode(F.when(star, mine).otherwise(F.concat(outer, near)))).select("sig", "k.kind", "k.i", "k.j", "k.side", "doc", "label", "n", "sketch")
    rows = rows.repartition(partitions(live.sparkSession), "sig", "kind", "i", "j").sortWithinPartitions("sig", "kind", "i", "j")

    def compare(group):
        """Pairs of one block, given its rows (kind, side, doc, label, n, sketch)."""
        width = min(len(g[5]) for g in group)
        s = np.stack([folded(g[5], bytes(width))[0] for g in group])
        n = np.array([g[4] for g in group])
        label, doc = np.array([g[3] for g in group]), np.array([g[2] for g in group])
        side = np.array([g[1] for g in group])
        for x in range(len(group)):
            if group[0][0] == 1 and side[x] == 1:
                continue
            other = np.arange(len(group)) > x if group[0][0] == 0 else side == 1
            y = np.flatnonzero(other & (label != label[x]))
            if len(y):
                y = y[np.bitwise_count(s[y] ^ s[x]).sum(axis=1) <= scheme.limit(n[y], n[x])]
                y = y[scheme.den * np.minimum(n[y], n[x]) >= scheme.num * np.maximum(n[y], n[x])]
            for z in y:
                yield min(doc[x], doc[z]), max(doc[x], doc[z])

    def run(batches):
        held, key, found = [], None, []
        for t in batches:
            for r in zip(*(t.column(c).to_pylist() for c in ("sig", "i", "j", "kind", "side", "doc", "label", "n", "sketch"))):
                if r[:4] != key:
                    if len(held) > 1:
                        found += compare(held)
                    held, key = [], r[:4]
                held.append(r[3:])
            yield _pairs(found)
            found = []
        if len(held) > 1:
            found += compare(held)
        yield _pairs(found)

    return rows.mapInArrow(run, "a long, b long").distinct()


def _pairs(found) -> pa.RecordBatch:
    found = sorted(set(found))
    return pa.RecordBatch.from_arrays([pa.array([int(x[0]) for x in found], pa.int64()), pa.array([int(x[1]) for x in found], pa.int64())], names=["a", "b"])


def _classes(nodes: DataFrame, work: str) -> tuple[DataFrame, DataFrame]:
    """(classes: cls, doc (least id), n, sketch; members: doc_id, doc) of the rows with a set and an id.

    Copies are grouped in salted shares first, so that a text copied very often is many groups.
    """
    salt = F.expr(f"cast(pmod(xxhash64(doc_id), {partitions(nodes.sparkSession)}) as int)")
    rows = nodes.where("n > 0 and doc_id is not null").withColumn("salt", salt)
    lead = F.min("doc_id").over(Window.partitionBy("cls", "salt"))
    rows = stored(rows.select("doc_id", "cls", "proof", "salt", lead.alias("lead"), "n", F.when(lead == F.col("doc_id"), F.col("sketch")).alias("sketch")), f"{work}/salted")
    leads = rows.where("lead = doc_id").dropDuplicates(["cls", "salt"])
    least = F.min_by(F.struct("n", "sketch"), "doc_id").alias("s")
    classes = leads.groupBy("cls").agg(F.min("doc_id").alias("doc"), least).select("cls", "doc", "s.n", "s.sketch")
    classes = stored(classes, f"{work}/classes")
    of = leads.join(classes.select("cls", "doc"), "cls").select("cls", "salt", "doc")
    members = rows.select("doc_id", "cls", "salt").join(of, ["cls", "salt"]).select("doc_id", "cls", "doc")
    return classes, members


def join(docs: DataFrame, k: int = 5, num: int = 80, den: int = 100, links: list | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id), a row for each row of ``docs``."""
    spark = docs.sparkSession
    ship_package(spark)
    scheme = Scheme(num, den)
    work = shared_dir(spark, "jaccard")
    for seed in range(100):
        nodes = stored(features(docs, scheme, k, seed), f"{work}/nodes{seed}")
        proofs = nodes.groupBy("cls").agg(F.min("proof").alias("lo"), F.max("proof").alias("hi"), F.min("n").alias("n"), F.max("n").alias("m"))
        if proofs.where("lo <> hi or n <> m").isEmpty():  # else two sets have one class number
            break
    classes, members = _classes(nodes, work)
    # A document of several texts joins their classes.
    several = members.groupBy("doc_id").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("doc_id")
    several = stored(several.join(members, "doc_id").select(F.col("doc_id").alias("a"), F.col("doc").alias("b")), f"{work}/several")

    ids = stored(classes.select(F.col("doc").alias("doc_id"), "cls"), f"{work}/ids")

    def texts(wanted: DataFrame) -> DataFrame:
        wanted = wanted.select("cls")
        return class_texts(docs, ids.join(wanted, "cls", "left_semi").select("doc_id").distinct(), wanted, k, seed)

    signed = signature_rows(chosen(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ids.select("doc_id").distinct()), scheme, k, seed)
    w = Window.partitionBy("sig")
    shared = signed.select("sig", "cls", "grp", F.min("cls").over(w).alias("lo"), F.max("cls").over(w).alias("hi"), F.count("cls").over(w).alias("c"))
    live = stored(shared.where("lo <> hi").select("sig", "cls", "grp", "c").distinct(), f"{work}/live")
    shared = kept_signatures(live).select("sig", "cls", F.min("cls").over(w).alias("lo"), F.max("cls").over(w).alias("hi"), F.count("cls").over(w).alias("c"))
    # A group of two is one pair; its other row isn't needed.
    live = stored(shared.where("lo <> hi and (c > 2 or cls = lo)").select("sig", F.col("cls").alias("doc"), "hi", "c").distinct(), f"{work}/kept")
    pairs = live.where("c = 2").select(F.col("doc").alias("a"), F.col("hi").alias("b"), "c")
    live = live.where("c > 2").select("sig", "doc", "c")
    popular = live.groupBy("doc").agg(F.sum("c").alias("p"))
    pivots = live.join(popular, "doc").groupBy("sig").agg(F.max_by("doc", F.struct("p", "doc")).alias("pivot"))
    live = stored(live.join(pivots, "sig").select("sig", "doc", "pivot", "c"), f"{work}/stars")
    edges = live.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b"), "c").union(pairs)
    edges = edges.groupBy("a", "b").agg(F.max("c").alias("many"))
    stars = near_pairs(edges, classes, scheme, f"{work}/near")
    first = verified(stars.where("state = 2"), texts, scheme, k, f"{work}/first")
    roots = components(first, f"{work}/roots")
    mark = first.withColumn("yes", F.lit(True))
    stars = stars.join(mark, ["a", "b"], "left").select("a", "b", F.when(F.col("yes"), 3).when(F.col("state") == 2, 1).otherwise(F.col("state")).alias("state"))
    rest = stored(rest_pairs(live, stars, roots, classes, scheme), f"{work}/rest")
    second = verified(rest.withColumn("many", F.lit(FAN * 16).cast("long")), texts, scheme, k, f"{work}/second")
    by = lambda c: ids.select(F.col("cls").alias(c), F.col("doc_id").alias(f"d{c}"))
    found = beside(first.union(second).withColumn("many", F.lit(FAN * 16)).join(by("b"), "b"), by("a"), "a").select(F.col("da").alias("a"), F.col("db").alias("b"))
    roots = components(found.union(several), f"{work}/all")
    if links is not None:
        links += [first, second]
    return _labelled(nodes, classes, roots, work)


def _labelled(nodes: DataFrame, classes: DataFrame, roots: DataFrame, work: str) -> DataFrame:
    """Every row with its component: that of its class's least document, by shares of copies."""
    n = partitions(nodes.sparkSession)
    salted = nodes.withColumn("salt", F.expr(f"cast(pmod(xxhash64(doc_id), {n}) as int)"))
    ends = _rooted(classes.select("cls", "doc"), roots, "doc", "end").select("cls", "end")
    shares = salted.where("n > 0 and doc_id is not null").select("cls", "salt").distinct().join(ends, "cls")
    got = salted.join(shares, ["cls", "salt"], "left")
    return got.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.coalesce("end", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents"), k=3, num=90, den=100)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the least id, once) of each group of near duplicates by 5 words and 0.8."""
    found = join(docs)
    keep = found.where("doc_id = component_id or doc_id is null")
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("__gone")).distinct()
    gone = F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone
    out = docs.join(gone, docs["doc_id"].cast("long") == F.col("__gone"), "left_anti")
    if keep.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        return out.select(*docs.columns)
    return out.where("doc_id is null").select(*docs.columns).unionByName(out.where("doc_id is not null").dropDuplicates(["doc_id"]).select(*docs.columns))
