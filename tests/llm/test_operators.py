"""Each operator against a plain version, and on odd tables."""

import hashlib
import math
import os
import random
import re
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from millrace.llm import chat, eliasfano, fingerprint, jaccard, language, mixing, ngram, packing, records, search, toxicity
from millrace.llm.common import words
from pyspark.sql import functions as F

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def by_id(df):
    return sorted(df.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))


# -- 1 fingerprints ----------------------------------------------------------------


def test_fingerprints_follow_plain_order(docs):
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    texts = [t for _, t in rows]
    edited = [fingerprint.edited(t, texts[(i + 1) % len(texts)]) for i, t in enumerate(texts)]
    got = by_id(fingerprint.fingerprint_pairs(docs))
    assert [r.edited_sha256 for r in got] == [hashlib.sha256(e.encode()).hexdigest() for e in edited]
    assert [r.n_chars for r in got] == [len(t) for t in texts]
    alone = [fingerprint.fingerprints(pa.array([t]))[0] for t in texts]
    assert [r.fingerprint for r in got] == alone
    assert [r.near_next for r in got] == [fingerprint.likeness(a, alone[(i + 1) % len(alone)]) for i, a in enumerate(alone)]


def test_fingerprints_of_like_and_unlike_texts():
    rng = random.Random(4)
    w = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(n))
    a, b = w(300), w(300)
    fa, fb, fe = fingerprint.fingerprints(pa.array([a, b, a[:1050] + b[1050:]]))
    assert fingerprint.likeness(fa, fa) == 1 and fingerprint.likeness(fa, fe) > 0.3 > 0.1 > fingerprint.likeness(fa, fb)


def test_common_length():
    rng = random.Random(1)
    for _ in range(50):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 12))] for _ in "xy")
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert fingerprint.common_length(a, b) == t[-1][-1]


def test_fingerprints_of_odd_tables(edges, empty):
    got = fingerprint.fingerprint_pairs(edges).collect()
    assert len(got) == edges.count()
    assert {r.fingerprint for r in got if r.n_chars == 0} == {"0:::"}
    assert fingerprint.fingerprint_pairs(empty).count() == 0


# -- 2 packing ---------------------------------------------------------------------


def check_packing(rows, docs, capacity, limit):
    bins, seen = {}, Counter()
    for r in rows:
        bins.setdefault((r["shard"], r["bin"]), []).append(r)
        seen[r["doc_id"], r["start"], r["length"]] += 1
    want = Counter()
    text = {}
    for d in docs.collect():
        n = len(d.text or "")
        text.setdefault(d.doc_id, set()).add(d.text)
        for s in range(0, max(1, n), capacity):
            want[d.doc_id, s, min(capacity, n - s)] += 1
    assert seen == want
    for rs in bins.values():
        rs = sorted(rs, key=lambda r: (r["at"], r["length"]))
        assert sum(r["length"] for r in rs) <= capacity
        assert all(a["at"] + a["length"] <= b["at"] for a, b in zip(rs, rs[1:]))
        assert max(Counter(r["source"] for r in rs).values()) <= limit
        assert len({r["doc_id"] for r in rs}) == len(rs)


@pytest.mark.parametrize("shard_rows", [8, 1000])
def test_packing_keeps_its_rules(docs, shard_rows):
    check_packing(packing.pack(docs, capacity=500, source_limit=2, shard_rows=shard_rows).collect(), docs, 500, 2)


def test_packer_takes_the_tightest_compatible_bin():
    rng = random.Random(2)
    p, bins = packing.Packer(100, 2), []
    for _ in range(400):
        size, src, cl = rng.randint(0, 60), rng.randrange(4), rng.randrange(30)
        fit = [(room, i) for i, (room, s, c) in enumerate(bins) if room >= size and c.isdisjoint({cl}) and s[src] < 2]
        i = min(fit)[1] if fit else len(bins)
        if i == len(bins):
            bins.append([100, Counter(), set()])
        assert p.add(size, src, cl) == (i, 100 - bins[i][0])
        bins[i][0] -= size
        bins[i][1][src] += 1
        bins[i][2].add(cl)


def test_packing_of_odd_tables(edges, empty):
    rows = packing.pack(edges).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in edges.collect()}
    assert sum(r.length for r in rows if r.doc_id == 6) == 150000
    assert packing.pack(empty).count() == 0


# -- 3 language model ----------------------------------------------------------------


@pytest.mark.parametrize(("n", "top"), [(0, 9), (1, 5), (300, 40), (500, 1 << 50)])
def test_elias_fano(n, top):
    rng = np.random.default_rng(n)
    v = np.sort(rng.integers(0, top, n)).astype(np.uint64)
    e = eliasfano.EliasFano(*eliasfano.EliasFano.build(v))
    assert (e.access(np.arange(n)) == v).all()
    a, b = e.pair(np.arange(max(0, n - 1)))
    assert (a == v[:-1]).all() and (b == v[1:]).all()
    q = np.concatenate([v, rng.integers(0, top, 200).astype(np.uint64)])
    for x, i in zip(q, e.find(q)):
        assert (i >= 0) == (x in v) and (i < 0 or v[i] == x)


def test_ngram_scores_match_counts(docs):
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 1
    d = docs.select("doc_id", held.alias("held_out"), "text")
    got = by_id(ngram.score(d, ngram.train(d.where(~held), order=3)))
    texts = {r.doc_id: (split(r.text) + ["\0"], r.held_out) for r in d.collect()}
    c, b, t3 = Counter(), Counter(), Counter()
    for w, h in texts.values():
        if not h:
            c.update(w)
            s = ["\0", *w]
            b.update(zip(s, s[1:]))
            t3.update(zip(s, s[1:], s[2:]))
    n, v = sum(c.values()), len(c)
    kept2, kept3 = Counter(), Counter()
    for (x, _), k in b.items():
        kept2[x] += k - 0.75
    for (x, y, _), k in t3.items():
        kept3[x, y] += k - 0.75
    p1 = lambda w: (c[w] + 0.5) / (n + 0.5 * (v + 1))
    p2 = lambda x, w: (b.get((x, w), 0.75) - 0.75) / max(1, c[x]) + (max(1e-9, 1 - kept2[x] / c[x]) if x in kept2 else 1) * p1(w)

    def p3(x, y, w):
        return (t3.get((x, y, w), 0.75) - 0.75) / b[x, y] + max(1e-9, 1 - kept3[x, y] / b[x, y]) * p2(y, w) if (x, y) in kept3 else p2(y, w)

    for r in got:
        w, h = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (h, len(w), sum(c[x] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10(p1(x)) for x in w))
        s = ["\0", *w]
        want = math.log10(p2(s[0], s[1])) + sum(math.log10(p3(*s[i - 2 : i + 1])) for i in range(2, len(s)))
        assert r.score == pytest.approx(want, rel=0.02, abs=0.02)


@pytest.mark.parametrize("rows", [1, 2, 5000])
def test_ngram_blocks_come_back(rows):
    rng = np.random.default_rng(rows)
    context = np.sort(rng.integers(0, 2**64, rows, np.uint64, endpoint=False))
    context[rows // 2 :] = context[-1]
    word = rng.choice(rng.integers(0, 2**ngram.WORD_BITS, 300, np.uint64), rows)
    n = rng.integers(1, 2**40, rows)
    for a, b in zip((context, word, n), ngram._unblock(ngram._block(context, word, n))):
        assert a.tolist() == b.tolist()


@pytest.mark.parametrize("bits", [40, 60])
def test_ngram_sums_match_counter(bits, monkeypatch):
    monkeypatch.setattr(ngram, "WORD_BITS", bits)  # of 60 bits, ranks do not fit beside the words
    rng = np.random.default_rng(bits)
    context, word = rng.choice(rng.integers(0, 2**64, 90, np.uint64, endpoint=False), 3000), rng.integers(0, 12, 3000).astype(np.uint64)
    want = Counter(zip(context.tolist(), word.tolist()))
    once = ngram._summed(context, word)
    twice = ngram._summed(*(np.concatenate([x, x]) for x in once))
    for got, times in ((once, 1), (twice, 2)):
        assert list(zip(*(x.tolist() for x in got))) == [(c, w, times * n) for (c, w), n in sorted(want.items())]
    assert [len(x) for x in ngram._summed(context[:0], word[:0])] == [0, 0, 0]


def test_ngram_words_keep_large_counts(tmp_path):
    n = np.array([1, 254, 255, 256, 10**12])
    key = np.array([3, 9, 10, 2**40, 2**62], np.uint64)
    (tmp_path / "f").write_bytes(ngram.Words.data(key, n))
    assert ngram.Words(str(tmp_path / "f")).counts(np.arange(5)).tolist() == n.tolist()


def test_ngram_files_of_common_contexts(docs, monkeypatch):
    """Scores don't depend on how a level is cut into files, nor on a context that lies in several."""
    d = docs.select("doc_id", F.lit(False).alias("held_out"), "text").unionByName(docs.sparkSession.createDataFrame([(1000 + i, False, f"the same the w{i % 37} the v{i} end") for i in range(300)], "doc_id long, held_out boolean, text string"))
    whole = by_id(ngram.score(d, ngram.train(d)))
    want = {r.doc_id: r.score for r in whole}
    add = ngram._add_level
    assert len(ngram.train(d).levels[0].names) == 1
    context = lambda *w: int([*ngram.contexts(*ngram.tokens(pa.array([" ".join(w) + " x"])), len(w) + 1)][-1][0][len(w)])
    hot = {2: [(context("the"), 5 * ngram.FILE_ROWS, 0)], 3: [(context("same", "the"), 3 * ngram.FILE_ROWS, 0)]}
    monkeypatch.setattr(ngram, "_add_level", lambda texts, folder, k, n, _: add(texts, folder, k, 3 * ngram.FILE_ROWS, hot[k]))
    trie = ngram.train(d)
    assert all(len(level.names) > 3 for level in trie.levels)
    got = {r.doc_id: r.score for r in ngram.score(d, trie).collect()}
    assert got == {k: pytest.approx(v, rel=0.01) for k, v in want.items()}


class Kept:
    """A frame that keeps what it would run on executors."""

    def __init__(self, spark):
        self.sparkSession = spark

    def select(self, *_):
        return self

    def mapInArrow(self, run, _):
        self.run = run
        return self

    def repartition(self, *_):
        raise InterruptedError


def test_ngram_scoring_keeps_memory(docs):
    """What hashing needs goes text by text, and files go once visited."""
    trie, frame = ngram.train(docs), Kept(docs.sparkSession)
    ngram.score(frame, trie)
    text = docs.filter("text is not null").first().text + " " + " ".join(f"word{i * i % 7919}" for i in range(30_000))
    batches = [pa.RecordBatch.from_pydict({"doc_id": [i], "held_out": [True], "text": [text]}) for i in range(40)]
    held = sum(b.nbytes for b in batches)
    assert held > ngram.SCORED
    tracemalloc.start()
    try:
        rows = [r for b in frame.run(iter(batches)) for r in b.to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert [r["doc_id"] for r in rows] == list(range(40)) and len({r["score"] for r in rows}) == 1
    assert peak < 15 * held
    with open("/proc/self/maps") as f:
        assert "millrace-ngram" not in f.read()


def test_ngram_counting_keeps_memory(spark):
    """Columns of a task's n-grams go as soon as they have served."""
    frame = Kept(spark)
    with pytest.raises(InterruptedError):
        ngram._add_level(frame, "file:///none", 3, 50 * ngram.FILE_ROWS, [])
    rng = np.random.default_rng(3)
    n, each = 20, 60_000
    batches = [pa.RecordBatch.from_pydict({"text": [" ".join(map(str, rng.integers(0, 10**6, each)))]}) for _ in range(n)]
    tracemalloc.start()
    try:
        blocks = [raw for b in frame.run(iter(batches)) for raw in b.column("block").to_pylist()]
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert sum(ngram._unblock(raw)[2].sum() for raw in blocks) == n * each  # one for each token but the first
    assert peak < 5.5 * 16 * n * each


def test_ngram_of_odd_tables(edges, empty):
    d = edges.select("doc_id", F.lit(False).alias("held_out"), "text")
    got = ngram.score(d, ngram.train(d)).collect()
    assert sorted(r.n_tokens for r in got)[:4] == [1, 1, 1, 1]
    none = ngram.score(d, ngram.train(empty)).collect()
    assert {r.score for r in none} == {0.0} and {r.train_tokens for r in none} == {0}
    assert ngram.score(d.limit(0), ngram.train(d)).count() == 0


def test_ngram_query_keeps_pairs_seen_once(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(["a b c d", "a b c e", "f g h", "b c d once", "f g h", "g h i a", "a b c d", "e f", "d once more"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 5 == 1}
    assert 0 < len(held) < len(rows)
    n = [Counter() for _ in range(3)]  # by order
    for i, t in rows:
        s = ["\0", *split(t), "\0"]
        if i not in held:
            n[0].update(s[1:])
            n[1].update(zip(s, s[1:]))
            n[2].update(zip(s, s[1:], s[2:]))
    after = [Counter(k[:-1] for k in c) for c in n[1:]]  # distinct words after each context
    p1 = lambda w: (n[0][w] + 0.5) / (sum(n[0].values()) + 0.5 * (len(n[0]) + 1))

    def p(*g):
        if len(g) == 1:
            return p1(g[0])
        c, of = g[:-1], n[0][g[0]] if len(g) == 2 else n[1][g[:-1]]
        kinds = after[len(g) - 2][c]
        return (max(n[len(g) - 1][g] - 0.75, 0) + 0.75 * kinds * p(*g[1:])) / of if kinds else p(*g[1:])

    got = {r.doc_id: r.score for r in ngram.query(spark, str(tmp_path)).collect()}
    for i, t in rows:
        s = ["\0", *split(t), "\0"]
        assert got[i] == pytest.approx(sum(math.log10(p(*s[max(0, j - 2) : j + 1])) for j in range(1, len(s))), abs=1e-6)


# -- 4 records -----------------------------------------------------------------------


def tokenizer_path():
    return pytest.importorskip("public_tokenizers").path("byte_bpe_50k.json")


def test_records_round_trip(spark, docs, edges, empty):
    from millrace.llm.common import shared_dir
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    for df in (docs, edges):
        folder = shared_dir(spark, "t")
        m = records.write_records(df, folder, tokenizer_path())
        got = sorted((r.bucket, r.at, r.doc_id, r.n_tokens, r.ids_crc32) for r in records.read_records(m, folder).collect())
        rows = sorted(((r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or "", r.doc_id) for r in df.collect()))
        want = [[*tok.encode(t, add_special_tokens=False).ids, 0] for *_, t, _ in rows]
        assert [(g[2], g[3], g[4]) for g in got] == [(r[-1], len(w), zlib.crc32(np.array(w, "<u4").tobytes())) for r, w in zip(rows, want)]
    folder = shared_dir(spark, "t")
    assert records.read_records(records.write_records(empty, folder, tokenizer_path()), folder).count() == 0


def test_encoder_cuts_where_the_library_does():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(tokenizer_path()), records.Encoder(tokenizer_path())
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\t", "a", "b", "1", "!", "é", "\x1c", "\x85", "​", "'s", "<|endoftext|>", "漢", "　", "\r\n", "_"]
    for _ in range(2000):
        t = "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))
        assert np.frombuffer(enc([t])[0], "<u2").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_broken_records_are_seen():
    r = records.framed(b"payload")
    assert records.read_record(r, 0) == (b"payload", len(r))
    for i in (0, 9, 14, len(r) - 1):
        with pytest.raises(ValueError, match="checksum"):
            records.read_record(r[:i] + bytes([r[i] ^ 1]) + r[i + 1 :], 0)


def test_parts_are_encoded_together():
    """Parts behind a space take one call for many of them, and their ids are those of each alone."""
    import public_tokenizers

    enc = records.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    rng, texts = random.Random(6), []
    some = ["a\n", "b\n\n", "Ünï", "漢字", "\U0001f600", "<|endoftext|>", "x<|endoftext|>y", "Ġ", "Ġx", "don't", "12,5", "--", "q" * 400]
    for _ in range(600):
        texts.append(" ".join([rng.choice("abc")] + [rng.choice([*some, *[str(rng.random())] * 20]) for _ in range(rng.randrange(9))]))
    texts += ["", None, " x", "x ", "a  b", "a \nb", "a\u00a0b c"]
    calls, plain = [], enc.tokenizer

    class Counted:
        def encode_batch_fast(self, parts, **how):
            calls.extend(parts)
            return plain.encode_batch_fast(parts, **how)

    enc.tokenizer = Counted()
    got = enc([t or "" for t in texts])
    want = [np.array(e.ids, "<u2").tobytes() for e in plain.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert got == want and enc([t or "" for t in texts]) == want
    assert len(enc.behind) > 1000 and len(calls) < 100


# -- 5 mixing ------------------------------------------------------------------------


def test_exponent_meets_its_bounds():
    sizes = {"a": 1000, "b": 100, "c": 10}
    a = mixing.solve_exponent(sizes, 1110, 0.9, 1e9)
    assert mixing.entropy(mixing.weights(sizes, a)) == pytest.approx(0.9 * math.log(3))
    a = mixing.solve_exponent(sizes, 1110, 0.99, 2)
    w = mixing.weights(sizes, a)
    assert max(w[k] * 1110 / sizes[k] for k in sizes) == pytest.approx(2, rel=1e-6)
    assert mixing.solve_exponent(sizes, 1110, 0.1, 5) == 1 and mixing.solve_exponent({}, 0) == 1


def test_mixture_follows_its_budget(docs):
    size = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    top = {r.source: r.n for r in docs.groupBy("source").agg(F.max(F.length("text")).alias("n")).collect()}
    total = sum(size.values())
    got = mixing.mix(docs, target_entropy=0.999, block_rows=4)
    w = mixing.weights(size, mixing.solve_exponent(size, total, 0.999))
    for r in got.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect():
        assert w[r.source] * total <= r.n + 1e-6 and r.n <= w[r.source] * total + top[r.source]
    times = Counter((r.source, r.doc_id) for r in got.collect())
    for s in size:
        t = [times[s, r.doc_id] for r in docs.where(F.col("source") == s).collect()]
        assert max(t) - min(t) <= 1  # whole epochs, then part of one
    assert sorted(r.doc_id for r in got.collect()) == sorted(r.doc_id for r in mixing.mix(docs, target_entropy=0.999, block_rows=4).collect())


def test_mixture_of_odd_tables(edges, empty):
    got = mixing.mix(edges)
    assert got.columns[:-3] == edges.columns and {r.doc_id for r in got.collect()} <= {r.doc_id for r in edges.collect()}
    assert mixing.mix(empty).count() == 0
    assert mixing.mix(edges.where("text is null or text = ''")).count() == 3


def test_mixture_is_the_plain_permutation(spark, docs):
    clash = docs.withColumn("size", F.lit(1)).withColumn("budget", F.lit(2)).withColumn("blocks", F.lit(3)).withColumn("whole", F.lit(4)).withColumn("mix_block", F.lit(5))
    got = mixing.mix(clash, target_entropy=0.999, block_rows=4)
    assert got.columns == [*[c for c in clash.columns if c != "mix_block"], "mix_epoch", "mix_block", "mix_order"]
    size = {r.source: r.n for r in docs.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    rows = {r.source: r["count"] for r in docs.groupBy("source").count().collect()}
    total = sum(size.values())
    w = mixing.weights(size, mixing.solve_exponent(size, total, 0.999))
    key = F.xxhash64("doc_id", F.length("text"))
    block = F.pmod(key, F.create_map(*[x for s, n in rows.items() for x in (F.lit(s), F.lit(-(-n // 4)))])[F.col("source")])
    orders = [(mixing._order(F.lit(e).cast("long"), F.col("source"), block).alias(f"b{e}"), mixing._order(F.lit(e).cast("long"), key).alias(f"h{e}")) for e in range(6)]
    plain = docs.select("doc_id", "source", F.length("text").alias("n"), key.alias("h"), block.alias("b"), *[c for x in orders for c in x]).collect()
    want = Counter()
    for s in rows:
        mine = [r for r in plain if r.source == s]
        left, epoch = w[s] * total, 0
        while left > 0:
            places = sorted({(r[f"b{epoch}"], r.b) for r in mine})
            for at, (_, b) in enumerate(places):
                held = sorted((r for r in mine if r.b == b), key=lambda r: (r[f"h{epoch}"], r.h))
                if sum(r.n for r in mine) > left and sum(r.n for r in held) > left:
                    room = left
                    for r in held:
                        if room > 0:
                            want[r.doc_id, epoch, at] += 1
                        room -= r.n
                    left = 0
                    break
                for r in held:
                    want[r.doc_id, epoch, at] += 1
                left -= sum(r.n for r in held)
                if left <= 0:
                    break
            epoch += 1
    assert Counter((r.doc_id, r.mix_epoch, r.mix_block) for r in got.collect()) == want


def test_mixture_counts_tokens(spark, tmp_path):
    rows = [(i, "a b " * 50, "short") for i in range(40)] + [(100 + i, "unwordlylongword " * 100, "long") for i in range(10)]
    rows += [(200, None, "short"), (201, " \t ", "long")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    d.write.parquet(f"{tmp_path}/documents.parquet")
    size = {"short": 4000, "long": 1000}
    w = mixing.weights(size, mixing.solve_exponent(size, 5000))
    for got in (mixing.query(spark, str(tmp_path)).collect(), mixing.stage(spark, d, str(tmp_path)).collect()):
        n = Counter(r.source for r in got if r.doc_id < 200)
        for s in size:  # a document has 100 tokens
            assert w[s] * 5000 <= n[s] * 100 + 1e-6 and n[s] * 100 <= w[s] * 5000 + 100


# -- 6 toxicity ----------------------------------------------------------------------


def test_gradients():
    rng = np.random.default_rng(0)
    p = {k: v.astype(float) for k, v in toxicity.initial(3, rng).items()}
    x, y = rng.standard_normal((5, 4, toxicity.WORD_DIM + toxicity.CHAR_DIM)), np.array([0.0, 1, 1, 0])
    mask = np.arange(5)[:, None] < np.array([5, 3, 1, 4])
    _, d, dx = toxicity.gradients(p, x, mask, y)
    for k in d:
        i = tuple(rng.integers(0, s) for s in p[k].shape)
        q = {**p, k: p[k].copy()}
        q[k][i] += 1e-5
        up = toxicity.gradients(q, x, mask, y)[0]
        q[k][i] -= 2e-5
        assert d[k][i] == pytest.approx((up - toxicity.gradients(q, x, mask, y)[0]) / 2e-5, abs=1e-6)


def test_toxic_texts_are_learned():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    texts, y = [], []
    for i in range(300):
        w = [word() for _ in range(rng.choice([3, 60, 150]))]
        y.append(int(i % 4 == 0))
        if y[-1]:
            w.insert(rng.randrange(len(w)), rng.choice(["zonk", "zonkers", "zonked"]))
        texts.append(" ".join(w))
    y = np.array(y)
    m = toxicity.train(pa.array(texts[:200]), y[:200], 0.25)
    s = m.scores(pa.array(texts[200:]))
    assert ((s >= 0.5) == (y[200:] == 1)).mean() >= 0.9
    assert np.allclose(m.scores(pa.array(texts[200:203])), s[:3], atol=1e-4)


def test_toxicity_of_odd_tables(spark, edges, empty):
    labels = spark.createDataFrame([(6, 0, 1), (7, 0, 0), (8, 0, 1), (None, 0, 1), (9, 1, None)], "doc_id long, quality int, toxic int")
    got = toxicity.score(edges, toxicity.fit(edges, labels)).collect()
    assert len(got) == edges.count() and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(empty, toxicity.fit(empty, labels.limit(0))).count() == 0
    assert {r.score for r in toxicity.score(edges, toxicity.fit(edges, labels.limit(0))).collect()} == {0.0}


def test_toxicity_learns_from_all_texts(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARE_TEXTS", 1500, raising=False)
    rng = random.Random(9)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rare = [f"rare{word(9)}" for _ in range(300)]
    rows = []
    for i in range(8000):
        w = [word(4) for _ in range(3)]
        if i % 2:
            w.append(rng.choice(["zonk", "zonkers", "zonked"]))
        rows.append((i, w))
    trained = [(i, w) for i, w in rows if zlib.crc32(str(i).encode()) % 5]
    for k, r in enumerate(rare):  # each in MIN_TEXTS texts
        for j in range(toxicity.MIN_TEXTS):
            trained[(k + j * len(rare)) % len(trained)][1].append(r)
    d = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 0, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    m = toxicity.fit(d, labels)
    assert set(toxicity.letter_runs(pa.array([" ".join(rare)]))[0]) <= set(m.vocab)
    held = [r for r in toxicity.score(d, m).collect() if not zlib.crc32(str(r.doc_id).encode()) % 5]
    assert len(held) > 1000 and np.mean([(r.score >= 0.5) == (r.doc_id % 2 == 1) for r in held]) > 0.97


def test_toxicity_training_shuffles_labelled_texts_once(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(toxicity, "SHARE_TEXTS", 100)
    whole, stored = [], toxicity.stored

    def seen(df, path):
        out = stored(df, path)
        whole.append(out.select("share", "text", "y", F.input_file_name().alias("file")).collect())
        return out

    rng = random.Random(5)
    d = [(i, rng.randbytes(1500).hex()) for i in range(3000)] + [(9, rng.randbytes(1500).hex()), (None, "no id")]
    texts = sorted(t for i, t in d if i is not None and i % 8 == 0 and zlib.crc32(str(i).encode()) % 5)
    d = stored(spark.createDataFrame(d + d[:99], "doc_id long, text string"), f"file://{tmp_path}/documents")
    monkeypatch.setattr(toxicity, "stored", seen)
    labels = spark.createDataFrame([(i, 0, 0) for i in range(0, 3000, 8)], "doc_id long, quality int, toxic int")
    group, sc = "shuffled by toxicity", spark.sparkContext
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with many labels
    sc.setJobGroup(group, "")
    try:
        assert toxicity.fit(d, labels).p is None  # one class: the texts are dealt, and training ends
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    tracker, shuffled = sc.statusTracker(), 0
    for k in {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}:
        shuffled += sc._jsc.sc().statusStore().lastStageAttempt(k).shuffleWriteBytes()
    kept = 3000 * len(texts)
    assert kept / 4 < shuffled < 1.2 * kept
    (rows,) = whole
    assert sorted(r.text for r in rows) == texts and {r.y for r in rows} == {0}
    assert len({r.share for r in rows}) > 2 and len({(r.share, r.file) for r in rows}) == len({r.share for r in rows})


def test_toxicity_sieve_loses_no_labelled_row(spark, monkeypatch):
    ids = [-(1 << 63), -5, 0, 7, (1 << 63) - 1, *range(1000, 9000, 4)]
    rows = spark.createDataFrame([(i,) for i in [*ids, 7, None, *range(1001, 40001, 4)]], "doc_id long")
    known = spark.createDataFrame([(i, 1) for i in ids], "doc_id long, y int")
    got = [r.doc_id for r in toxicity._likely(rows, known, len(ids)).collect()]
    assert got.count(7) == 2 and set(ids) <= set(got) and len(ids) < len(got) < 1.6 * len(ids)
    monkeypatch.setattr(toxicity, "ID_BITS", 64)
    monkeypatch.setattr(toxicity, "MAX_PAGES", 1)  # a full map lets more pass
    more = [r.doc_id for r in toxicity._likely(rows, known, len(ids)).collect()]
    assert set(ids) <= set(more) and len(more) < rows.count()
    assert not toxicity._likely(rows, known.limit(0), 0).count()


def test_toxicity_cuts_a_share_that_is_too_large(monkeypatch):
    monkeypatch.setattr(toxicity, "SHARE_TEXTS", 10)
    share, texts = [0] * 5 + [1] * 100 + [2] * 3, [f"word{'abcdefghij'[i % 10]} same" for i in range(108)]
    whole = pa.RecordBatch.from_arrays([pa.array(share, pa.int32()), pa.array(texts), pa.array([0] * 108, pa.int32())], names=["share", "text", "y"])
    got = list(toxicity._shares(whole.slice(i, 8) for i in range(0, 108, 8)))
    assert {k: sum(len(s.y) for n, s in got if n == k) for k in (0, 1, 2)} == {0: 5, 1: 100, 2: 3}
    assert max(len(s.y) for _, s in got) <= 28


def test_toxicity_steps_and_calibration_add_up():
    rng = np.random.default_rng(3)
    at, rows = rng.integers(0, 40, 500), rng.standard_normal((500, 3)).astype(np.float32)
    want = np.zeros((50, 3))
    np.add.at(want, at, rows)
    assert np.allclose(toxicity._added(50, at, rows), want, atol=1e-4)
    x, y = rng.standard_normal(400), rng.integers(0, 2, 400)
    parts = lambda *w: sum(np.array(toxicity._calibration_sums(x[i::3], y[i::3], np.ones(len(x[i::3])), *w)) for i in range(3))
    assert np.allclose(toxicity._calibrate(parts, 400), toxicity._calibrate(lambda *w: toxicity._calibration_sums(x, y, np.ones(400), *w), 400))


def test_toxicity_holds_each_word_once():
    """What depends on a word alone is computed once for each distinct word, whatever its places."""
    rng = random.Random(4)
    some = ["zonk", "Ünï", "a", "wörter", "漢字", "q" * 300]
    texts = [" ".join(rng.choice(some) for _ in range(rng.choice([0, 1, 63, 64, 200]))) + "\t12 !" for _ in range(40)] + [None, ""]
    parts = [toxicity.Runs.of(pa.array(texts[i : i + 5])) for i in range(0, len(texts), 5)]
    one, joined = toxicity.Runs.of(pa.array(texts)), toxicity.Runs.joined(parts)
    assert len(one.words) == len(some) < len(one.at)
    for k in ("words", "at", "first", "grams", "begin"):
        assert (getattr(one, k) == getattr(joined, k)).all()
    m = toxicity.Model(toxicity.initial(3, np.random.default_rng(1)), one.words[:3], 1, 0)
    assert m.inputs(one).shape == (len(some), toxicity.WORD_DIM + toxicity.CHAR_DIM)
    # the scores follow the loss that training lowers
    text, begin, size = toxicity.windows(one.first)
    rows = np.flatnonzero(size > 0)
    step = np.arange(toxicity.WINDOW)[:, None]
    x = m.inputs(one)[one.at[np.minimum(begin[rows] + step, len(one.at) - 1)]]
    logit, y = m.logits(one, begin, size)[rows], (rows % 2).astype(np.float32)
    loss = toxicity.gradients(m.p, x, step < size[rows], y)[0]
    assert loss == pytest.approx(float(np.mean(np.logaddexp(0, logit) - y * logit)), rel=1e-4)
    assert np.allclose(m.scores(pa.array(texts)), np.concatenate([m.scores(pa.array(texts[i : i + 1])) for i in range(len(texts))]), atol=1e-5)


def test_windows_cover_everything():
    first = np.array([0, 0, 1, 64, 65, 200, 513])
    text, begin, size = toxicity.windows(first)
    for d, (a, b) in enumerate(zip(first[:-1], first[1:])):
        got = {w for t, s, n in zip(text, begin, size) if t == d for w in range(s, s + n)}
        assert got == set(range(a, b)) and (text == d).any()
    assert size.max() <= toxicity.WINDOW


# -- 7 language ----------------------------------------------------------------------


def test_language_held_out(docs):
    m = language.fit(language.training_rows(docs))
    got = language.classify(docs.select("doc_id", "lang", "text"), m).where(F.length("text") > 40).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.95


def test_language_of_odd_tables(edges, empty, docs):
    m = language.fit(docs)
    got = language.classify(edges, m).collect()
    assert len(got) == edges.count()
    for r in got:
        if not re.search(r"[^\W\d_]", r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in ("en", "de") and 0 <= r.score <= 1
    assert language.classify(empty, m).count() == 0
    assert {r.lang_pred for r in language.classify(edges, language.fit(empty)).collect()} == {"und"}


FOREIGN = [
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью и должны поступать в отношении друг друга в духе братства.",
]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="needs the driver's tables")
def test_foreign_and_junk_texts_are_rejected(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    m = language.fit(language.training_rows(d))
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyz"
    dealt = lambda of: ["".join(rng.choice(of) for _ in range(600)) for _ in range(5)]
    junk = ["a" * 600, *dealt(letters + "   "), *dealt(letters + letters.upper() + "0123456789+/")]
    assert all(m.predict(pa.array(FOREIGN + junk))[2])
    clean = language.classify(d.where((F.crc32(F.col("doc_id").cast("string")) % 3 == 1) & (F.length("text") > 40)), m).collect()
    assert len(clean) > 200 and np.mean([r.rejected for r in clean]) < 0.08


def test_language_samples_are_distinct_texts(spark, monkeypatch):
    rng = random.Random(2)
    texts = sorted({"".join(rng.choice("abcdefgh ") for _ in range(60)) for _ in range(400)})
    at = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", (F.pmod(F.xxhash64("t"), F.lit(1_000_000)) / 1_000_000).alias("h")).collect()}
    low, high = min(texts, key=at.get), [t for t in texts if at[t] > 0.3][:2]
    rows = [(t, "en") for t in texts] + [(low, "en")] * 8000 + [(t, "xx") for t in high for _ in range(5000)]
    sizes, plain = [], language._kmeans
    monkeypatch.setattr(language, "_kmeans", lambda x, k: sizes.append(len(x)) or plain(x, k))
    m = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert m.languages == ["en", "xx"]
    assert 200 < sizes[0] <= 400 and 1 <= sizes[1] <= 2


def test_language_learns_from_all_texts(spark, monkeypatch):
    monkeypatch.setattr(language, "CENTROIDS", 1)
    rng = random.Random(6)
    of = {k: sorted({"".join(rng.choice(letters) for _ in range(60)) for _ in range(900)}) for k, letters in (("en", "abcdefgh "), ("de", "efghijkl "))}
    rows = [(t, k) for k, texts in of.items() for t in texts] + [(of["en"][0], "en")] * 50
    m = language.fit(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    df = (language.count_vectors(pa.array([t for t, _ in rows])) > 0).sum(axis=0)
    assert np.allclose(m.idf, np.log((1 + len(rows)) / (1 + df)) + 1, atol=1e-5)
    vectors = [language.weighted(language.count_vectors(pa.array(of[k])), m.idf).astype(float) for k in m.languages]
    mean = lambda x: x.sum(axis=0) / np.linalg.norm(x.sum(axis=0))
    assert m.languages == ["de", "en"] and np.allclose(m.centroids, [mean(x) for x in vectors], atol=1e-5)
    # Each text against the mean of all the others of its language; longer texts, of which there are none, take both languages' quantile.
    cos = [sorted(v @ mean(np.delete(x, j, axis=0)) for j, v in enumerate(x)) for x in vectors]
    low = lambda c: sorted(c)[int(language.REJECT_QUANTILE * (len(c) - 1))]
    for i, c in enumerate(cos):
        assert m.floor[i, 3] == pytest.approx(min(low(c), low(cos[0] + cos[1])), abs=2 / language.GRID)


def test_language_centroids_are_means_of_their_texts(spark):
    rng = random.Random(8)
    texts = sorted({"".join(rng.choice(letters) for _ in range(60)) for letters in ("abcd ", "ghij ", "mnop ", "stuv ") for _ in range(300)})
    m = language.fit(spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3))
    x = language.weighted(language.count_vectors(pa.array(texts)), m.idf)
    of = (x @ m.centroids.T).argmax(axis=1)
    for i, c in enumerate(m.centroids):
        mean = x[of == i].sum(axis=0)
        assert mean / np.linalg.norm(mean) @ c > 0.999


# -- 8 chat --------------------------------------------------------------------------

TURNS = [
    (1, 0, "user", "a <s>\\l[INST]"), (1, 1, "user", None), (1, 2, "assistant", "</s>[/INST]\\"), (1, 70, "assistant", "<c>x\n"), (2, None, "assistant", ""), (2, None, None, "dup"), (2, None, None, "dup"),
    (None, 5, "sys\ntem", "no id"), (3, 1, "assistant", "é\U0001f600"),
]


@pytest.mark.parametrize("span", [1, 64, 1000])
def test_chats_read_back(spark, span):
    df = spark.createDataFrame([(*t, 9) for t in TURNS], "conv_id long, turn long, role string, text string, segments int")
    rows = sorted(((c is not None, c or 0), (t is not None, t or 0), r or "", x or "") for c, t, r, x in TURNS)
    want = {}
    for c, _, r, x in rows:
        want.setdefault(c[1] if c[0] else None, []).append((r, x))
    out = chat.format_chats(df, span=span)
    for r in out.select("*", chat.read_turns(F.col("formatted")).alias("turns")).collect():
        assert [(t.role, t.text) for t in r.turns] == want[r.conv_id]
        assert "".join(s.text for s in r.segments) == r.formatted
    for r in chat.digest(out).collect():
        loss = "".join(x for role, x in want[r.conv_id] if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(want[r.conv_id]), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.format_chats(df.limit(0)).count() == 0


def test_chat_merges_adjacent_roles(spark):
    df = spark.createDataFrame([(1, i, r, str(i)) for i, r in enumerate(["user", "user", "assistant", "assistant", "user"])], "conv_id long, turn long, role string, text string")
    for span in (1, 2, 64):
        assert chat.format_chats(df, span=span).first().formatted == "<s>user\n0<c>1</s><s>assistant\n2<c>3</s><s>user\n4</s>"


# -- 9 search ------------------------------------------------------------------------


def brute_search(rows, queries, k):
    out = []
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    for q, v in {i: v for i, v in sorted(ok, key=lambda r: (r[0], r[1])) if i in queries}.items():
        s = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q and len(w) == len(v))
        out += [(q, r, i, -x) for r, (x, i) in enumerate(s[:k], 1)]
    return sorted(out)


def test_search_matches_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, [rng.choice([rng.gauss(0, 0.2), 0.25]) for _ in range(6)]) for i in range(300)]
    rows += [(400 + i, [0.25] * 6) for i in range(40)] + [(500, None), (501, [None] * 6), (502, [math.nan] * 6), (503, [math.inf] * 6), (None, [0.1] * 6), (504, [1.0, 2.0]), (50, [0.1] * 6), (505, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    as32 = [(i, v and [None if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    ids = {r for r, _ in rows if r is not None and r % 50 == 0}
    for shard in (16, 4096):
        got = sorted(map(tuple, search.search(df, df.where("vec_id % 50 = 0"), shard_rows=shard).collect()))
        assert got == brute_search(as32, ids, 5)
    assert search.search(df.limit(0), df.limit(0)).count() == 0
    few = df.where("vec_id in (0, 1, 2)")
    assert search.search(few, few.where("vec_id = 0")).count() == 2


def test_search_prunes_blocks_and_keeps_huge_scores(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(c, 1, (500, 4)) for c in (0, 50, -50)]).round()
    counted = []
    search.BlockIndex(np.arange(len(x)), x).top(0, x[600], 5, counted)
    assert sum(counted) < len(x) / 2
    df = spark.createDataFrame([(0, [1e14]), (1, [3.0]), (2, [-1e30])], "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in search.search(df, df.where("vec_id = 0")).collect()}
    assert got == {1: 25600000000000000 * 768, 2: -(2**63)} or got[2] == -(2**63)


# -- 10 Jaccard ----------------------------------------------------------------------


def brute_groups(rows, k, num, den):
    sets = {}
    for i, t in rows:
        w = split(t)
        sets.setdefault(i, []).append(frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else []))
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                r, s = sorted((root(a), root(b)))
                up[s] = r
    return {i: root(i) for i in ids}


@pytest.mark.parametrize(("k", "num"), [(3, 90), (5, 80), (1, 50)])
def test_groups_match_brute_force(docs, k, num):
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()], k, num, 100)
    got = {r.doc_id: r.component_id for r in jaccard.join(docs, k, num).collect()}
    assert got == want


def test_chains_and_families_lose_no_link(spark):
    rng = random.Random(6)
    base = [f"w{i}" for i in range(60)]
    rows, t = [], list(base)
    for i in range(40):  # a chain: each differs a little from the one before
        rows.append((i, " ".join(t)))
        t = list(t)
        t[rng.randrange(60)] = f"x{i}"
    for i in range(40, 90):  # a family around one text, far from one another
        t = list(base[::-1])
        for _ in range(rng.randint(0, 4)):
            t[rng.randrange(60)] = f"y{i}"
        rows.append((i, " ".join(t)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k, num in ((1, 90), (2, 80), (3, 90)):
        got = {r.doc_id: r.component_id for r in jaccard.join(df, k, num).collect()}
        assert got == brute_groups(rows, k, num, 100)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for num in (50, 80, 90):
        s = jaccard.Scheme(num, 100)
        for n in (1, 3, 8, 20, 60, 300):
            for _ in range(20):
                a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
                b = a.copy()
                drop = rng.integers(0, s.differences(2 * n) + 1)
                b = np.unique(np.concatenate([b[drop // 2 :], rng.integers(0, 1 << 63, drop - drop // 2).astype(np.uint64)]))
                if s.linked(a, b) and not np.array_equal(a, b):
                    row, sig, group = s.signatures([a, b])
                    assert set(sig[row == 0]) & set(sig[row == 1]), (num, n, drop)
                    # Whatever the order of frequency, what both may leave out never holds all that they share.
                    heat = {x: rng.random() for x in sig}
                    left = [set(), set()]
                    for i in (0, 1):
                        for g in set(group[row == i]):
                            touched = set()
                            for x in sorted(sig[(row == i) & (group == g)], key=heat.get, reverse=True):
                                touched.add(int(x) & 0x7FFF)
                                if len(touched) > (g & 0x7FFFF):
                                    left[i].add(x)
                    assert left[0] & left[1], (num, n, drop)
                    assert jaccard.sketch_distance(s.sketch(a), s.sketch(b)) <= len(np.setxor1d(a, b)) <= s.limit(len(a), len(b))


def test_groups_of_odd_tables(edges, empty):
    got = jaccard.join(edges, 3, 90).collect()
    assert len(got) == edges.count()
    comp = {}
    for r in got:
        comp.setdefault(r.doc_id, set()).add(r.component_id)
    assert comp[8] == comp[9] == {8} and comp[1] == {1} and comp[None] == {None} and comp[3] == {3}
    assert all(r.n_shingles == 0 for r in got if r.doc_id in (1, 2, 3))
    assert jaccard.join(empty).count() == 0
    kept = jaccard.stage(None, edges, "").collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 5, 6, 7, 8] and len(kept) == 9


def test_words_are_those_of_the_pattern():
    texts = ["A b\tC", "", None, "x" * 10, " é\x0bÉ ", "a\x1cb", "tail "]
    h, first = words(pa.array(texts))
    assert np.diff(first).tolist() == [len(split(t)) for t in texts]
    flat = [w for t in texts for w in split(t)]
    assert len(set(h.tolist())) == len(set(flat)) and all((h[i] == h[j]) == (flat[i] == flat[j]) for i in range(len(flat)) for j in range(len(flat)))
