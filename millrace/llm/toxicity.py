"""Toxicity scores from a bidirectional gated recurrent network in numpy.

A text is a sequence of letter runs. Each is a learned word vector (words of the
training texts; others share one) beside the mean of hashed byte-trigram vectors,
so inflected or unseen forms are still seen. Windows of 64 words, overlapping by 16
and covering the whole text, pass through a GRU in both directions; attention
pools the states to one logit. The largest logit of all windows is the text's,
calibrated by logistic regression to the label shares of the training rows.

Training uses every labelled text of both classes, whole. They are written once, in the shared
folder, in shares of about SHARE_TEXTS texts or SHARE_BYTES, dealt by id; one of twice that (an id with
very many texts) is trained on in parts. In a round each share is trained on
by itself from the same weights, and the means of the weights and of Adam's moments, by
number of texts, begin the next round; the words and the calibration count all texts. One share is plain
training. Scoring covers every window of every text.

Defined results: null and empty texts are one window without words and get its
score. Repeated rows are scored alike. Without labels, or with one class only, the
score is the share of class 1 (0 without any). Extra columns pass through; a column that
is named like the result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import VECTOR_ROWS, chunks, crc_fold, passing, remove, shared_dir, ship_package, span_hashes, stored, table, utf8, vector_rows, vector_totals, without, word_spans

WINDOW, STRIDE = 64, 48
HIDDEN, WORD_DIM, CHAR_DIM, ATTEND = 8, 8, 8, 8
GRAM_BINS = 4096
MIN_TEXTS, MAX_WORDS = 4, 8192
SHARE_TEXTS, SHARE_BYTES = 4500, 32 << 20
BLOCKS = 8  # of the weights, summed apart
ID_BITS, PAGE_BITS, MAX_PAGES = 16, 1 << 15, 1 << 12  # of the map of labelled ids: bits for an id, bits of a page, pages (16 MB)
EPOCHS, WARM_EPOCHS, MIN_STEPS, BATCH, RATE = 9, 3, 500, 128, 0.01
BLOCK = 512  # windows at a time
STRETCH = 40_000  # words projected at a time

_FOLD = np.full(256, 32, np.uint8)
_FOLD[128:] = np.arange(128, 256)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)


def letter_runs(arr: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word hashes, first word of each text, folded bytes, starts and ends of the words in them)."""
    raw, off = utf8(arr)
    buf = _FOLD[raw]
    starts, ends, first = word_spans(buf, off)
    return span_hashes(buf, starts, ends), first, buf, starts, ends


def trigrams(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(trigram bins of all letters of some words, first trigram of each word); a word has spaces at both ends."""
    sizes = ends - starts
    at = np.cumsum(sizes) - sizes
    own = buf[np.repeat(starts - at, sizes) + np.arange(sizes.sum())].astype(np.uint32)
    before, after = np.roll(own, 1), np.roll(own, -1)
    before[at], after[at - 1] = 32, 32
    gram = (before << np.uint32(16)) | (own << np.uint32(8)) | after
    gram = (gram * np.uint32(2654435769)) ^ (gram >> np.uint32(7))
    return ((gram * np.uint32(0x85EBCA6B)) >> np.uint32(20)).astype(np.int16), at.astype(np.int32)


@dataclass
class Runs:
    """Letter runs of texts; all that depends on the word alone is held once for each distinct one."""

    words: np.ndarray  # sorted distinct hashes
    at: np.ndarray  # the word of each place, by its number
    first: np.ndarray  # first place of each text
    grams: np.ndarray  # trigram bins of the distinct words
    begin: np.ndarray  # first trigram of each distinct word

    @classmethod
    def of(cls, arr: pa.Array) -> Runs:
        hashes, first, buf, starts, ends = letter_runs(arr)
        words, where, at = np.unique(hashes, return_index=True, return_inverse=True)
        return cls(words, at.astype(np.int32), first, *trigrams(buf, starts[where], ends[where]))

    @classmethod
    def joined(cls, parts: list[Runs]) -> Runs:
        every = np.concatenate([np.zeros(0, np.uint64), *(r.words for r in parts)])
        words, where, number = np.unique(every, return_index=True, return_inverse=True)
        number = number.astype(np.int32)
        at, first, begin, size, places, n, grams = [], [], [], [], 0, 0, 0
        for r in parts:
            at.append(number[n : n + len(r.words)][r.at])
            first.append(r.first[:-1] + places)
            begin.append(r.begin + np.int64(grams))
            size.append(np.diff(r.begin, append=len(r.grams)))
            places, n, grams = places + len(r.at), n + len(r.words), grams + len(r.grams)
        cat = lambda x, kind: np.concatenate([np.zeros(0, kind), *x])
        lo, size = cat(begin, np.int64)[where], cat(size, np.int64)[where]
        begin = np.cumsum(size) - size
        grams = cat([r.grams for r in parts], np.int16)[np.repeat(lo - begin, size) + np.arange(size.sum())]
        return cls(words, cat(at, np.int32), np.append(cat(first, np.int64), places), grams, begin.astype(np.int32))


def windows(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, number of words) of all overlapping windows; one at least for each text."""
    n = np.diff(first)
    count = np.maximum(1, -(-(n - WINDOW) // STRIDE) + 1)
    text = np.repeat(np.arange(len(n)), count)
    k = np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    begin = first[:-1][text] + k * STRIDE
    return text, begin, np.minimum(WINDOW, first[1:][text] - begin)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def initial(vocab: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    d, h = WORD_DIM + CHAR_DIM, HIDDEN
    g = lambda *s, k=0.3: (rng.standard_normal(s) * k).astype(np.float32)
    return {
        "words": g(vocab + 1, WORD_DIM, k=0.1), "grams": g(GRAM_BINS, CHAR_DIM, k=0.3),
        "wx": g(2, d, 3 * h), "bx": np.zeros((2, 1, 3 * h), np.float32), "u": g(2, h, 3 * h),
        "wa": g(2 * h, ATTEND), "va": g(ATTEND), "wo": g(2 * h), "bo": np.zeros(1, np.float32),
    }


def _attend(p, hs, mask):
    """hs (T, 2H, B), mask (T, B) -> logits and what the gradient needs."""
    q = np.tanh(p["wa"].T @ hs)
    s = np.where(mask, p["va"] @ q, -1e9)
    s = np.exp(s - s.max(axis=0)) * mask
    a = s / np.maximum(s.sum(axis=0), 1e-9)
    pooled = np.einsum("tb,thb->hb", a, hs)
    return p["wo"] @ pooled + p["bo"][0], (q, a, pooled)


def _squash(x):
    """The logistic function in place."""
    np.maximum(x, -30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    np.reciprocal(x, out=x)


def logits_of(p: dict, x: np.ndarray, at: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Logits of windows; ``x`` are the words' inputs and ``at`` the word of each place.

    Numbers of one kind stand side by side for all windows of a block (..., B).
    """
    hd, b2 = HIDDEN, 2 * HIDDEN
    wx, bx, ut = np.concatenate(p["wx"], axis=1).T, p["bx"].reshape(-1, 1), np.ascontiguousarray(p["u"].transpose(0, 2, 1))
    if not len(at):
        x, at = np.zeros((1, x.shape[1]), x.dtype), np.zeros(1, np.int32)
    out = np.zeros(len(begin), np.float32)
    order = np.argsort(-size, kind="stable")
    step = np.arange(WINDOW)[:, None]
    for i in range(0, len(order), BLOCK):
        rows = order[i : i + BLOCK]
        steps, b = max(1, int(size[rows[0]])), len(rows)
        mask = step[:steps] < size[rows]
        full = bool(mask.all())
        g = wx @ x.take(at[np.minimum(begin[rows] + step[:steps], len(at) - 1)].ravel(), axis=0).T
        g += bx
        g = g.reshape(2, 3 * hd, steps, b)
        hs = np.empty((steps, b2, b), np.float32)
        h, hu, zr, n = (np.zeros((2, k * hd, b), np.float32) for k in (1, 3, 2, 1))
        for t in range(steps):
            back = steps - 1 - t
            np.matmul(ut, h, out=hu)
            np.add(g[0, :b2, t], hu[0, :b2], out=zr[0])
            np.add(g[1, :b2, back], hu[1, :b2], out=zr[1])
            _squash(zr)
            np.multiply(hu[:, b2:], zr[:, hd:], out=n)
            n[0] += g[0, b2:, t]
            n[1] += g[1, b2:, back]
            np.tanh(n, out=n)
            h -= n
            h *= zr[:, :hd]
            h += n
            if not full:
                h[0] *= mask[t]
                h[1] *= mask[back]
            hs[t, :hd] = h[0]
            hs[back, hd:] = h[1]
        out[rows] = _attend(p, hs, mask)[0]
    return out


def gradients(p: dict, x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> tuple[float, dict, np.ndarray]:
    """Mean log loss of windows x (T, B, D), its gradients and those of x.

    Inside, numbers of one kind stand side by side for all windows (..., B), and what doesn't wait for another step is done for all steps at once.
    """
    steps, b, width = x.shape
    hd, b2, kind = HIDDEN, 2 * HIDDEN, x.dtype
    xx = np.stack([x, x[::-1]]).reshape(2, steps * b, width)
    mm = np.stack([mask, mask[::-1]], axis=1)[:, :, None].astype(kind)
    g = p["wx"].transpose(0, 2, 1) @ xx.transpose(0, 2, 1) + p["bx"].transpose(0, 2, 1)
    g = np.ascontiguousarray(g.reshape(2, 3 * hd, steps, b).transpose(2, 0, 1, 3))
    ut = np.ascontiguousarray(p["u"].transpose(0, 2, 1))
    h = np.zeros((steps + 1, 2, hd, b), kind)
    hu, zr, n = (np.empty((steps, 2, k * hd, b), kind) for k in (3, 2, 1))
    for t in range(steps):
        np.matmul(ut, h[t], out=hu[t])
        np.add(g[t, :, :b2], hu[t, :, :b2], out=zr[t])
        _squash(zr[t])
        np.multiply(zr[t, :, hd:], hu[t, :, b2:], out=n[t])
        n[t] += g[t, :, b2:]
        np.tanh(n[t], out=n[t])
        np.subtract(h[t], n[t], out=h[t + 1])
        h[t + 1] *= zr[t, :, :hd]
        h[t + 1] += n[t]
        h[t + 1] *= mm[t]
    cat = np.concatenate([h[1:, 0], h[:0:-1, 1]], axis=1)
    logit, (q, a, pooled) = _attend(p, cat, mask)
    prob = _sigmoid(logit)
    loss = float(np.mean(np.logaddexp(0, logit) - y * logit))
    d = {}
    dl = (prob - y) / b
    d["bo"] = np.array([dl.sum()], kind)
    d["wo"] = pooled @ dl
    dp = p["wo"][:, None] * dl
    dcat = a[:, None] * dp
    da = np.einsum("thb,hb->tb", cat, dp)
    ds = a * (da - (a * da).sum(axis=0))
    d["va"] = np.einsum("tb,tab->a", ds, q)
    dq = ds[:, None] * p["va"][:, None] * (1 - q * q)
    d["wa"] = (cat @ dq.transpose(0, 2, 1)).sum(axis=0)
    dcat += p["wa"] @ dq
    dhs = np.stack([dcat[:, :hd], dcat[::-1, hd:]], axis=1)
    z, r = zr[:, :, :hd], zr[:, :, hd:]
    new = (1 - z) * (1 - n * n)
    # dh times these are the gradients of h @ u by kind: update, reset, candidate
    by = np.stack([(h[:-1] - n) * z * (1 - z), new * hu[:, :, b2:] * r * (1 - r), new * r], axis=2)
    dhu, dn = np.empty_like(by), np.empty_like(new)
    dh = np.zeros((2, hd, b), kind)
    for t in reversed(range(steps)):
        dh += dhs[t]
        dh *= mm[t]
        np.multiply(dh, new[t], out=dn[t])
        np.multiply(by[t], dh[:, None], out=dhu[t])
        dh *= z[t]
        dh += p["u"] @ dhu[t].reshape(2, 3 * hd, b)
    flat = lambda v: np.ascontiguousarray(v.reshape(steps, 2, -1, b).transpose(1, 2, 0, 3)).reshape(2, -1, steps * b)
    dhu = flat(dhu)
    d["u"] = flat(h[:-1]) @ dhu.transpose(0, 2, 1)
    dg = dhu  # the candidate's part is its own, before the reset
    dg[:, b2:] = flat(dn)
    d["bx"] = dg.sum(axis=2)[:, None]
    d["wx"] = (dg @ xx).transpose(0, 2, 1)
    dx = (dg.transpose(0, 2, 1) @ p["wx"].transpose(0, 2, 1)).reshape(2, steps, b, width)
    return loss, d, dx[0] + dx[1][::-1]


def _means(vectors: np.ndarray, grams: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Means of the vectors of the trigrams of each word."""
    return np.add.reduceat(vectors.take(grams, axis=0), at, axis=0) / np.diff(at, append=len(grams)).astype(np.float32)[:, None]


def _added(n: int, at: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sums of the rows by their places among ``n``."""
    out = np.empty((n, rows.shape[1]), np.float32)
    for i, column in enumerate(rows.T):
        out[:, i] = np.bincount(at, column, n)
    return out


class _Adam:
    def __init__(self, p):
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}
        self.t = 0

    def step(self, p, d, rate):
        self.t += 1
        for k, g in d.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.01 * (g * g - self.v[k])
            p[k] -= rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-7)


@dataclass
class Model:
    p: dict | None
    vocab: np.ndarray  # sorted word hashes
    slope: float
    shift: float
    constant: float = 0.0

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Rows of word vectors: those of other words are 0."""
        if not len(self.vocab):
            return np.zeros(len(hashes), np.int64)
        k = np.minimum(np.searchsorted(self.vocab, hashes), len(self.vocab) - 1)
        return np.where(self.vocab[k] == hashes, k + 1, 0)

    def inputs(self, runs: Runs) -> np.ndarray:
        """Inputs of the distinct words, STRETCH at a time."""
        out = np.empty((len(runs.words), WORD_DIM + CHAR_DIM), np.float32)
        out[:, :WORD_DIM] = self.p["words"][self.numbers(runs.words)]
        ends = np.append(runs.begin[1:], len(runs.grams))
        for i in range(0, len(out), STRETCH):
            at = runs.begin[i : i + STRETCH]
            out[i : i + STRETCH, WORD_DIM:] = _means(self.p["grams"], runs.grams[at[0] : ends[i + len(at) - 1]], at - at[0])
        return out

    def logits(self, runs: Runs, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        return logits_of(self.p, self.inputs(runs), runs.at, begin, size)

    def scores(self, arr: pa.Array) -> np.ndarray:
        if self.p is None or len(arr) == 0:
            return np.full(len(arr), self.constant)
        return _sigmoid(self.slope * self.tops(arr) + self.shift)

    def tops(self, arr: pa.Array) -> np.ndarray:
        """The largest logit of each text's windows."""
        runs = Runs.of(arr)
        text, begin, size = windows(runs.first)
        logit = self.logits(runs, begin, size)
        top = np.full(len(arr), -np.inf)
        np.maximum.at(top, text, logit)
        return top


def _calibrate(sums, n: int) -> tuple[float, float]:
    """Weighted logistic regression on one number, with a pull of the slope to 1, so that separable classes are parted midway.

    ``sums(slope, shift)`` are those of weighted gradients and second derivatives over all texts.
    """
    w, pull = np.array([1.0, 0.0]), np.array([n, 1e-3])
    for _ in range(50):
        gx, g1, hxx, hx1, h11 = sums(*w)
        step = np.clip(np.linalg.solve(np.array([[hxx, hx1], [hx1, h11]]) + np.diag(pull), np.array([gx, g1]) + pull * (w - [1, 0])), -1, 1)
        w = w - step
        if np.abs(step).max() < 1e-10:
            break
    return (float(w[0]), float(w[1])) if w[0] > 0 else (1.0, 0.0)


def _calibration_sums(x: np.ndarray, y: np.ndarray, weight: np.ndarray, slope: float, shift: float) -> list[float]:
    pr = _sigmoid(slope * x + shift)
    g, h = weight * (pr - y), weight * pr * (1 - pr)
    return [(g * x).sum(), g.sum(), (h * x * x).sum(), (h * x).sum(), h.sum()]


def _runs_in_chunks(texts: pa.Array) -> Runs:
    """Letter runs of many texts, read about a megabyte at a time."""
    return Runs.joined(
        [
            Runs.of(c.column("text"))
            for part in (texts.chunks if isinstance(texts, pa.ChunkedArray) else [texts])
            for c in chunks(pa.RecordBatch.from_arrays([part], names=["text"]), "text")
        ]
    )


def train(texts: pa.Array, y: np.ndarray, share: float, seed: int = 7) -> Model:
    """Fit on texts with labels 0 and 1; ``share`` is that of label 1 among all labelled rows."""
    return train_runs(_runs_in_chunks(texts), y, share, seed)


def train_runs(runs: Runs, y: np.ndarray, share: float, seed: int = 7) -> Model:
    """Fit on the letter runs of texts, as one share."""
    if len(y) == 0 or y.min() == y.max():
        return Model(None, np.zeros(0, np.uint64), 1, 0, constant=float(share))
    w, c = _text_counts(runs.words[runs.at], runs.first)
    keep = np.flatnonzero(c >= MIN_TEXTS)
    vocab = np.sort(w[keep[np.argsort(-c[keep], kind="stable")][:MAX_WORDS]])
    plan = _Plan((y == 0).sum(), (y == 1).sum())
    model, rng = Model(initial(len(vocab), np.random.default_rng(seed)), vocab, 1, 0), np.random.default_rng(seed)
    own, adam = _Share(runs, y), _Adam(model.p)
    for epochs in plan.rounds():
        own.learn(model, adam, plan, epochs, rng)
    top = own.tops(model).astype(float)
    weight = np.where(y == 1, *plan.weights(share))
    model.slope, model.shift = _calibrate(lambda *w: _calibration_sums(top, y, weight, *w), len(y))
    return model


def _text_counts(hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words and how many texts have them."""
    return np.unique(np.concatenate([np.zeros(0, np.uint64), *(np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:]))]), return_counts=True)


class _Plan:
    """Rounds and turns of training, from the numbers of all texts of both classes."""

    def __init__(self, clean: int, toxic: int):
        self.clean, self.toxic = int(clean), int(toxic)
        n = self.clean + self.toxic
        # Few texts take more rounds, and the rarer class more turns in each.
        self.epochs = max(EPOCHS, -(-MIN_STEPS * BATCH // (2 * n)))
        self.warm = self.epochs * WARM_EPOCHS // EPOCHS
        self.few = int(self.toxic * 2 < n)
        some = self.toxic if self.few else self.clean
        self.turns = max(1, round((n - some) / (2 * max(1, some))))
        self.refresh = max(2, self.epochs // 12)

    def rounds(self) -> list[range]:
        """Epochs that are trained without a look at the other shares, or at the windows again."""
        early = max(1, self.epochs // EPOCHS)
        cut = lambda lo, hi, width: [range(e, min(e + width, hi)) for e in range(lo, hi, width)]
        return cut(0, self.warm, early) + cut(self.warm, self.epochs, self.refresh)

    def weights(self, share: float) -> tuple[float, float]:
        """Weights of toxic and clean texts; ``share`` is that of label 1."""
        n = self.clean + self.toxic
        return share * n / self.toxic, (1 - share) * n / self.clean


class _Share:
    """Texts that are trained on together."""

    def __init__(self, runs: Runs, y: np.ndarray):
        self.runs, self.y = runs, y
        self.ends = np.append(runs.begin[1:], len(runs.grams))
        self.text, self.begin, self.size = windows(runs.first)
        self.of = np.split(np.arange(len(self.text)), np.cumsum(np.bincount(self.text, minlength=len(y)))[:-1])

    def logits(self, model: Model) -> np.ndarray:
        return model.logits(self.runs, self.begin, self.size)

    def tops(self, model: Model) -> np.ndarray:
        top = np.full(len(self.y), -np.inf)
        np.maximum.at(top, self.text, self.logits(model))
        return top

    def learn(self, model: Model, adam: _Adam, plan: _Plan, epochs: range, rng: np.random.Generator) -> None:
        """Train ``model`` and ``adam`` in place for some epochs."""
        y, best, word = self.y, None, model.numbers(self.runs.words)
        if epochs[0] >= plan.warm:
            logit = self.logits(model)
            best = [v[logit[v].argmax()] for v in self.of]
        for epoch in epochs:
            if best is None:
                pick = [rng.choice(v, min(len(v), 3), replace=False) for v in self.of]
            else:
                pick = [[best[i], *([] if y[i] else [rng.choice(v)])] for i, v in enumerate(self.of)]
            pick = np.concatenate([np.repeat(np.asarray(v, int), plan.turns if y[i] == plan.few else 1) for i, v in enumerate(pick)])
            pick = rng.permutation(pick)
            rate = RATE * (1 - epoch / plan.epochs)
            for i in range(0, len(pick), BATCH):
                self._step(model.p, adam, word, pick[i : i + BATCH], rate, rng)

    def _step(self, p: dict, adam: _Adam, word: np.ndarray, rows: np.ndarray, rate: float, rng: np.random.Generator) -> None:
        runs = self.runs
        if not len(runs.at):
            return  # texts without any word
        step = np.arange(WINDOW)[:, None]
        mask = step < self.size[rows]
        used, back = np.unique(runs.at[np.minimum(self.begin[rows] + step, len(runs.at) - 1)], return_inverse=True)
        back = back.reshape(mask.shape)
        ids = np.where(rng.random(len(used)) < 0.3, 0, word[used])
        lo = runs.begin[used]
        n = self.ends[used] - lo
        at = np.cumsum(n) - n
        grams = runs.grams[np.repeat(lo - at, n) + np.arange(n.sum())]
        x = np.concatenate([p["words"].take(ids, axis=0), _means(p["grams"], grams, at)], axis=1).take(back, axis=0)
        _, d, dx = gradients(p, x, mask, self.y[self.text[rows]].astype(np.float32))
        dx *= mask[..., None]
        per = _added(len(used), back.ravel(), dx.reshape(-1, dx.shape[2]))
        d["words"] = _added(len(p["words"]), ids, per[:, :WORD_DIM])
        d["grams"] = _added(GRAM_BINS, grams, np.repeat(per[:, WORD_DIM:] / n[:, None].astype(np.float32), n, axis=0))
        adam.step(p, d, rate)


def _shares(batches):
    """(number, share) of the shares of a task; the rows of one follow each other. What is held of one ends at twice a share's size."""
    held: list[pa.RecordBatch] = []
    large = lambda: sum(b.num_rows for b in held) >= 2 * SHARE_TEXTS or sum(b.nbytes for b in held) >= 2 * SHARE_BYTES

    def whole():
        t = pa.Table.from_batches(held)
        return t.column("share")[0].as_py(), _Share(_runs_in_chunks(t.column("text")), t.column("y").to_numpy())

    for b in batches:
        number = b.column("share").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(number)) + 1), len(number)]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            if hi > lo:
                if held and (held[0].column("share")[0].as_py() != number[lo] or large()):
                    yield whole()
                    held.clear()
                held.append(b.slice(lo, hi - lo))
    if held:
        yield whole()


def _packed(p: dict, adam: _Adam) -> np.ndarray:
    return np.concatenate([x[k].ravel() for x in (p, adam.m, adam.v) for k in p])


def _unpacked(vec: np.ndarray, p: dict, adam: _Adam) -> None:
    lo = 0
    for x in (p, adam.m, adam.v):
        for k in p:
            x[k] = vec[lo : lo + p[k].size].reshape(p[k].shape).astype(np.float32)
            lo += p[k].size


def _likely(rows: DataFrame, known: DataFrame, n: int) -> DataFrame:
    """``rows`` whose doc_id is among the ``n`` of ``known``, and a few others: what need not be shuffled for a join goes before it.

    Hashed ids are bits of a broadcast map; where it is at its largest, more others stay.
    """
    pages = max(1, min(MAX_PAGES, -(-n * ID_BITS // PAGE_BITS)))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(pages * PAGE_BITS))
    page, bit = F.floor(at / PAGE_BITS), at % PAGE_BITS
    marks = known.select(page.alias("__page"), bit.alias("__bit")).groupBy("__page").agg(F.bitmap_construct_agg("__bit").alias("__marks"))
    byte = F.conv(F.hex(F.substring(F.col("__marks"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return rows.join(F.broadcast(marks), (page == F.col("__page")) & (F.getbit(byte, (bit % 8).cast("int")) == 1), "left_semi")


def fit(docs: DataFrame, labels: DataFrame, seed: int = 7) -> Model:
    """Learn from all labelled rows; rows of fold 0 (crc32 of the id modulo 5) take no part. The files of training are removed at the end."""
    work = shared_dir(docs.sparkSession, "toxicity")
    try:
        return _fit(docs, labels, seed, work)
    finally:
        remove(docs.sparkSession, work)


def _fit(docs: DataFrame, labels: DataFrame, seed: int, work: str) -> Model:
    spark = docs.sparkSession
    ship_package(spark)
    learnt = crc_fold(F.col("doc_id"), 5) != 0
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & learnt)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("y"))
    )
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not sizes:
        return Model(None, np.zeros(0, np.uint64), 1, 0)
    toxic = sizes.get(1, 0) / sum(sizes.values())
    rows = docs.where(learnt).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    there = rows.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).join(known, "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).first()
    shares = max(1, -(-there["n"] // SHARE_TEXTS), -(-(there["size"] or 0) // SHARE_BYTES))
    # Texts move once, those with labels alone. They and the labels meet in their share: a join could deal them again, by other keys, and take the shares apart.
    rows = _likely(rows, known, sum(sizes.values())).unionByName(known, allowMissingColumns=True)
    rows = rows.withColumn("share", F.pmod(F.xxhash64("doc_id"), F.lit(shares)).cast("int")).repartition(shares, "share")
    rows = rows.withColumn("label", F.max("y").over(Window.partitionBy("share", "doc_id"))).where("y IS NULL AND label IS NOT NULL").withColumn("y", F.col("label"))
    # Copies of a row teach nothing new; the order is that of ids and texts, so a task run again learns the same.
    rows = rows.dropDuplicates(["share", "doc_id", "text"])
    rows = stored(rows.sortWithinPartitions("share", F.xxhash64("doc_id", F.lit(3)), "doc_id", "text").select("share", "text", "y"), f"{work}/texts")
    seen = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    if len(seen) < 2:
        return Model(None, np.zeros(0, np.uint64), 1, 0, constant=toxic)
    plan = _Plan(seen[0], seen[1])

    def counted(batches):
        for b in batches:
            for c in chunks(b, "text"):
                w, n = _text_counts(*letter_runs(c.column("text"))[:2])
                yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    often = rows.mapInArrow(counted, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_TEXTS).orderBy(F.desc("n"), "word").limit(MAX_WORDS)
    vocab = np.sort(np.array([r["word"] for r in often.collect()], np.int64).view(np.uint64))
    p = initial(len(vocab), np.random.default_rng(seed))
    adam = _Adam(p)

    for epochs in plan.rounds():
        start, t = _packed(p, adam), adam.t

        def learn(batches):
            total, texts, steps = np.zeros(len(start)), 0, 0.0
            for number, own in _shares(batches):
                mine = Model(initial(len(vocab), np.random.default_rng(seed)), vocab, 1, 0)
                moments = _Adam(mine.p)
                _unpacked(start, mine.p, moments)
                moments.t = t
                own.learn(mine, moments, plan, epochs, np.random.default_rng([seed, number, epochs[0]]))
                total += len(own.y) * _packed(mine.p, moments).astype(float)
                texts += len(own.y)
                steps += len(own.y) * float(moments.t)
            if texts:
                yield vector_rows([(0, 0.0, np.array([texts, steps])), *((i + 1, 0.0, v) for i, v in enumerate(np.array_split(total, BLOCKS)))])

        got = vector_totals(rows.mapInArrow(learn, VECTOR_ROWS))
        _unpacked(np.concatenate([got[i + 1] for i in range(BLOCKS)]) / got[0][0], p, adam)
        adam.t = round(got[0][1] / got[0][0])
    model = Model(p, vocab, 1, 0)

    def tops(batches):
        for b in batches:
            for c in chunks(b, "text"):
                yield pa.RecordBatch.from_arrays([pa.array(model.tops(c.column("text"))), c.column("y")], names=["x", "y"])

    judged = stored(rows.mapInArrow(tops, "x double, y int"), f"{work}/logits")
    w1, w0 = plan.weights(toxic)

    def sums(slope, shift):
        def add(batches):
            got = np.zeros(5)
            for b in batches:
                y = b.column("y").to_numpy()
                got += _calibration_sums(b.column("x").to_numpy(), y, np.where(y == 1, w1, w0), slope, shift)
            yield vector_rows([(0, 0.0, got)])

        return vector_totals(judged.mapInArrow(add, VECTOR_ROWS))[0]

    model.slope, model.shift = _calibrate(sums, plan.clean + plan.toxic)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the score of every whole text."""
    ship_package(docs.sparkSession)
    docs = without(docs, out)

    def run(batches):
        for b in batches:
            for c in chunks(b, text):
                yield pa.RecordBatch.from_arrays([*c.columns, pa.array(model.scores(c.column(text)), pa.float64())], names=[*c.schema.names, out])

    return docs.mapInArrow(run, passing(docs.schema, f"`{out}` double"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels"))
    held = F.coalesce(crc_fold(F.col("doc_id"), 5) == 0, F.lit(False)).alias("held_out")
    return score(docs.select("doc_id", held, "text"), model).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; the others go."""
    model = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, model, out="__llm_toxic").where(F.col("__llm_toxic") < 0.5).select(*docs.columns)
