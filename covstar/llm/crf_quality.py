"""Document quality by a linear-chain conditional random field over lines.

Every line that holds more than white space is good or bad. A line is described
by counts over its characters and words, and by the same figures of the line
before and after it; the chain adds a weight for each pair of neighbouring
labels. The quality of a document is the mean of its lines' probabilities of
being good (forward-backward marginals), weighted by their length.

The weights are fitted on a bounded sample of labelled documents (``PER_LABEL``
of each label, those with the smallest hash of their id), whose lines all carry the
label of their document; the sample's texts stay on the executors, only line
figures reach the driver.

Results for odd input: a document that is null, empty or white space alone
scores 0; with labels of one kind only, every document with lines scores that
label; rows with a null id are scored but never learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covstar.llm.chars import DIGIT, LETTER, SPACE, UPPER, classes, points
from covstar.llm.common import sample_ids

#: Labelled documents of each label that are learnt from.
PER_LABEL = 800
BASE = 14
WIDTH = 3 * BASE + 3
_ODD = np.uint64(0x9E3779B97F4A7C15)


# --------------------------------------------------------------- features

def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2^64."""
    up, down = np.full(n, _ODD), np.full(n, np.uint64(pow(int(_ODD), -1, 1 << 64)))
    up[:1] = down[:1] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


def _hashes(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the characters of each span."""
    up, down = _powers(len(c) + 1)
    total = np.zeros(len(c) + 1, np.uint64)
    np.cumsum((c.astype(np.uint64) + np.uint64(77)) * np.uint64(0xD6E8FEB86659FD93) * up[:-1], out=total[1:])
    return (total[end] - total[start]) * down[start]


def lines(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the lines of all texts: number of the text (ascending), length, figures."""
    texts = [t if isinstance(t, str) else "" for t in texts]
    c = points("\n".join(texts) + "\n")
    if len(c) < 2:
        return np.zeros(0, int), np.zeros(0), np.zeros((0, WIDTH), np.float32)
    kind = classes()[c]
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])[:-1]))
    end = np.flatnonzero(c == 10)
    start = np.concatenate(([0], end[:-1] + 1))
    space = (kind & SPACE) > 0
    def upto(flags):
        s = np.zeros(len(c) + 1, np.int32)
        np.cumsum(flags, out=s[1:], dtype=np.int32)
        return s
    filled = upto(~space)
    own = filled[end] > filled[start]
    start, end = start[own], end[own]
    if not len(start):
        return np.zeros(0, int), np.zeros(0), np.zeros((0, WIDTH), np.float32)
    doc = np.searchsorted(first, start, "right") - 1
    def count(flags):
        s = upto(flags)
        return (s[end] - s[start]).astype(np.float32)
    n = (end - start).astype(np.float32)
    alnum = (kind & (LETTER | DIGIT)) > 0
    symbol = ~alnum & ~space
    letters = count((kind & LETTER) > 0)
    same = np.zeros(len(c), bool)
    same[1:] = symbol[1:] & (c[1:] == c[:-1])
    opens = ~space
    opens[1:] &= space[:-1]
    closes = ~space[:-1] & space[1:]                   # the text ends with a line end
    w0, w1 = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    named = upto(alnum)
    bare = np.zeros(len(c), bool)
    bare[w0] = named[w1] == named[w0]                  # words without letter or digit
    h = _hashes(c, w0, w1)
    again = np.zeros(len(c), bool)
    again[w0[1:]] = h[1:] == h[:-1]
    marked = np.zeros(len(c), bool)
    marked[w0] = symbol[w1 - 1] & (w1 - w0 > 2) & symbol[np.maximum(w1 - 2, 0)]
    words = np.maximum(count(opens), 1)
    last = c[np.maximum(end - 1, 0)]
    whole = _hashes(c, start, end)
    _, code, times = np.unique(np.stack([doc.astype(np.uint64), whole], 1), axis=0, return_inverse=True, return_counts=True)
    base = np.stack([
        np.log1p(n) / 5, letters / n, count((kind & UPPER) > 0) / np.maximum(letters, 1), count((kind & DIGIT) > 0) / n,
        count(symbol) / n, count(same) / n, count(bare) / words, count(again) / words, count(marked) / words,
        np.minimum(n / words, 40) / 10, np.isin(last, [33, 46, 63]), (kind[start] & UPPER) > 0,
        np.minimum(times[code.ravel()] - 1, 5) / 5, words == 1], 1).astype(np.float32)
    before, after = np.zeros_like(base), np.zeros_like(base)
    inner = doc[1:] == doc[:-1]
    before[1:][inner] = base[:-1][inner]
    after[:-1][inner] = base[1:][inner]
    edge = np.zeros((len(doc), 3), np.float32)
    edge[:, 0] = 1
    edge[1:, 1] = ~inner
    edge[:1, 1] = edge[-1:, 2] = 1
    edge[:-1, 2] = ~inner
    return doc, n.astype(np.float64), np.concatenate([base, before, after, edge], 1)


# ------------------------------------------------------------------ chain

def marginals(score: np.ndarray, sizes: np.ndarray, t: np.ndarray):
    """Log odds of good from the left (line's own score included) and from the
    right, for chains of ``sizes`` laid end to end; ``t[i, j]``: weight of label
    j after label i. Chains advance together, the long ones last to end."""
    order = np.argsort(-sizes, kind="stable")
    start = (np.cumsum(sizes) - sizes)[order]
    n = sizes[order]
    a, b = score.copy(), np.zeros_like(score)
    for k in range(1, int(n[0]) if len(n) else 0):
        at = start[:np.searchsorted(-n, -k, "left")] + k
        p = a[at - 1]
        a[at] += np.logaddexp(p + t[1, 1], t[0, 1]) - np.logaddexp(p + t[1, 0], t[0, 0])
    for k in range(2, int(n[0]) + 1 if len(n) else 0):
        own = np.searchsorted(-n, -k, "right")
        at = start[:own] + n[:own] - k
        q = score[at + 1] + b[at + 1]
        b[at] = np.logaddexp(t[1, 1] + q, t[1, 0]) - np.logaddexp(t[0, 1] + q, t[0, 0])
    return a, b


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


class Model:
    def __init__(self, mean, scale, weights, chain, constant=None):
        self.mean, self.scale, self.weights, self.chain, self.constant = mean, scale, weights, chain, constant

    def scores(self, texts: list[str | None]) -> np.ndarray:
        doc, length, x = lines(texts)
        out = np.zeros(len(texts))
        if not len(doc):
            return out
        if self.constant is not None:
            out[np.unique(doc)] = self.constant
            return out
        sizes = np.bincount(doc, minlength=len(texts))
        sizes = sizes[sizes > 0]
        a, b = marginals((x - self.mean) / self.scale @ self.weights, sizes, self.chain)
        good = np.bincount(doc, sigmoid(a + b) * length, len(texts))
        total = np.bincount(doc, length, len(texts))
        return np.clip(np.divide(good, total, out=out, where=total > 0), 0, 1)


def fit(x: np.ndarray, sizes: np.ndarray, label: np.ndarray, rounds: int = 250, decay: float = 1e-3) -> Model:
    """Weights by gradient ascent (Adam) on the conditional likelihood; the
    documents weigh alike, and the two labels weigh alike."""
    if len(set(label)) < 2:
        return Model(0, 1, None, None, constant=float(label[0]) if len(label) else 0.0)
    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-3)
    mean[-3], scale[-3] = 0, 1                          # the constant
    x = ((x - mean) / scale).astype(np.float64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    y = label[doc].astype(float)
    share = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1))
    per_line = (share / np.sqrt(sizes))[doc]
    joined = np.flatnonzero(doc[1:] == doc[:-1])
    theta, m, v = np.zeros(x.shape[1] + 4), 0, 0
    for step in range(1, rounds + 1):
        w, t = theta[:-4], theta[-4:].reshape(2, 2)
        s = x @ w
        a, b = marginals(s, sizes, t)
        g = x.T @ ((y - sigmoid(a + b)) * per_line)
        q = s + b
        both = np.stack([t[i, j] + i * a[joined] + j * q[joined + 1] for i in (0, 1) for j in (0, 1)], 1)
        both = np.exp(both - both.max(1, keepdims=True))
        both /= both.sum(1, keepdims=True)
        seen = np.zeros_like(both)
        seen[np.arange(len(joined)), (3 * y[joined]).astype(int)] = 1
        g = np.concatenate([g, ((seen - both) * per_line[joined, None]).sum(0)]) - decay * theta
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        theta += 0.05 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return Model(mean, scale, theta[:-4], theta[-4:].reshape(2, 2))


def train(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """The model of the documents with a label (``labels``: doc_id, quality)
    whose id meets ``learn`` (a condition on ``doc_id``)."""
    known = labels.filter(learn & F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    sample = sample_ids(known, "quality", PER_LABEL)

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                x = lines([text])[2]
                if len(x):
                    yield pd.DataFrame({"doc_id": [doc], "x": [x.tobytes()]})

    got = (docs.filter(F.col("doc_id").isin(list(sample))).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
           .mapInPandas(run, "doc_id long, x binary").toPandas().sort_values(["doc_id", "x"], ignore_index=True))
    xs = [np.frombuffer(b, np.float32).reshape(-1, WIDTH) for b in got["x"]]
    return fit(np.concatenate(xs) if xs else np.zeros((0, WIDTH)), np.array([len(x) for x in xs], int),
               np.array([sample[d] for d in got["doc_id"]], int))


def scorer(model: Model):
    """A column function text -> quality from 0 to 1."""
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts, out, at = texts.tolist(), [], 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars < 500_000):
                    chars += len(texts[upto] or "")
                    upto += 1
                out.append(model.scores(texts[at:upto]))
                at = upto
            yield pd.Series(np.concatenate(out) if out else np.zeros(0))
    return scored


def score(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    return docs.select("doc_id", scorer(train(docs, labels, learn))(F.col("text")).alias("score"))
