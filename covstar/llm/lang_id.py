"""Language identification by hierarchical discrimination.

The languages are first grouped into families: the character profiles of the
training rows are merged pairwise, closest first, until ``ceil(sqrt(n))``
families are left. A text is given to a family by one linear support vector
machine for each family, and within it to a language by the machines of each
pair of its languages (one-versus-one). Features: shares of hashed letter
1-, 2- and 3-grams of the whole text, square-rooted, unit length.

The machines are fitted on a bounded sample (``PER_LANGUAGE`` rows of each
language, fewer where all languages together would exceed ``ROWS``, those with the
smallest hash of their id); every labelled language is learnt. The sample's texts
stay on the executors, only their features (sparse rows) reach the driver.

Results for odd input: a text that is null, empty or without letters is ``und``
with score 0; without any labelled row everything is ``und``; with one known
language every text with letters gets it; rows with a null id are judged but
never learnt from.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covstar.llm.chars import LETTER, classes, points
from covstar.llm.common import sample_ids

#: Labelled rows of each language, and of all languages together, that are learnt from (one of each at least).
PER_LANGUAGE, ROWS = 500, 20_000
UNI, BI, TRI = 512, 2048, 4096
WIDTH = UNI + BI + TRI
#: Letters of the short extract that is learnt beside each whole text.
SHORT = 60
UNKNOWN = "und"


# --------------------------------------------------------------- features

def grams(text: str) -> np.ndarray:
    """Buckets of the letter n-grams of a text; anything else is one kind of gap."""
    if not text:
        return np.zeros(0, np.int64)
    c = points(text.lower())
    letter = (classes()[c] & LETTER) > 0
    if not letter.any():
        return np.zeros(0, np.int64)
    c = np.where(letter, c, 0).astype(np.uint32)
    pad = np.zeros(len(c) + 2, np.uint32)
    pad[1:-1] = c
    uni = c[letter] * np.uint32(2654435761) >> np.uint32(32 - 9)
    two = pad[:-1] * np.uint32(0x01000193) ^ pad[1:] * np.uint32(0x85EBCA6B)
    some = (pad[:-1] > 0) | (pad[1:] > 0)
    bi = two[some] * np.uint32(2654435761) >> np.uint32(32 - 11)
    three = (two[:-1] * np.uint32(0xC2B2AE35) ^ pad[2:] * np.uint32(0x27D4EB2F))[letter]
    tri = three * np.uint32(2654435761) >> np.uint32(32 - 12)
    return np.concatenate([uni.astype(np.int64), UNI + bi.astype(np.int64), UNI + BI + tri.astype(np.int64)])


def vector(buckets: np.ndarray) -> np.ndarray:
    v = np.sqrt(np.bincount(buckets, minlength=WIDTH).astype(np.float32))
    return v / max(float(np.sqrt((v * v).sum())), 1e-9)


# --------------------------------------------------------------- training

class Rows:
    """Sparse rows: the buckets and values of each, of unit length."""

    def __init__(self, buckets: list[np.ndarray], counts: list[np.ndarray]):
        self.at = buckets
        self.values = [np.sqrt(c.astype(np.float64)) / max(math.sqrt(float(c.sum())), 1e-9) for c in counts]

    def mean(self, own: np.ndarray) -> np.ndarray:
        total = np.zeros(WIDTH)
        for i in own.tolist():
            total[self.at[i]] += self.values[i]
        return total / max(1, len(own))


def svm(x: Rows, own: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Linear support vector machine (squared hinge, dual coordinate descent) of the
    rows ``own``; ``y`` is -1 or 1, the last weight is the bias."""
    share = {s: len(y) / (2 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    w, bias, alpha = np.zeros(WIDTH), 0.0, [0.0] * len(y)
    own, y = own.tolist(), y.tolist()
    diag = [1 / (2 * cost * share[s]) for s in y]
    q = [float(x.values[i] @ x.values[i]) + 1 + d for i, d in zip(own, diag)]
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(y)).tolist():
            at, values = x.at[own[i]], x.values[own[i]]
            g = y[i] * (float(w[at] @ values) + bias) - 1 + diag[i] * alpha[i]
            new = max(alpha[i] - g / q[i], 0.0)
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[at] += step * values
                bias += step
                alpha[i] = new
    return np.append(w, bias).astype(np.float32)


def families(profiles: dict[str, np.ndarray]) -> list[list[str]]:
    """Languages merged by the nearness of their mean profiles."""
    groups = [[x] for x in sorted(profiles)]
    def near(a, b):
        return np.mean([profiles[x] @ profiles[y] for x in a for y in b])
    score = {p: near(groups[p[0]], groups[p[1]]) for p in combinations(range(len(groups)), 2)}
    while len(groups) > math.ceil(math.sqrt(len(profiles))):
        a, b = max(score, key=lambda p: (score[p], -p[0], -p[1]))
        groups[a] = sorted(groups[a] + groups.pop(b))
        # numbers above b move down; only the merged group is compared anew
        down = lambda k: k - (k > b)
        score = {(down(i), down(j)): v for (i, j), v in score.items() if b not in (i, j) and a not in (i, j)}
        score |= {(min(a, k), max(a, k)): near(groups[a], groups[k]) for k in range(len(groups)) if k != a}
    return groups


class Model:
    """Weights of all machines side by side; bounded by the number of languages."""

    def __init__(self, x: Rows, langs: np.ndarray):
        names, which = np.unique(langs.astype(str), return_inverse=True)
        self.langs = names.tolist()
        rows_of = [np.flatnonzero(which == k) for k in range(len(self.langs))]
        profiles = {}
        for name, own in zip(self.langs, rows_of):
            m = x.mean(own)
            profiles[name] = m / max(float(np.sqrt(m @ m)), 1e-9)
        self.families = families(profiles) if self.langs else []
        place = {name: k for k, name in enumerate(self.langs)}
        columns = []
        self.family_at, self.pairs = {}, {}
        if len(self.families) > 1:
            for k, family in enumerate(self.families):
                self.family_at[k] = len(columns)
                columns.append(svm(x, np.arange(len(which)), np.where(np.isin(which, [place[f] for f in family]), 1, -1)))
        for family in self.families:
            for a, b in combinations(family, 2):
                own = np.sort(np.concatenate([rows_of[place[a]], rows_of[place[b]]]))
                self.pairs[a, b] = len(columns)
                columns.append(svm(x, own, np.where(which[own] == place[a], 1, -1)))
        self.weights = np.stack(columns, 1) if columns else np.zeros((WIDTH + 1, 0), np.float32)

    def predict(self, texts: list[str | None]) -> pd.DataFrame:
        found = [grams(t) if isinstance(t, str) else np.zeros(0, np.int64) for t in texts]
        names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        own = [i for i, g in enumerate(found) if len(g)]
        if own and self.langs:
            margins = np.stack([vector(found[i]) for i in own]) @ self.weights[:-1] + self.weights[-1]
            sure = 1 / (1 + np.exp(-3 * margins.astype(np.float64)))
            for i, p in zip(own, sure):
                names[i], scores[i] = self._choose(p)
        return pd.DataFrame({"lang_pred": names, "score": scores})

    def _choose(self, p: np.ndarray) -> tuple[str, float]:
        share = {k: p[at] for k, at in self.family_at.items()} or {0: 1.0}
        k = max(share, key=lambda k: (share[k], -k))
        family = self.families[k]
        score = share[k] / sum(share.values())
        if len(family) == 1:
            return family[0], float(score)
        votes = dict.fromkeys(family, 0.0)
        wins = dict.fromkeys(family, 0)
        for a, b in combinations(family, 2):
            v = p[self.pairs[a, b]]
            votes[a] += v
            votes[b] += 1 - v
            wins[a if v >= 0.5 else b] += 1
        best = min(family, key=lambda x: (-wins[x], -votes[x], x))
        return best, float(score * votes[best] / (len(family) - 1))


def train(docs: DataFrame, learn: Column) -> Model:
    """The model of the rows of ``docs`` (doc_id, text, lang) where ``learn``
    holds: a bounded sample by language, whole texts and short extracts."""
    rows = docs.filter(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    n = rows.agg(F.count_distinct("lang").alias("n")).first()["n"]
    ids = sample_ids(rows, "lang", max(1, min(PER_LANGUAGE, ROWS // max(1, n))))
    chosen = docs.sparkSession.createDataFrame([(i,) for i in ids], docs.select(F.col("doc_id").alias("li_id")).schema)

    def run(batches: Iterator[pd.DataFrame]):
        for pdf in batches:
            for doc, lang, text in zip(pdf["doc_id"], pdf["lang"], pdf["text"]):
                at = hash(int(doc)) * 7919 % max(1, len(text) - SHORT)
                for n, part in enumerate((text, text[at:at + SHORT])):
                    b = np.bincount(grams(part), minlength=WIDTH)
                    i = np.flatnonzero(b)
                    if len(i):
                        yield pd.DataFrame({"doc_id": [doc], "n": [n], "lang": [lang], "at": [i.astype(np.int32).tobytes()],
                                            "count": [b[i].astype(np.int32).tobytes()]})

    sample = (rows.filter(F.col("text").isNotNull()).join(F.broadcast(chosen), F.col("doc_id") == F.col("li_id"), "left_semi")
              .select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")
              .mapInPandas(run, "doc_id long, n int, lang string, at binary, count binary")
              .toPandas().sort_values(["doc_id", "n", "lang"], ignore_index=True))
    x = Rows([np.frombuffer(b, np.int32) for b in sample["at"]], [np.frombuffer(b, np.int32) for b in sample["count"]])
    return Model(x, sample["lang"].to_numpy())


def predictor(model: Model):
    """A column function text -> struct(lang_pred, score)."""
    @F.pandas_udf("lang_pred string, score double")
    def judged(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            texts = texts.tolist()
            yield pd.concat([model.predict(texts[at:at + 256]) for at in range(0, len(texts), 256)] or [model.predict([])], ignore_index=True)
    return judged


def identify(docs: DataFrame, learn: Column) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of ``docs``."""
    got = predictor(train(docs, learn))(F.col("text"))
    return docs.select("doc_id", got.alias("p")).select("doc_id", "p.lang_pred", "p.score")
