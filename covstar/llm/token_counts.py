"""Token counts by a unigram model, with dynamic programming shared in a trie.

The distinct words of a batch of texts are put into a trie, level by level. The
forward score of a node (best sum of log scores over the pieces that spell its
prefix; of equal ones the one with fewest pieces) depends on its ancestors only,
so it is computed once for all words that share the prefix; the number of pieces
at a word's last node is its count. A document's count is the sum over its words.

The vocabulary file is one of merges and brings no probabilities, and tokenizers
are not trained here: the log score of a piece is Zipf's law of its place in the
vocabulary, ``-ln(place + 1)``; a byte of a character outside the vocabulary
scores ``BYTE``.

Results for odd input: a null or empty text counts 0; rows repeated or with a
null id are counted like any other.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from covstar.llm.common import with_long_ids, with_text_ids
from covstar.llm.piece_words import Pieces, words

#: Log score of a byte of a character that no piece holds.
BYTE = -20.0
#: Words a worker remembers; longer words get a dynamic program of their own.
WORDS_KEPT, SHORT = 800_000, 64
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Unigram:
    def __init__(self, path: str):
        pieces = Pieces.of(path)
        place = {i: n for n, i in enumerate(sorted(pieces.ids.values(), key=lambda i: (-pieces.scores[i], i)))}
        self.score = {p: -math.log(place[i] + 1) for p, i in pieces.ids.items()}
        self.longest = pieces.longest
        self.by_length = []
        for n in range(1, self.longest + 1):
            own = {self._hash(p): s for p, s in self.score.items() if len(p) == n}
            keys = np.array(sorted(own), np.uint64)
            self.by_length.append((keys, np.array([own[k] for k in keys.tolist()])))
        self.known: dict[str, int] = {}

    @staticmethod
    def _hash(text: str) -> int:
        h = 0
        for c in text:
            h = h * int(_STEP) + ord(c) * 0xD6E8FEB86659FD93 + 1 & (1 << 64) - 1
        return h

    def alone(self, char: str) -> tuple[float, int]:
        """Score and pieces of a character that no piece spells."""
        n = len(char.encode("utf-8", "surrogatepass"))
        return n * BYTE, n

    def count(self, word: str) -> int:
        """Pieces of one word by its own dynamic program."""
        best = [(0.0, 0)] + [(-math.inf, 0)] * len(word)
        for i in range(1, len(word) + 1):
            for n in range(1, min(i, self.longest) + 1):
                s = self.score.get(word[i - n:i])
                k = 1
                if s is None:
                    if n > 1:
                        continue
                    s, k = self.alone(word[i - 1])
                s, k = best[i - n][0] + s, best[i - n][1] + k
                if s > best[i][0] or s == best[i][0] and k < best[i][1]:
                    best[i] = (s, k)
        return best[-1][1]

    def learn(self, new: set[str]) -> None:
        if len(self.known) > WORDS_KEPT:
            self.known = {}
        missing = new.difference(self.known)
        short = [w for w in missing if len(w) <= SHORT]
        for at in range(0, len(short), 100_000):
            part = short[at:at + 100_000]
            self.known.update(zip(part, self._trie(part).tolist()))
        for w in missing:
            if len(w) > SHORT:
                self.known[w] = self.count(w)

    def _trie(self, many: list[str]) -> np.ndarray:
        """Pieces of each word, one forward score for each node of their trie."""
        size = np.array([len(w) for w in many])
        points = np.frombuffer("".join(many).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.cumsum(size) - size
        out = np.zeros(len(many), np.int64)
        levels = [(np.zeros(1, np.uint64), np.zeros(1), np.zeros(1, np.int64))]   # hash, score, pieces of each node
        up = [np.zeros(1, np.int64)]                                              # ancestors of the last level's nodes
        node, live = np.zeros(len(many), np.int64), np.arange(len(many))
        for depth in range(1, int(size.max(initial=0)) + 1):
            live_on = size[live] >= depth
            live, node = live[live_on], node[live_on]
            char = points[first[live] + depth - 1].astype(np.int64)
            edges, node = np.unique(node << 21 | char, return_inverse=True)
            parent, char = edges >> 21, edges & (1 << 21) - 1
            # up[n]: place, n levels up, of each node's ancestor
            up = [np.arange(len(edges)), *(a[parent] for a in up)][:self.longest + 1]
            h = levels[-1][0][parent] * _STEP + char.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(1)
            score, pieces = np.full(len(edges), -np.inf), np.zeros(len(edges), np.int64)
            for n in range(1, min(depth, self.longest) + 1):
                keys, values = self.by_length[n - 1]
                above = levels[-n]
                part = h - above[0][up[n]] * np.uint64(pow(int(_STEP), n, 1 << 64))
                if not len(keys):
                    continue
                at = np.minimum(np.searchsorted(keys, part), len(keys) - 1)
                hit = np.flatnonzero(keys[at] == part)
                a = up[n][hit]
                s, k = above[1][a] + values[at[hit]], above[2][a] + 1
                better = (s > score[hit]) | (s == score[hit]) & (k < pieces[hit])
                score[hit[better]], pieces[hit[better]] = s[better], k[better]
                if n == 1:
                    odd = np.setdiff1d(np.arange(len(edges)), hit)
                    for i in odd.tolist():
                        s, k = self.alone(chr(char[i]))
                        a = up[1][i]
                        score[i], pieces[i] = above[1][a] + s, above[2][a] + k
            levels.append((h, score, pieces))
            levels = levels[-self.longest - 1:]
            ends = size[live] == depth
            out[live[ends]] = pieces[node[ends]]
        return out


_models: dict[str, Unigram] = {}


def model(path: str) -> Unigram:
    if path not in _models:
        _models[path] = Unigram(path)
    return _models[path]


def counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_words, n_tokens) of every row of ``docs``."""
    def run(batches: Iterator[pd.DataFrame]):
        unigram = model(path)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            rows, at = [], 0
            while at < len(texts):
                cut, chars = [], 0
                while at < len(texts) and chars < 1_000_000:
                    chars += len(texts[at])
                    cut.append(words(texts[at]))
                    at += 1
                unigram.learn(set().union(*cut))
                rows += [(len(w), sum(map(unigram.known.__getitem__, w))) for w in cut]
            out = pd.DataFrame(rows, columns=["n_words", "n_tokens"])
            out.insert(0, "doc_id", pdf["doc_id"].to_numpy())
            yield out
    return with_long_ids(with_text_ids(docs).mapInPandas(run, "doc_id string, n_words long, n_tokens long"))
