"""Periodic runs of words: maximal pairs found bottom-up in a tree of LCP intervals.

A run is a stretch of words with smallest period q, at least ``LEAST`` and 2q words
long, that no neighbouring word extends. Let d be the distance of two equal
substrings of l words that no word extends to the left or right (a maximal pair).
If d <= l, the stretch from the first to the end of the second has period d and
nothing extends it; a run in turn is the pair of its own copies shifted by q.
So the maximal pairs with d <= l and d + l >= ``LEAST`` are the runs, and the
least d of a stretch is its period.

For the texts of a batch a suffix array is built by doubling (words are numbered
anew in each text, so no two texts share a prefix), with the lengths of common
prefixes from the doubled ranks. A stack walks the LCP intervals bottom-up; an
interval keeps its places in one sorted list for each left word. When a child
joins, each place of the smaller side meets the nearest place of every *other*
left word: same left words extend to the left, and a place in between would give
a smaller period. Every run has l >= LEAST / 2, so texts in which no string of
that many words occurs twice have no run and need no suffix array, and intervals
below that depth are not walked.

Spark deals the texts; each is one unit, since a run may span all of it. Time is
O(n log n) for a text, and lists of places grow with the repeated part only.

Results for odd input: null and empty texts have no word and no run; null and
repeated ids are rows of their own; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Least length of a run; words of the texts that share one suffix array.
LEAST, GROUP = 12, 200_000


def _repeating(words: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """The texts in which some string of ``size`` words occurs twice (by hash; at most a few more)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = text[:n].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for k in range(size):
        h = h * np.uint64(0xBF58476D1CE4E5B9) + mixed[k:k + n]
    at = np.flatnonzero(text[:n] == text[size - 1:])
    order = at[np.argsort(h[at], kind="stable")]
    twice = h[order[1:]] == h[order[:-1]]
    return np.unique(text[order[1:][twice]])


def suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and common prefix of each suffix with the one before it.
    ``words`` ends each text with a number that occurs once."""
    n, step = len(words), 1
    ranks = [np.unique(words, return_inverse=True)[1]]
    while ranks[-1].max() + 1 < n:
        r = ranks[-1].astype(np.int64)
        behind = np.zeros(n, np.int64)
        behind[:n - step] = r[step:] + 1
        ranks.append(np.unique(r * (n + 1) + behind, return_inverse=True)[1].astype(np.int32))
        step *= 2
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    a, b, common = order[:-1], order[1:], np.zeros(n - 1, np.int64)
    for k in range(len(ranks) - 2, -1, -1):
        inside = np.flatnonzero(np.maximum(a, b) + common < n)
        same = inside[ranks[k][a[inside] + common[inside]] == ranks[k][b[inside] + common[inside]]]
        common[same] += 1 << k
    return order, np.append(0, common)


def _join(one: list, two: list, common: int, least: int, found: dict) -> list:
    """Two children of an interval become one; their maximal pairs near enough go to ``found``."""
    if one[0] < two[0]:
        one, two = two, one
    lists = one[1]
    for word, places in two[1].items():
        for other, held in lists.items():
            if other == word:
                continue
            for p in places:
                k = bisect_left(held, p)
                for q in held[max(0, k - 1):k + 1]:
                    a, d = (p, q - p) if p < q else (q, p - q)
                    if d <= common and d + common >= least and d < found.get((a, d + common), d + 1):
                        found[a, d + common] = d
    for word, places in two[1].items():
        held = lists.get(word)
        if held is None:
            lists[word] = places
        else:
            for p in places:
                insort(held, p)
    one[0] += two[0]
    return one


def maximal_pairs(words: np.ndarray, least: int = LEAST) -> dict[tuple[int, int], int]:
    """(start, length) -> period of the runs of ``words``, texts ended by numbers that occur once."""
    order, common = suffixes(words)
    floor = (least + 1) // 2
    deep = np.flatnonzero(common >= floor)
    found: dict[tuple[int, int], int] = {}
    if not len(deep):
        return found
    left = np.append(-1, words[:-1])
    # a stretch of neighbours with deep common prefixes is one subtree
    ends = np.append(np.flatnonzero(np.diff(deep) > 1) + 1, len(deep))
    lo = 0
    for hi in ends.tolist():
        first, last = int(deep[lo]) - 1, int(deep[hi - 1])
        place = order[first:last + 1]
        before, places, depth = left[place].tolist(), place.tolist(), common[first + 1:last + 1].tolist()
        stack: list[tuple[int, list]] = []
        now = [1, {before[0]: [places[0]]}]
        for i, h in enumerate(depth, 1):
            while stack and stack[-1][0] > h:
                top, held = stack.pop()
                now = _join(held, now, top, least, found)
            if stack and stack[-1][0] == h:
                now = _join(stack.pop()[1], now, h, least, found)
            stack.append((h, now))
            now = [1, {before[i]: [places[i]]}]
        while stack:
            top, held = stack.pop()
            now = _join(held, now, top, least, found)
        lo = hi
    return found


def runs_of(texts: list[list[bytes]], least: int = LEAST) -> list[list[tuple[int, int, int]]]:
    """Runs (start, length, period) of each list of words, by start and period."""
    known: dict[bytes, int] = {}
    number = known.setdefault
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    sizes = np.array([len(t) for t in texts])
    ids = np.fromiter((number(w, len(known)) for t in texts for w in t), np.int64, int(sizes.sum()))
    text = np.repeat(np.arange(len(texts)), sizes)
    taken = _repeating(ids, text, (least + 1) // 2)
    if not len(taken):
        return out
    # the texts with repeats, words numbered by text, each ended by a number of its own
    starts = np.cumsum(sizes) - sizes
    width = len(known) + 1
    joined = np.concatenate([np.append(ids[starts[t]:starts[t] + sizes[t]] + t * width + 1, t * width) for t in taken.tolist()])
    offset = np.cumsum(sizes[taken] + 1) - sizes[taken] - 1
    for (start, length), period in sorted(maximal_pairs(joined, least).items()):
        t = int(np.searchsorted(offset, start, "right")) - 1
        out[taken[t]].append((start - int(offset[t]), length, period))
    return [sorted(r, key=lambda x: (x[0], x[2])) for r in out]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words but those that a run holds after its first period, joined by one space."""
    if not runs:
        return b" ".join(words)
    cover = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        cover[start + period] += 1
        cover[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(cover[:-1]) == 0).tolist()])


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(doc_id, n_words, runs array<start, length, period>, collapsed) of every row of ``docs``
    (doc_id, text); words are separated by ASCII white space."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        for batch in batches:
            ids, texts, at = batch.column(0), batch.column(1), 0
            while at < len(texts):
                first, words = at, []
                total = 0
                while at < len(texts) and total < GROUP:
                    words.append((texts[at].as_py() or b"").split())
                    total += len(words[-1])
                    at += 1
                got = runs_of(words, least)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(first, at - first), pa.array([len(w) for w in words], pa.int64()),
                     pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in got], span),
                     pa.array([collapsed(w, r).decode("utf-8", "replace") for w, r in zip(words, got)], pa.string())],
                    ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select("doc_id", F.col("text").cast("binary").alias("text")).mapInArrow(
        found, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")
