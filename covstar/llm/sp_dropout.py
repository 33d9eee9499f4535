"""SentencePiece encoding with seeded merge-dropout, and lossless decoding.

Encoding takes the best-scored merge of a word's neighbouring symbols (leftmost,
if equal) until none is left. A candidate merge is skipped if a keyed hash of
(seed, document id, the word's place in the text, its span) falls below the
dropout rate; its place in the agenda is then as good as empty. So every place of
every document has a segmentation of its own, the same on every run.

A worker remembers the cuts of each word in a trie of decisions. A node is a set of
skipped candidates; it holds the cut they lead to and the merges made on the way
after the last of them. A place goes down by the first of these merges that it
skips and takes the cut of the node where it skips none. This is exact: a skipped
candidate that is never the best changes nothing, and up to the first skipped merge
all steps are those of the node above. A word gets a node once it was met ``OFTEN_MET``
times, and a node children once it was passed ``OFTEN`` times; what leaves the trie is
cut under its own key. Words are cut together: a column holds the symbols of a word, a
row those at one place of words of like length, and a round merges the best candidate
of each. Rate 0 gives the segmentation of the model itself.

Results for odd input: a null or empty text has no ids and decodes to an empty
text; characters outside the vocabulary, and the blank mark itself, are spelt in
bytes; rows repeated or with a null id are encoded like any other (a null id is
an id: equal texts under one id are cut alike).
"""

from __future__ import annotations

import heapq
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covstar.llm.common import with_long_ids, with_text_ids
from covstar.llm.piece_words import Pieces, words

#: Nodes a worker remembers; meetings before a word has a node, passes before a node has children. Longer words are
#: cut one by one. Words cut together.
NODES_KEPT, OFTEN_MET, OFTEN, SHORT, TOGETHER = 150_000, 10, 48, 48, 4_096
#: A worker encodes texts of so many characters together, and decodes so many ids.
CHARS_HELD, IDS_HELD = 500_000, 100_000
#: Counters of how often words were met (one that two words share only gives a node too early); they halve after as many new words.
MET = 1 << 20
_NONE = 1 << 30
_A, _B, _C = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB
_ALL = (1 << 64) - 1


def _mix(h):
    """A hash of 64 bits, on an array or a number."""
    if isinstance(h, int):
        h = (h ^ h >> 30) * _B & _ALL
        h = (h ^ h >> 27) * _C & _ALL
        return h ^ h >> 31
    h = (h ^ h >> np.uint64(30)) * np.uint64(_B)
    h = (h ^ h >> np.uint64(27)) * np.uint64(_C)
    return h ^ h >> np.uint64(31)


def _adds(codes: np.ndarray) -> np.ndarray:
    """What candidates (start << 12 | middle << 6 | end, below 64 each) add to a key."""
    c = codes.astype(np.uint64)
    return (c >> np.uint64(12)) * np.uint64(_A) + (c >> np.uint64(6) & np.uint64(63)) * np.uint64(_B) + (c & np.uint64(63)) * np.uint64(_C)


class Merger:
    """Cuts words into ids; ``place`` keys words that come without keys of their own."""

    def __init__(self, pieces: Pieces, seed: int, place: int, rate: float):
        self.pieces, self.key, self.limit = pieces, _mix(seed * _A + place + 1 & _ALL), int(rate * (1 << 32))
        order = np.unique(-pieces.scores, return_inverse=True)[1]
        table = {}
        for piece, i in pieces.ids.items():
            for cut in range(1, len(piece)):
                a, b = pieces.ids.get(piece[:cut]), pieces.ids.get(piece[cut:])
                if a is not None and b is not None:
                    table[a << 32 | b] = (int(order[i]), i)
        self.table = table
        # pairs by hash (20 bits for each symbol and for what they merge into); a taken place gives way to the next one
        self.none = len(pieces.scores)
        if self.none >= 1 << 20:
            raise ValueError("too many pieces")
        self.bits = max(4, len(table).bit_length() + 2)
        held = [-1] * ((1 << self.bits) + len(table) + 1)
        pairs = np.array([(p >> 32) << 20 | p & (1 << 20) - 1 for p in table], np.int64)
        for pair, at, (_, new) in zip(pairs.tolist(), self._place(pairs).tolist(), table.values()):
            while held[at] >= 0:
                at += 1
            held[at] = pair << 20 | new
        self.pairs = np.array(held, np.int64)
        # rank of each piece, above 6 bits for the place of a candidate that merges into it
        self.order = order.astype(np.int64) << 6
        # pieces of single characters; characters of each piece
        self.single = np.full(0x110000, self.none, np.int32)
        for piece, i in pieces.ids.items():
            if len(piece) == 1:
                self.single[ord(piece)] = i
        self.chars = {i: len(piece) for piece, i in pieces.ids.items()}
        self.met = np.zeros(MET, np.uint8)
        self.new_words = 0
        self.forget()

    def _place(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs.view(np.uint64) * np.uint64(_A) >> np.uint64(64 - self.bits)).view(np.int64)

    def _find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which pairs are merges, and the pieces they give."""
        at = self._place(pairs)
        held = self.pairs.take(at)
        look = np.flatnonzero((held >> 20 != pairs) & (held >= 0))
        at = at.take(look)
        while len(look):
            at += 1
            now = self.pairs.take(at)
            held[look] = now
            more = np.flatnonzero((now >> 20 != pairs.take(look)) & (now >= 0))
            look, at = look.take(more), at.take(more)
        hit = np.flatnonzero(held >= 0)
        return hit, held.take(hit) & (1 << 20) - 1

    def forget(self) -> None:
        #: nodes by number: word, skipped candidates, cut, how many merges came before the last skip; passes
        self.word: list[str] = []
        self.skips: list[tuple[int, ...]] = []
        self.cuts: list[bytes] = []
        self.before: list[int] = []
        self.passes = np.zeros(0, np.int64)
        #: merges after the last skip, of all nodes; where those of a node begin, how many they are
        self.later = np.zeros(0, np.int32)
        self.begin, self.size = np.zeros(0, np.int64), np.zeros(0, np.int64)
        #: node of a word without skips; node below (node << 18 | candidate)
        self.root: dict[str, int] = {}
        self.below: dict[int, int] = {}

    def _grow(self, many: list[str], skips: list[tuple[int, ...]], before: list[int]) -> range:
        """New nodes of words under given skips, the last one after ``before`` merges."""
        first = len(self.word)
        if not many:
            return range(first, first)
        merges: list[bytes] = []
        self.cuts += self._together(many, skips=skips, merges=merges)
        later = [m[4 * n:] for m, n in zip(merges, before)]
        size = np.fromiter(map(len, later), np.int64, len(many)) // 4
        self.begin = np.append(self.begin, len(self.later) + np.cumsum(size) - size)
        self.size = np.append(self.size, size)
        self.later = np.append(self.later, np.frombuffer(b"".join(later), np.int32))
        self.word += many
        self.skips += skips
        self.before += before
        self.passes = np.append(self.passes, np.zeros(len(many), np.int64))
        return range(first, len(self.word))

    def learn(self, many: list[str]) -> None:
        """Nodes for those words without one that come often."""
        times = Counter(many)
        new = [w for w in times if len(w) <= SHORT]
        bits = np.fromiter(map(hash, new), np.int64, len(new)) & MET - 1
        met = np.minimum(self.met[bits] + np.fromiter(map(times.__getitem__, new), np.int64, len(new)), 255)
        self.met[bits] = met
        self.new_words += len(new)
        if self.new_words > MET:
            self.met >>= 1
            self.new_words = 0
        new = [new[i] for i in np.flatnonzero((met >= OFTEN_MET) | (self.limit == 0)).tolist()]
        self.root.update(zip(new, self._grow(new, [()] * len(new), [0] * len(new))))

    def _descend(self, steps: np.ndarray, known: np.ndarray) -> np.ndarray:
        """Nodes below others, each step (node << 18 | skipped merge); -1 where
        none is known and the node was not passed often."""
        out = np.fromiter(map(self.below.get, steps.tolist(), repeat(-1)), np.int64, len(steps))
        add = np.flatnonzero((out < 0) & known)
        if len(add):
            missing = steps[add].tolist()
            above = [(k >> 18, k & (1 << 18) - 1) for k in missing]
            before = [self.before[n] + self.later[self.begin[n]:self.begin[n] + self.size[n]].tolist().index(c) for n, c in above]
            out[add] = self._grow([self.word[n] for n, _ in above], [(*self.skips[n], c) for n, c in above], before)
            self.below.update(zip(missing, out[add].tolist()))
        return out

    def _nodes(self, many: list[str]) -> np.ndarray:
        return np.fromiter(map(self.root.get, many, repeat(-1)), np.int64, len(many))

    def cut(self, many: list[str], keys: np.ndarray) -> list[bytes]:
        """Ids of each word under its key."""
        if len(self.word) > NODES_KEPT:
            self.forget()
        node = self._nodes(many)
        new = np.flatnonzero(node < 0)
        if len(new):
            own = [many[i] for i in new.tolist()]
            self.learn(own)
            node[new] = self._nodes(own)
        open_ = np.flatnonzero(node >= 0) if self.limit else np.zeros(0, np.int64)
        while len(open_):
            at = node[open_]
            self.passes += np.bincount(at, minlength=len(self.passes))
            n = self.size[at]
            owner = np.repeat(np.arange(len(open_)), n)
            codes = self.later[np.arange(len(owner)) + np.repeat(self.begin[at] - np.cumsum(n) + n, n)].astype(np.int64)
            hit = np.flatnonzero(self._skipped(keys[open_][owner] + _adds(codes)))
            owner = owner[hit]
            first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1]))) if len(owner) else owner
            open_ = open_[owner[first]]
            steps, which = np.unique(node[open_] << 18 | codes[hit[first]], return_inverse=True)
            node[open_] = self._descend(steps, self.passes[steps >> 18] >= OFTEN)[which]
            open_ = open_[node[open_] >= 0]
        out = [self.cuts[n] if n >= 0 else b"" for n in node.tolist()]
        single = np.flatnonzero(node < 0).tolist()
        short = [i for i in single if len(many[i]) <= SHORT]
        if len(short) < len(single):
            for i in single:
                if len(many[i]) > SHORT:
                    out[i] = self._agenda(many[i], int(keys[i]))
        for i, ids in zip(short, self._together([many[i] for i in short], keys[short])):
            out[i] = ids
        return out

    def _skipped(self, sums: np.ndarray) -> np.ndarray:
        return (_mix(sums) & np.uint64(0xFFFFFFFF)) < np.uint64(self.limit)

    def _spell(self, word: str, symbols: list[int], starts: list[int]) -> bytes:
        ids = []
        for s, at in zip(symbols, starts):
            ids += [s] if s >= 0 else self.pieces.char_ids(word[at])
        return np.array(ids, "<u4").tobytes()

    def _agenda(self, word: str, key: int | None = None) -> bytes:
        """One word by a heap of candidate merges."""
        n, ids = len(word), self.pieces.ids
        sym = [ids.get(c, -1) for c in word]
        start, end = list(range(n)), list(range(1, n + 1))
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        alive, heap, key = [True] * n, [], self.key if key is None else key

        def offer(a, b):
            if a < 0 or b >= n or sym[a] < 0 or sym[b] < 0:
                return
            hit = self.table.get(sym[a] << 32 | sym[b])
            if hit is not None and (_mix(key + start[a] * _A + start[b] * _B + end[b] * _C & _ALL) & 0xFFFFFFFF) >= self.limit:
                heapq.heappush(heap, (hit[0], a, sym[a], b, sym[b], hit[1]))

        for a in range(n - 1):
            offer(a, a + 1)
        while heap:
            _, a, was, b, next_, new = heapq.heappop(heap)
            if not (alive[a] and alive[b]) or sym[a] != was or sym[b] != next_ or right[a] != b:
                continue
            sym[a], end[a], alive[b], right[a] = new, end[b], False, right[b]
            if right[b] < n:
                left[right[b]] = a
            offer(left[a], a)
            offer(a, right[a])
        at = [i for i in range(n) if alive[i]]
        return self._spell(word, [sym[i] for i in at], [start[i] for i in at])

    def _together(self, many: list[str], keys: np.ndarray | None = None, skips: list[tuple[int, ...]] | None = None,
                  merges: list | None = None) -> list[bytes]:
        """Many words at once, those of like length in one slab. The candidates in ``skips``
        are skipped, or without it those that each word's key skips; ``merges`` takes
        the candidates merged in each word, in order (32 bits each)."""
        if not many:
            return []
        size = np.fromiter(map(len, many), np.int64, len(many))
        points = np.frombuffer("".join(many).encode("utf-32-le", "surrogatepass"), np.uint32)
        symbols = self.single.take(points)
        begin = np.cumsum(size) - size
        keys = np.full(len(many), self.key, np.uint64) if keys is None else np.asarray(keys, np.uint64)
        out: list = [b""] * len(many)
        made: list = [b""] * len(many)
        order = np.argsort(size, kind="stable")
        for lo in range(0, len(order), TOGETHER):
            own = order[lo:lo + TOGETHER]
            which = own.tolist()
            part = None if skips is None else [skips[i] for i in which]
            ids, ends, codes, steps = self._slab(symbols, begin[own], size[own], keys[own], part, merges is not None)
            raw = ids.astype("<u4").tobytes()
            for i, a, b in zip(which, [0, *ends], ends):
                out[i] = raw[4 * a:4 * b]
            for n in np.unique(np.searchsorted(ends, np.flatnonzero(ids == self.none), "right")).tolist():
                out[which[n]] = self._spell_out(many[which[n]], ids[ends[n - 1] if n else 0:ends[n]].tolist())
            if merges is not None:
                raw = codes.astype(np.int32).tobytes()
                for i, a, b in zip(which, [0, *steps], steps):
                    made[i] = raw[4 * a:4 * b]
        if merges is not None:
            merges += made
        return out

    def _spell_out(self, word: str, symbols: list[int]) -> bytes:
        """Ids of a word with characters that are no pieces."""
        starts, at = [], 0
        for s in symbols:
            starts.append(at)
            at += 1 if s == self.none else self.chars[s]
        return self._spell(word, [-1 if s == self.none else s for s in symbols], starts)

    def _slab(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray, key: np.ndarray,
              skips: list[tuple[int, ...]] | None, record: bool) -> tuple:
        """Words as columns, of the symbols from ``begin`` on; a round merges the best candidate of
        each. Gives the ids of all words and where those of each end; on ``record`` also the merges."""
        n, rows = len(size), int(size.max())
        # one row more: no symbol has a candidate with it, and what comes before the first row is it too
        place = np.arange(rows + 1)[:, None]
        live = place < size
        sym = np.where(live, symbols.take(np.minimum(begin + place, len(symbols) - 1)), self.none).ravel()
        after = np.repeat(np.arange(1, rows + 2, dtype=np.int64), n)
        prior = np.repeat(np.arange(-1, rows, dtype=np.int64), n)
        best, new = np.full((rows + 1) * n, _NONE, np.int32), np.zeros((rows + 1) * n, np.int32)
        column, live = np.arange(n), live.ravel()
        skipped = None if skips is None else np.sort(np.array([i << 18 | c for i, own in enumerate(skips) for c in own] + [1 << 62], np.int64))

        def offer(word, first, second):
            """Candidates of symbols at place ``first`` with those at ``second``."""
            i = first * n + word
            j = second * n + word
            hit, piece = self._find(sym.take(i).astype(np.int64) << 20 | sym.take(j))
            best[i] = _NONE
            i = i.take(hit)
            first = first.take(hit)
            if self.limit:
                word, second = word.take(hit), second.take(hit)
                end = after.take(j.take(hit))
                if skipped is None:
                    stay = ~self._skipped(key.take(word) + first.view(np.uint64) * np.uint64(_A) + second.view(np.uint64) * np.uint64(_B)
                                          + end.view(np.uint64) * np.uint64(_C))
                elif len(skipped) > 1:
                    own = word << 18 | first << 12 | second << 6 | end
                    stay = skipped[np.searchsorted(skipped, own)] != own
                else:
                    stay = slice(None)
                i, first, piece = i[stay], first[stay], piece[stay]
            best[i] = self.order.take(piece) | first
            new[i] = piece

        start = np.flatnonzero(live[n:])
        offer(start % n, start // n, start // n + 1)
        table, done = best.reshape(rows + 1, n), []
        while True:
            top = table.min(axis=0)
            word = np.flatnonzero(top != _NONE)
            if not len(word):
                break
            at = (top.take(word) & 63).astype(np.int64)
            i = at * n + word
            middle = after.take(i)
            j = middle * n + word
            end = after.take(j)
            if record:
                codes = np.full(n, -1, np.int32)
                codes[word] = at << 12 | middle << 6 | end
                done.append(codes)
            sym[i] = new.take(i)
            after[i] = end
            prior[end * n + word] = at
            best[j] = _NONE
            live[j] = False
            left = prior.take(i)
            inner = np.flatnonzero(left >= 0)
            offer(np.concatenate((word, word.take(inner))), np.concatenate((at, left.take(inner))), np.concatenate((end, at.take(inner))))
        live = live.reshape(rows + 1, n).T
        ids, ends = sym.reshape(rows + 1, n).T[live], np.cumsum(live.sum(axis=1)).tolist()
        if not record:
            return ids, ends, None, None
        codes = np.array(done, np.int32).reshape(-1, n).T
        return ids, ends, codes[codes >= 0], np.cumsum((codes >= 0).sum(axis=1)).tolist()


_mergers: dict[tuple, Merger] = {}


def merger(path: str, seed: int, rate: float) -> Merger:
    key = (path, seed, rate)
    if key not in _mergers:
        _mergers[key] = Merger(Pieces.of(path), seed, 0, rate)
    return _mergers[key]


def doc_key(doc, seed: int) -> int:
    from xxhash import xxh64_intdigest
    return xxh64_intdigest(str(doc).encode("utf-8", "surrogatepass"), seed & _ALL)


def encode_many(docs: list, texts: list[str], path: str, seed: int, rate: float) -> list[bytes]:
    """Ids (little-endian, 32 bits) of each text; ``docs``: their document ids."""
    cut = [words(t) for t in texts]
    size = np.array([len(w) for w in cut], np.int64)
    upto = np.cumsum(size)
    place = np.arange(size.sum()) - np.repeat(upto - size, size)
    keys = _mix(np.repeat(np.array([doc_key(d, seed) for d in docs], np.uint64), size) + place.astype(np.uint64) * np.uint64(_A))
    ids = merger(path, seed, rate).cut([w for own in cut for w in own], keys)
    return [b"".join(ids[b - n:b]) for b, n in zip(upto.tolist(), size.tolist())]


def encoded(docs: DataFrame, path: str, seed: int = 1, rate: float = 0.1, with_ids: bool = True, check: bool = True) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, lossless[, ids]): ids as little-endian bytes;
    ``lossless``: the ids were decoded and gave the text back. Without ``check`` the
    column is ``source_hash`` (xxhash64 of the text), to hold against a later decoding."""
    def run(batches: Iterator[pd.DataFrame]):
        pieces = Pieces.of(path)
        for pdf in batches:
            texts = [t if isinstance(t, str) else "" for t in pdf["text"]]
            at = 0
            while at < len(texts):
                upto, chars = at, 0
                while upto < len(texts) and (upto == at or chars < CHARS_HELD):
                    chars += len(texts[upto])
                    upto += 1
                part = encode_many(pdf["doc_id"].iloc[at:upto].tolist(), texts[at:upto], path, seed, rate)
                out = pd.DataFrame({"doc_id": pdf["doc_id"].iloc[at:upto].to_numpy(), "n_tokens": [len(b) // 4 for b in part],
                                    "ids_crc32": [zlib.crc32(b) for b in part]})
                if check:
                    out["lossless"] = [pieces.text(np.frombuffer(b, "<u4").tolist()) == t for b, t in zip(part, texts[at:upto])]
                else:
                    out["source_hash"] = pdf["source_hash"].iloc[at:upto].to_numpy()
                yield out.assign(ids=part) if with_ids else out
                at = upto
    schema = "doc_id string, n_tokens long, ids_crc32 long, " + ("lossless boolean" if check else "source_hash long") + ", ids binary" * with_ids
    rows = with_text_ids(docs)
    if not check:
        rows = rows.withColumn("source_hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    return with_long_ids(rows.mapInPandas(run, schema))


def decoded(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (with ids as ``encoded`` gives them) with the decoded text; a batch is
    decoded and handed on in parts, as one holds thousands of texts."""
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(path)
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                texts, upto, n = [], at, 0
                while upto < batch.num_rows and (upto == at or n < IDS_HELD):
                    ids = np.frombuffer(batch["ids"][upto].as_py(), "<u4").tolist()
                    texts.append(pieces.text(ids))
                    n, upto = n + len(ids), upto + 1
                part = batch.slice(at, upto - at)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=[*part.schema.names, "text"])
                at = upto
    rows = rows.drop("text")
    return rows.mapInArrow(back, T.StructType([*rows.schema.fields, T.StructField("text", T.StringType())]))
