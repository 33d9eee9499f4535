"""Best-fit packing by minimum bin slack.

Documents become token pieces of at most ``size`` tokens. What a bin may hold
depends on lengths only, so the bins are planned on the histogram of piece
lengths (at most ``size`` rows, whatever the corpus): the largest length left
opens a bin, a subset-sum dynamic program over bitsets (one Python integer per
step, a bit for each reachable fill) finds the fullest feasible combination of
the lengths available, and the combination is removed as often as the counts
allow, since it stays the fullest until one of its lengths runs out. The plan is
a short table of (length, ranks, first sequence, offset). Pieces get their rank
within their length from a window over (length, part) plus the counts of the
parts before, so a length that a third of all pieces share is dealt over parts.

Results for odd input: a null or empty text is one piece holding the end token;
rows repeated or with a null ``doc_id`` are packed like any other.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covstar.llm.common import spread, stored, with_long_ids, with_text_ids

#: Distinct words whose ids a worker remembers.
WORDS_KEPT = 150_000
#: Texts that hold one of these are encoded whole: white space runs and special tokens cross the cuts at blanks.
_SPACES = "\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f \x85\xa0                　"
_WHOLE = ("<|endoftext|>", *(c + " " for c in _SPACES))
_encoders: dict[tuple, "Encoder"] = {}


class Encoder:
    """Ids of whole texts by a byte-level BPE file. Such a tokenizer cuts before
    a blank that follows other text, so the ids of a text are those of its
    blank-led words in turn, and a worker encodes each distinct word once.
    ``ranks``: the same vocabulary as a file of ranks, quicker on single words."""

    def __init__(self, path: str, ranks: str | None, pattern: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.path, self.tokenizer = path, None         # read when a text first needs it
        self.known: dict[str, bytes] = {}              # word -> ids of the word after a blank
        self.word = self._whole
        if ranks:
            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            ordinary = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={}).encode_ordinary
            self.word = lambda text: array("I", ordinary(text)).tobytes()

    @staticmethod
    def of(*files) -> "Encoder":
        if files not in _encoders:
            _encoders[files] = Encoder(*files)
        return _encoders[files]

    def _whole(self, text: str) -> bytes:
        if self.tokenizer is None:
            from tokenizers import Tokenizer
            self.tokenizer = Tokenizer.from_file(self.path)
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids of a text."""
        if any(x in text for x in _WHOLE):
            return self._whole(text)
        head, *words = text.split(" ")
        try:
            return self.word(head) + b"".join(map(self.known.__getitem__, words))
        except KeyError:
            if len(self.known) > WORDS_KEPT:
                self.known = {}
            for w in set(words).difference(self.known):
                self.known[w] = self.word(" " + w)
            return self.word(head) + b"".join(map(self.known.__getitem__, words))


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` tokens: only the first may be shorter than ``size``."""
    first = n % size or size
    return [(0, min(n, first))] + [(s, size) for s in range(first, n, size)]


def pieces(docs: DataFrame, tokenizer: str, ranks: str | None = None, pattern: str | None = None,
           size: int = 2048, end: int = 0, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's ids
    by the tokenizer file followed by ``end``; ``ids``: little-endian bytes.
    ``ranks`` and ``pattern``: the same vocabulary as ranks, with its word pattern."""
    tail = np.array([end], "<u4").tobytes()

    def run(batches):
        enc = Encoder.of(tokenizer, ranks, pattern)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids]

        def frame(rows):
            return pd.DataFrame(rows, columns=names)

        rows, held = [], 0
        for pdf in batches:
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                ids = (enc.encode(text) if isinstance(text, str) else b"") + tail
                for i, (start, n) in enumerate(cut(len(ids) // 4, size)):
                    own = ids[4 * start:4 * (start + n)]
                    rows.append((doc, i, start, n, zlib.crc32(own), own)[:5 + with_ids])
                held += len(ids)
                if held > 32_000_000 or len(rows) > 10_000:
                    yield frame(rows)
                    rows, held = [], 0
        if rows:
            yield frame(rows)

    schema = "doc_id string, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    return with_long_ids(with_text_ids(docs).mapInPandas(run, schema))


# ------------------------------------------------------------------- plan

def fullest(available: list[tuple[int, int]], room: int) -> dict[int, int]:
    """Of (length, count), longest first: the combination that fills ``room``
    best, as length -> how many. Bit b of the integer: a fill of b is reachable."""
    reach, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length, count in available:
        if length > room:
            continue
        left, k = min(count, room // length), 1
        while left:                               # 1, 2, 4, ... of a length reach every number of it
            take = min(k, left)
            steps.append((length, take, reach))
            reach |= (reach << (length * take)) & mask
            left, k = left - take, 2 * k
        if reach >> room:
            break
    fill, chosen = reach.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            fill -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


def plan(counts: dict[int, int], size: int) -> pd.DataFrame:
    """The bins: rows (length, rank, each, times, sequence, offset) saying that
    from ``rank`` on, ``each`` pieces of the length go into each of ``times``
    sequences from ``sequence`` on, at ``offset``."""
    left = {n: c for n, c in counts.items() if c > 0}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        first = max(left)
        rest = sorted(((n, c - (n == first)) for n, c in left.items() if c - (n == first) > 0), reverse=True)
        bin_ = fullest(rest, size - first)
        bin_[first] = bin_.get(first, 0) + 1
        times = min(left[n] // k for n, k in bin_.items())
        offset = 0
        for n, k in sorted(bin_.items(), reverse=True):
            rows.append((n, used[n], k, times, sequence, offset))
            offset += n * k
            used[n] += k * times
            left[n] -= k * times
            if not left[n]:
                del left[n]
        sequence += times
    return pd.DataFrame(rows, columns=["length", "rank", "each", "times", "sequence", "offset"]).sort_values(["length", "rank"])


def pack(piece_rows: DataFrame, size: int = 2048) -> DataFrame:
    """``piece_rows`` (as ``pieces`` returns them) with sequence_id and offset."""
    spark = piece_rows.sparkSession
    parts = spread(spark)
    rows = stored(piece_rows.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int")), "pieces")
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    bins = plan({r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}, size)
    by_length = {n: g.to_numpy() for n, g in bins.groupby("length")}
    place = spark.sparkContext.broadcast(by_length)          # bounded by ``size``, not by the corpus
    columns = [c for c in rows.columns if c != "part"]

    def placed(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for lengths, ranks in batches:
            length, rank = lengths.to_numpy(), ranks.to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                own = np.flatnonzero(length == n)
                p = place.value[n]
                p = p[np.searchsorted(p[:, 1], rank[own], "right") - 1]
                j = rank[own] - p[:, 1]
                sequence[own] = p[:, 4] + j // p[:, 2]
                offset[own] = p[:, 5] + j % p[:, 2] * n
            yield pd.DataFrame({"sequence_id": sequence, "offset": offset})

    order = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32", "start")
    ranked = rows.withColumn("own", F.row_number().over(order)).join(before, ["length", "part"])
    at = F.pandas_udf(placed, "sequence_id long, offset long")("length", F.col("before") + F.col("own") - 1)
    return ranked.select(*columns, at.alias("at")).select(*columns, "at.sequence_id", "at.offset")
