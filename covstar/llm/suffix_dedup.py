"""Removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if a ``MATCH``-byte string that covers it also starts earlier
(smaller document id, or same document and earlier start). To sort every suffix
of a corpus would cost many times its size, so the suffixes are thinned first
without losing a match:

1. Every string of ``MATCH`` bytes has one anchor, the ``GRAM``-byte window in it
   with the least hash; neighbouring strings share it. A run of strings with one
   anchor is a row (anchor hash, hash of the run's text). Equal runs repeat in
   whole; they are found first within a task, then by a shuffle on the anchor.
2. What is left are anchors with several different runs. Their texts (a few
   bytes more than ``MATCH`` each) are dealt out by anchor as new batches: the
   suffixes of a batch are put into a suffix array, merge-scanned against the
   levels of the index for matches of ``MATCH`` bytes, and join the index as a
   level of their own; levels of equal size merge, so that n suffixes lie in
   log n levels. Batches come in corpus order: what a level holds is earlier.
   Equal strings share their anchor, so an index takes the anchors of a partition
   until it has ``FAMILY`` texts and then makes room for the next.
3. An anchor with more than ``VARIANTS`` runs is dealt over several such indexes.
   The strings each of them found first meet once more, by hash of the string.

Results for odd input: a null or empty text has no bytes; rows that repeat both
id and text are one document and get its result each; rows with one id and other
texts are ordered by a hash of the text, rows without id come first.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covstar.llm.common import spread, stored

MATCH, GRAM = 100, 30
#: Bytes that a worker hashes at once, rows it holds before it sends them, rows it sends at once.
CHUNK, HELD, SENT = 1 << 18, 1 << 18, 1 << 14
#: Runs of one anchor that one index takes; texts of a batch; texts of an index, if whole slots give no fewer.
VARIANTS, BATCH, FAMILY = 512, 1024, 4096

_STEP = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


# ------------------------------------------------------------------ hashes

class Rolling:
    """Hashes, modulo 2^64, of any span of a byte array."""

    _tables: dict = {}

    def __init__(self, data: np.ndarray, which: int):
        need = max(CHUNK + MATCH, len(data)) + 1
        if which not in self._tables or len(self._tables[which][1]) < need:
            step, back = _STEP[which], np.uint64(pow(int(_STEP[which]), -1, 1 << 64))
            up, down = np.full(need, step), np.full(need, back)
            up[0] = down[0] = 1
            values = np.random.default_rng(which + 1).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
            self._tables[which] = values, np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        values, up, self.down = self._tables[which]
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * up[:len(data)], out=self.total[1:])

    def spans(self, start, end) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.down[start]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def least(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value (first, if equal) of every window of ``width``."""
    at = np.arange(len(values), dtype=np.int32)
    v, span = values, 1
    while span < width:
        step = min(span, width - span)
        take = v[step:] < v[:-step]
        at = np.where(take, at[step:], at[:-step])
        v = np.where(take, v[step:], v[:-step])
        span += step
    return at


def runs(data: np.ndarray, first: np.ndarray, last: np.ndarray):
    """Runs of neighbouring strings with one anchor. ``first``/``last``: span of
    each text in ``data``. Yields text number, start and end (of the string
    starts, inclusive, in ``data``), anchor hash, hash of the run's text."""
    if len(data) < MATCH:
        return [np.zeros(0, np.int64)] * 5
    roll, other = Rolling(data, 0), Rolling(data, 1)
    grams = np.arange(len(data) - GRAM + 1)
    anchor = least(mixed(roll.spans(grams, grams + GRAM)), MATCH - GRAM + 1)
    text = np.repeat(np.arange(len(first)), last - first)[:len(anchor)]
    own = np.flatnonzero(np.arange(len(anchor)) + MATCH <= last[text])
    if not len(own):
        return [np.zeros(0, np.int64)] * 5
    a, t = anchor[own], text[own]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (t[1:] != t[:-1]))))
    lo, hi, a, t = own[new], own[np.append(new[1:], len(own)) - 1], a[new].astype(np.int64), t[new]
    whole = other.spans(lo, hi + MATCH) + (a - lo).astype(np.uint64) * _STEP[0] + (hi - lo).astype(np.uint64) * _STEP[1]
    return t, lo, hi, mixed(roll.spans(a, a + GRAM)).view(np.int64), mixed(whole).view(np.int64)


def joined(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans merged where they meet or overlap."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, upto = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate(([True], start[1:] > upto[:-1])))
    return start[new], upto[np.append(new[1:], len(start)) - 1]


# ------------------------------------------------------ equal runs in whole

def _frame(gram, whole, doc, tie, lo, hi) -> pd.DataFrame:
    return pd.DataFrame({"gram": gram, "whole": whole, "doc": doc, "tie": tie, "lo": lo, "hi": hi})


def _first_of_each(rows: pd.DataFrame) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Rows (a run each) split into the first of every (gram, whole) and the later ones."""
    key = ["gram", "whole", "doc", "tie", "lo", "hi"]
    order = np.lexsort([rows[c] for c in reversed(key)])
    new, other = np.zeros((2, len(rows)), bool)        # differs from the row before: as a run, as a row
    for c in key:                                      # a column at a time: no copy of the rows
        v = rows[c].to_numpy()[order]
        other[1:] |= v[1:] != v[:-1]
        if c == "whole":
            new[:] = other
    new[:1] = True
    return rows.iloc[order[new]], rows.iloc[order[other & ~new]]


def _parts(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """The rows, ``SENT`` at a time: neither side holds a large batch."""
    for at in range(0, len(rows), SENT):
        yield rows.iloc[at:at + SENT]


def _spans_of(rows: pd.DataFrame) -> pd.DataFrame:
    """Rows of later runs as byte spans, merged within each document."""
    rows = rows.sort_values(["doc", "tie", "lo"])
    d, t = rows["doc"].to_numpy(), rows["tie"].to_numpy()
    lo, end = rows["lo"].to_numpy(), rows["hi"].to_numpy() + MATCH
    if not len(rows):
        return rows
    part = np.cumsum(np.concatenate(([0], (d[1:] != d[:-1]) | (t[1:] != t[:-1]))))
    far = part.astype(np.int64) << 40                  # documents far apart: none merge
    s, e = joined(lo + far, end + far)
    at = np.searchsorted(part, s >> 40)
    return pd.DataFrame({"doc": d[at], "tie": t[at], "start": s & (1 << 40) - 1, "end": e & (1 << 40) - 1})


def _runs_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Runs of the texts: first ones of this task's share (end = -1), and spans of later ones."""
    held, size = [], 0

    def send():
        rows = pd.concat(held, ignore_index=True)
        held.clear()
        first, later = _first_of_each(rows)
        del rows
        for part in _parts(first):
            yield part.assign(end=-1)
        for spans in _parts(_spans_of(later)):
            key = mixed(spans["doc"].to_numpy().view(np.uint64)).view(np.int64)
            yield _frame(key, 0, spans["doc"], spans["tie"], spans["start"], 0).assign(end=spans["end"])

    for part in _chunks(batches):
        docs, ties, offs, bufs = zip(*part)
        data = np.frombuffer(b"".join(bufs), np.uint8)
        last = np.cumsum([len(b) for b in bufs])
        first = np.concatenate(([0], last[:-1]))
        t, lo, hi, gram, whole = runs(data, first, last)
        if len(t):
            shift = (np.array(offs) - first)[t]
            held.append(_frame(gram, whole, np.array(docs)[t], np.array(ties)[t], lo + shift, hi + shift))
            size += len(t)
        if size > HELD:
            yield from send()
            size = 0
    if held:
        yield from send()


def _chunks(batches):
    """Texts as bytes, about CHUNK at a time; longer ones in slices that overlap
    by a string less a byte, so that each string start lies in one slice."""
    part, size = [], 0
    for pdf in batches:
        for doc, tie, text in zip(pdf["doc"], pdf["tie"], pdf["text"]):
            data = (text or "").encode("utf-8", "surrogatepass")
            for off in range(0, len(data) - MATCH + 1, CHUNK):
                piece = data[off:off + CHUNK + MATCH - 1]
                part.append((doc, tie, off, piece))
                size += len(piece)
                if size >= CHUNK:
                    yield part
                    part, size = [], 0
    if part:
        yield part


def _whole_runs(batches: Iterator[pd.DataFrame], variants: int) -> Iterator[pd.DataFrame]:
    """All rows of the anchors of this partition, sorted by anchor, run and place:
    spans of runs that came before in whole (slot = -1), and the first run of each
    text of an anchor with several texts, dealt over slots of ``variants`` runs.
    Rows stream: of one anchor at most ``variants`` wait until it is known whether
    it has one slot or more (dealt)."""
    key = ["gram", "whole", "doc", "tie", "lo"]
    waiting, last, sent = None, None, 0                # runs of the last anchor: waiting, its last row, runs sent

    def dealt(f, own, n, ready):
        size, place = f.groupby("gram")["gram"].transform("size") + n * own, f.groupby("gram").cumcount() + n * own
        out, many = ready & (size > 1), size > variants
        return pd.DataFrame({"doc": f["doc"], "tie": f["tie"], "start": f["lo"], "end": f["hi"] + MATCH, "gram": f["gram"],
                             "slot": place // variants, "dealt": many})[out]

    for pdf in batches:
        gone = pdf["end"].to_numpy() >= 0
        done, rows = pdf[gone], pdf[~gone]
        yield pd.DataFrame({"doc": done["doc"], "tie": done["tie"], "start": done["lo"], "end": done["end"], "gram": 0, "slot": -1, "dealt": False})
        if not len(rows):
            continue
        cells = rows[key].to_numpy(np.int64)
        before = np.vstack([cells[:1] if last is None else last, cells[:-1]])
        same = (cells == before).all(1)
        new = (cells[:, :2] != before[:, :2]).any(1)
        if last is None:
            same[0], new[0] = False, True
        later, first = rows[~new & ~same], rows[new]
        yield pd.DataFrame({"doc": later["doc"], "tie": later["tie"], "start": later["lo"], "end": later["hi"] + MATCH, "gram": 0, "slot": -1, "dealt": False})
        gram = None if last is None else last[0, 0]
        last = cells[-1:]
        first = first if waiting is None else pd.concat([waiting, first], ignore_index=True)
        own = first["gram"].to_numpy() == gram
        open_ = first["gram"].to_numpy() == last[0, 0]
        full = open_.sum() + (sent if gram == last[0, 0] else 0) > variants
        yield dealt(first, own, sent, ~open_ | full)
        waiting = None if full else first[open_]
        sent = (sent if gram == last[0, 0] else 0) + (open_.sum() if full else 0)
    if waiting is not None and len(waiting):
        yield dealt(waiting, np.ones(len(waiting), bool), sent, np.ones(len(waiting), bool))


# ------------------------------------------------------------ index family

class IndexFamily:
    """Levels of suffix arrays of strings of ``MATCH`` bytes; a level is sorted
    and holds each string once. Batches must come in corpus order."""

    def __init__(self):
        self.levels: list[np.ndarray] = []

    def add(self, strings: np.ndarray) -> np.ndarray:
        """Take a batch (in corpus order); whether each string came before."""
        order = np.argsort(strings, kind="stable")     # the batch's suffix array
        array = strings[order]
        new = np.concatenate(([True], array[1:] != array[:-1]))
        seen = np.zeros(len(array), bool)
        for level in self.levels:                      # merge-scan against each level
            at = np.searchsorted(level, array[new])
            found = level[np.minimum(at, len(level) - 1)] == array[new]
            seen[new] |= found
        known = np.repeat(seen[new], np.diff(np.append(np.flatnonzero(new), len(array))))
        before = np.empty(len(array), bool)
        before[order] = known | ~new
        fresh = array[new & ~seen]
        if len(fresh):
            self._push(fresh)
        return before

    def _push(self, level: np.ndarray) -> None:
        while self.levels and len(self.levels[-1]) <= 2 * len(level):
            other = self.levels.pop()
            both = np.concatenate([other, level])
            both.sort(kind="stable")                   # a merge: two sorted runs
            level = both
        self.levels.append(level)


def suffixes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every ``MATCH``-byte suffix prefix of the texts, with text number and place."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    n = np.array([len(t) - MATCH + 1 for t in texts])
    text = np.repeat(np.arange(len(texts)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.cumsum(n + MATCH - 1) - n - MATCH + 1
    view = np.lib.stride_tricks.sliding_window_view(data, MATCH)[start[text] + place]
    return np.ascontiguousarray(view).view(f"V{MATCH}").ravel().view(f"S{MATCH}"), text, place


def _families(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows, sorted by anchor and slot, as frames of whole slots: the first of at
    least ``FAMILY`` texts each."""
    held, size = [], 0
    for pdf in batches:
        held.append(pdf)
        size += len(pdf)
        if size < FAMILY:
            continue
        rows = pd.concat(held, ignore_index=True)
        g, s = rows["gram"].to_numpy(), rows["slot"].to_numpy()
        at = 0
        for end in (np.flatnonzero((g[1:] != g[:-1]) | (s[1:] != s[:-1])) + 1).tolist():
            if end - at >= FAMILY:
                yield rows.iloc[at:end]
                at = end
        held, size = [rows.iloc[at:]], len(rows) - at  # its last slot may go on
    if size:
        yield pd.concat(held, ignore_index=True)


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Strings of the runs of this partition (sorted by anchor and slot) that came
    before, as spans; of anchors that are dealt over several indexes, also the
    strings found first."""
    for rows in _families(batches):
        yield from _scanned(rows.sort_values(["doc", "tie", "start"], ignore_index=True))


def _scanned(rows: pd.DataFrame) -> Iterator[pd.DataFrame]:
    family = IndexFamily()
    for at in range(0, len(rows), BATCH):
        part = rows.iloc[at:at + BATCH]
        strings, text, place = suffixes(part["bytes"].tolist())
        before = family.add(strings)
        start = part["start"].to_numpy()[text] + place
        doc, tie = part["doc"].to_numpy()[text], part["tie"].to_numpy()[text]
        cut = np.flatnonzero(before)
        if len(cut):
            new = np.concatenate(([True], (text[cut][1:] != text[cut][:-1]) | (place[cut][1:] != place[cut][:-1] + 1)))
            a, b = cut[new], cut[np.append(np.flatnonzero(new)[1:], len(cut)) - 1]
            yield pd.DataFrame({"doc": doc[a], "tie": tie[a], "start": start[a], "end": start[b] + MATCH, "h": 0, "h2": 0, "open": False})
        also = np.flatnonzero(~before & part["dealt"].to_numpy()[text])
        if len(also):
            data = np.frombuffer(b"".join(part["bytes"]), np.uint8)
            size = part["bytes"].map(len).to_numpy()
            first = (np.cumsum(size) - size)[text[also]] + place[also]
            h, h2 = (mixed(Rolling(data, k).spans(first, first + MATCH)).view(np.int64) for k in (0, 1))
            yield pd.DataFrame({"doc": doc[also], "tie": tie[also], "start": start[also], "end": start[also] + MATCH, "h": h, "h2": h2, "open": True})


def _met_again(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held = [b for b in batches if len(b)]
    if held:
        rows = pd.concat(held, ignore_index=True).rename(columns={"h": "gram", "h2": "whole", "start": "lo"})
        later = _first_of_each(rows.assign(hi=rows["lo"])[["gram", "whole", "doc", "tie", "lo", "hi"]])[1]
        yield _spans_of(later)[["doc", "tie", "start", "end"]] if len(later) else pd.DataFrame({"doc": [], "tie": [], "start": [], "end": []})


# ------------------------------------------------------------------- Spark

def _keyed(docs: DataFrame) -> DataFrame:
    """Documents with the key (doc, tie) they are ordered by; ``tie`` counts only
    where ids are missing or repeat."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).agg(
        F.coalesce(F.max("n"), F.lit(0)).alias("most"), F.coalesce(F.max(F.col("doc_id").isNull()), F.lit(False)).alias("gaps")).first()
    plain = ids["most"] <= 1 and not ids["gaps"]
    tie = F.lit(0).cast("long") if plain else F.coalesce(F.xxhash64("text"), F.lit(0).cast("long"))
    return docs.withColumns({"dd_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")), "dd_tie": tie})


def repeated(docs: DataFrame, variants: int = VARIANTS) -> DataFrame:
    """``docs`` with dd_spans: start and end, in turn, of the byte spans that go
    (not merged). Rows and columns stay. ``variants``: runs of one anchor that
    one index takes."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    n = spread(spark)
    texts = keyed.select(F.col("dd_doc").alias("doc"), F.col("dd_tie").alias("tie"), "text")
    run_rows = texts.mapInPandas(_runs_of, "gram long, whole long, doc long, tie long, lo long, hi long, end long")
    marks = stored(run_rows.repartition(n, "gram").sortWithinPartitions("gram", "whole", "doc", "tie", "lo").mapInPandas(
        partial(_whole_runs, variants=variants), "doc long, tie long, start long, end long, gram long, slot long, dealt boolean"), "dedup-runs")
    # own names throughout: the documents may bring any columns
    by_doc = marks.groupBy(F.col("doc").alias("dd_d"), F.col("tie").alias("dd_t")).agg(
        F.flatten(F.collect_list(F.when(F.col("slot") < 0, F.array("start", "end")))).alias("dd_done"),
        F.flatten(F.collect_list(F.when(F.col("slot") >= 0, F.array("start", "end", "gram", "slot", F.col("dealt").cast("long"))))).alias("dd_open"))
    marked = keyed.join(by_doc, (F.col("dd_doc") == F.col("dd_d")) & (F.col("dd_tie") == F.col("dd_t")), "left").drop("dd_d", "dd_t")

    def run_texts(batches):
        columns, out = ["gram", "slot", "dealt", "doc", "tie", "start", "bytes"], []
        for pdf in batches:
            for doc, tie, text, found in zip(pdf["doc"], pdf["tie"], pdf["text"], pdf["open"]):
                data = text.encode("utf-8", "surrogatepass")
                for start, end, gram, slot, dealt in np.asarray(found, np.int64).reshape(-1, 5).tolist():
                    out.append((gram, slot, dealt > 0, doc, tie, start, data[start:end]))
                    if len(out) == SENT:
                        yield pd.DataFrame(out, columns=columns)
                        out = []
        if out:
            yield pd.DataFrame(out, columns=columns)

    # each text once, whatever number of rows repeat it
    open_runs = (marked.select(F.col("dd_doc").alias("doc"), F.col("dd_tie").alias("tie"), "text", F.col("dd_open").alias("open"))
                 .filter(F.size("open") > 0).dropDuplicates(["doc", "tie"])
                 .mapInPandas(run_texts, "gram long, slot long, dealt boolean, doc long, tie long, start long, bytes binary"))
    scanned = stored(open_runs.repartition(n, "gram", "slot").sortWithinPartitions("gram", "slot").mapInPandas(
        _scan, "doc long, tie long, start long, end long, h long, h2 long, open boolean"), "dedup-scan")
    again = scanned.filter("open").repartition(n, "h", "h2").mapInPandas(_met_again, "doc long, tie long, start long, end long")
    more = (scanned.filter("not open").select("doc", "tie", "start", "end").union(again)
            .groupBy(F.col("doc").alias("dd_d"), F.col("tie").alias("dd_t"))
            .agg(F.flatten(F.collect_list(F.array("start", "end"))).alias("dd_more")))
    out = marked.join(more, (F.col("dd_doc") == F.col("dd_d")) & (F.col("dd_tie") == F.col("dd_t")), "left")
    none = F.array().cast("array<long>")
    spans = F.concat(F.coalesce("dd_done", none), F.coalesce("dd_more", none))
    return out.select(*docs.columns, spans.alias("dd_spans"))


def _merged(flat) -> tuple[np.ndarray, np.ndarray]:
    pairs = np.asarray(flat, np.int64).reshape(-1, 2)
    return joined(pairs[:, 0], pairs[:, 1])


def without(data: bytes, start, end) -> bytes:
    at, kept = 0, []
    for s, e in zip(start.tolist(), end.tolist()):
        kept.append(data[at:s])
        at = e
    kept.append(data[at:])
    return b"".join(kept)


def _digest(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, spans in batches:
        out = []
        for text, flat in zip(texts, spans):
            data = (text or "").encode("utf-8", "surrogatepass")
            start, end = _merged(flat)
            out.append((len(data), int((end - start).sum()), len(start), hashlib.sha256(without(data, start, end)).hexdigest()))
        yield pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kept(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """The text without its spans; a character that a span cuts stays whole."""
    for texts, spans in batches:
        out = []
        for text, flat in zip(texts, spans):
            start, end = _merged(flat)
            if text is not None and len(start):
                data = text.encode("utf-8", "surrogatepass")
                raw = np.frombuffer(data + b" ", np.uint8)
                inside = (raw & 0xC0) == 0x80
                while inside[start].any():
                    start = start + inside[start]
                while inside[end].any():
                    end = end - inside[end]
                text = without(data, start, np.maximum(start, end)).decode("utf-8", "surrogatepass")
            out.append(text)
        yield pd.Series(out, dtype=object)


def digest(found: DataFrame) -> Column:
    return F.pandas_udf(_digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")("text", "dd_spans")


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated passages removed from the texts."""
    return repeated(docs).withColumn("text", F.pandas_udf(_kept, "string")("text", "dd_spans")).drop("dd_spans")
