"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints (64 bits) of all documents are folded to distinct ones first. A
link needs 3 or fewer differing bits, so with the bits cut into five blocks two
fingerprints of a link agree on at least two of them: each distinct fingerprint
is filed under the ten pairs of blocks, and Spark groups the files by the bits
of the pair. Inside a task the codes of a group are sorted by Gray rank; codes
with the same leading bits are then neighbours and form the nodes of an index
whose upper nodes hold the shared masked pattern. Pairs of nodes descend
together: the differences of the masked parts are accumulated, and a pair of
nodes with more than the maximum is dropped with everything below it.

A group with more than ``BLOCK`` codes is dealt into blocks, and each pair of
blocks is a file of its own, so no task holds a large group and no link is lost.

Results for odd input: a null or empty text has fingerprint zero and is linked
like any other; repeated rows each keep their row; rows with a null ``doc_id``
get their component from the other rows with the fingerprint (null, if none).
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covstar.llm.common import spread, stored, with_long_ids, with_text_ids
from covstar.llm.components import components

#: Sizes of the five blocks of bits, from the highest bit.
BLOCK_BITS = (13, 13, 13, 13, 12)
#: Bits below the shared key, by level of the index.
LEVEL_BITS = 10
#: Codes of one group that one file may hold.
BLOCK = 2048
#: Node pairs that are expanded at once in a task.
FRONTIER = 1 << 20


# ------------------------------------------------------------ fingerprints

def fingerprint_many(texts: list[str | None], width: int = 3, seed: int = 42) -> np.ndarray:
    """Fingerprints (uint64) of whole texts: A-Z in lower case, words between
    ASCII white space, shingles of ``width`` words with repeats (fewer words:
    all of them), XXH64; a bit is set if over half the hashes have it."""
    from xxhash import xxh64_intdigest
    out = np.zeros(len(texts), np.uint64)
    hashes, sizes, rows = [], [], []
    pending = 0

    def flush():
        if not rows:
            return
        h = np.concatenate(hashes)
        n = np.array(sizes)
        at = np.concatenate(([0], np.cumsum(n)[:-1]))
        fp = np.zeros(len(n), np.uint64)
        for b in range(64):
            ones = np.add.reduceat((h >> np.uint64(b)) & np.uint64(1), at)
            fp |= (2 * ones > n.astype(np.uint64)).astype(np.uint64) << np.uint64(b)
        out[rows] = fp
        hashes.clear(), sizes.clear(), rows.clear()

    for i, text in enumerate(texts):
        words = text.encode("utf-8", "surrogatepass").lower().split() if text else ()
        if not words:
            continue
        line = b" ".join(words)
        if len(words) <= width:
            got = [xxh64_intdigest(line, seed)]
        else:
            ends = np.cumsum([len(w) + 1 for w in words])
            starts = [0, *ends[:-width].tolist()]
            got = [xxh64_intdigest(line[s:e], seed) for s, e in zip(starts, (ends[width - 1:] - 1).tolist())]
        hashes.append(np.array(got, np.uint64))
        sizes.append(len(got))
        rows.append(i)
        pending += len(got)
        if pending > 1_000_000:
            flush()
            pending = 0
    flush()
    return out


def fingerprints(docs: DataFrame, width: int = 3) -> DataFrame:
    """(doc_id, fp) with ``fp`` the 64 bits as a long."""
    def run(batches):
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at:at + 512]
                yield pd.DataFrame({"doc_id": part["doc_id"], "fp": fingerprint_many(part["text"].tolist(), width).view(np.int64)})
    return with_long_ids(with_text_ids(docs).mapInPandas(run, "doc_id string, fp long"))


# ------------------------------------------------------------------ index

def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Place of each code in the reflected Gray sequence."""
    rank = codes.copy()
    for s in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(s)
    return rank


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where a new value of the sorted keys begins."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
    return np.flatnonzero(new)


def linked_pairs(group: np.ndarray, codes: np.ndarray, top_bits: np.ndarray, most: int):
    """Yield (i, j) arrays of the pairs of codes of one group with ``most`` or
    fewer differing bits. ``group``, then Gray rank of ``codes`` are sorted;
    ``top_bits``: how many leading bits a group shares (by row)."""
    n = len(codes)
    levels = [_starts(group)]                       # first row of each node, by level
    depth = int(top_bits.min()) if n else 64
    cuts = [*range(depth, 64, LEVEL_BITS), 64]
    for bits in cuts[1:]:
        levels.append(_starts(group, codes >> np.uint64(64 - bits)) if bits < 64 else np.arange(n))
    spans = []                                       # first child of each node
    for up, down in zip(levels, levels[1:]):
        first = np.searchsorted(down, up)
        spans.append((first, np.append(first[1:], len(down))))
    nodes = np.arange(len(levels[0]))
    todo = [(0, nodes, nodes, np.zeros(len(nodes), np.uint8))]
    while todo:
        level, a, b, acc = todo.pop()
        if level == len(levels) - 1:
            keep = a < b
            if keep.any():
                yield a[keep], b[keep]
            continue
        first, last = spans[level]
        na, nb = last[a] - first[a], last[b] - first[b]
        size = na * nb
        total = np.cumsum(size)
        if total[-1] > FRONTIER and len(a) > 1:
            cut = max(1, int(np.searchsorted(total, total[-1] // 2)))
            todo += [(level, a[cut:], b[cut:], acc[cut:]), (level, a[:cut], b[:cut], acc[:cut])]
            continue
        pair = np.repeat(np.arange(len(a)), size)
        k = np.arange(total[-1]) - np.repeat(total - size, size)
        ca, cb = first[a][pair] + k // nb[pair], first[b][pair] + k % nb[pair]
        keep = ca <= cb                              # a pair of one node with itself is met twice below
        ca, cb, pair = ca[keep], cb[keep], pair[keep]
        lo, hi = cuts[level], cuts[level + 1]
        diff = (codes[levels[level + 1][ca]] ^ codes[levels[level + 1][cb]]) >> np.uint64(64 - hi)
        diff &= np.uint64((1 << (hi - lo)) - 1)
        got = acc[pair] + np.bitwise_count(diff)
        keep = got <= most
        if keep.any():
            todo.append((level + 1, ca[keep], cb[keep], got[keep]))


def roots(n: int, pairs) -> np.ndarray:
    """Smallest index reachable from each of ``n`` places over the pairs."""
    parent = np.arange(n)

    def find(x):
        while True:
            up = parent[x]
            if (up == parent[up]).all():
                return up
            parent[x] = parent[up]

    for a, b in pairs:
        while len(a):
            ra, rb = find(a), find(b)
            lo, hi = np.minimum(ra, rb), np.maximum(ra, rb)
            open_ = lo != hi
            if not open_.any():
                break
            np.minimum.at(parent, hi[open_], lo[open_])
            a, b = a[open_], b[open_]
    while (parent != parent[parent]).any():
        parent = parent[parent]
    return parent


def _edges_of(pdf: pd.DataFrame, most: int) -> pd.DataFrame:
    """Spanning edges (by representative) of the linked codes of each file."""
    files = pd.factorize(pd.MultiIndex.from_frame(pdf[["t", "k", "p"]]))[0] if len(pdf) else np.zeros(0, int)
    code = pdf["code"].to_numpy().view(np.uint64)
    order = np.lexsort((gray_rank(code), files))
    files, code, rep = files[order], code[order], pdf["rep"].to_numpy()[order]
    shared = _shared_bits()[pdf["t"].to_numpy()[order]]
    root = roots(len(code), linked_pairs(files, code, shared, most))
    out = pd.DataFrame({"root": root, "rep": rep})
    out["to"] = out.groupby("root")["rep"].transform("min")
    return out.loc[out.rep != out.to, ["rep", "to"]].rename(columns={"rep": "u", "to": "v"}).drop_duplicates()


def _tables() -> list[tuple[int, int]]:
    return list(combinations(range(len(BLOCK_BITS)), 2))


def _shared_bits() -> np.ndarray:
    return np.array([BLOCK_BITS[i] + BLOCK_BITS[j] for i, j in _tables()])


def _arranged(fp: Column, first: tuple[int, int]) -> tuple[Column, int]:
    """The bits with the two blocks of a table in front; how many those are."""
    low = [sum(BLOCK_BITS[i + 1:]) for i in range(len(BLOCK_BITS))]
    order = [*first, *(i for i in range(len(BLOCK_BITS)) if i not in first)]
    left, out = 64, F.lit(0).cast("long")
    for i in order:
        left -= BLOCK_BITS[i]
        part = F.shiftrightunsigned(fp, low[i]).bitwiseAND(F.lit((1 << BLOCK_BITS[i]) - 1).cast("long"))
        out = out.bitwiseOR(F.shiftleft(part, left))
    return out, BLOCK_BITS[first[0]] + BLOCK_BITS[first[1]]


def links(fps: DataFrame, most: int = 3) -> DataFrame:
    """Edges (u, v) between representatives of distinct fingerprints (fp, rep)
    that span every group of fingerprints linked by ``most`` or fewer bits."""
    if not 0 <= most <= 3:
        raise ValueError("the five blocks of bits find links of 3 or fewer differing bits")
    spark = fps.sparkSession
    filed = fps.select("rep", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), code.alias("code"), F.shiftrightunsigned(code, 64 - n).alias("k"))
        for t, (code, n) in enumerate(_arranged(F.col("fp"), p) for p in _tables())])).alias("x")).select("rep", "x.*")
    sizes = filed.groupBy("t", "k").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("code"), F.col("blocks").cast("long")).cast("int")
    parts = (filed.join(sizes, ["t", "k"]).withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.least("own", "other").cast("long") * 1_000_000 + F.greatest("own", "other"))
             .select("t", "k", "p", "code", "rep"))

    def run(batches):
        held = [b for b in batches if len(b)]
        if held:
            yield _edges_of(pd.concat(held, ignore_index=True), most)

    return parts.repartition(spread(spark), "t", "k", "p").mapInPandas(run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, width: int = 3, most: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) of every row: the component is the smallest
    ``doc_id`` reachable over links of ``most`` or fewer differing bits."""
    prints = stored(fingerprints(docs, width), "simhash")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("rep")), "simhash-classes")
    found = components(links(classes.filter("rep is not null"), most), "u", "v")
    labels = classes.join(found, classes.rep == found.node, "left").select(
        F.col("fp").alias("l_fp"), F.coalesce("component", "rep").alias("component_id"))
    return prints.join(labels, prints.fp == F.col("l_fp"), "left").select("doc_id", "fp", "component_id")
