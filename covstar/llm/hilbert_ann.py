"""Approximate nearest neighbours (largest inner product) on shifted
space-filling curves.

The vectors are projected on groups of principal directions of a bounded sample,
then on random directions, each projection is shifted by its own offset and
ordered along a Hilbert curve: one ordering for each projection. Spark
range-partitions and numbers every ordering; equal keys are ordered by a hash, so
a crowded key is cut like any other run of rows. The numbers cut an ordering into
segments of ``segment`` rows, and a query sees its own segment and half of each
neighbour: two segments of rows on every curve, whatever the size of the table.
The best of all windows merge, and are ranked by the exact product of the
original vectors.

The rows scored for a query are bounded (``CURVES`` x 2 x ``segment``, repeats
included), so work grows with the queries and shuffle with the rows. Recall then
depends on the data: vectors in clusters keep it at every size, vectors without
any structure lose it slowly as the table outgrows the windows (README figures).

Rows with equal vectors are one entry of the index with its ``k + 1`` smallest
ids: a further copy has that many equal rows before it in every answer, so it
can be in none, and copies cannot fill a window.

Results for odd input: vectors that are null, zero, hold null or non-finite
components or have a null id take no part; shorter vectors count as filled up
with zeros; a repeated row counts once; a lone vector gets no answer.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covstar.llm.common import spread, stored
from covstar.llm.vectors import SAMPLE, answers, sample_of, stack

CURVES, BITS = 32, 7
#: Rows of a segment of an ordering (a window is two), segments that a task meets at once.
SEGMENT, SEGMENTS = 768, 8
#: Rows of a key range, and candidates kept beyond k for the exact ranking.
RANGE, BEYOND = 1 << 18, 5


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers (``bits`` each),
    as a long: axes are turned level by level, then the bits interleaved."""
    x = cells.T.astype(np.int64)
    n = len(x)
    for level in range(bits - 1, 0, -1):
        q = 1 << level
        low = q - 1
        for i in range(n):
            high = (x[i] & q) > 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip = np.where((x[-1] >> level) & 1 > 0, flip ^ ((1 << level) - 1), flip)
    x ^= flip
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | (x[i] >> b) & 1
    return key


class Curves:
    """Projections, bounds and shifts of the orderings, from a sample."""

    def __init__(self, sample: np.ndarray, seed: int = 5):
        dim = sample.shape[1]
        self.mean = sample.mean(0) if len(sample) else np.zeros(dim)
        turns = np.linalg.svd(sample - self.mean, full_matrices=True)[2] if len(sample) > 1 else np.eye(dim)
        width = min(8, dim)
        rng = np.random.default_rng(seed)
        self.axes = [turns[c * width:(c + 1) * width].T if (c + 1) * width <= dim else np.linalg.qr(rng.normal(size=(dim, width)))[0]
                     for c in range(CURVES if dim else 0)]
        self.frames = []
        for a in self.axes:
            y = (sample - self.mean) @ a
            low, span = y.min(0), np.maximum(y.max(0) - y.min(0), 1e-9)
            self.frames.append((low - 0.5 * span * rng.random(len(low)), 1.5 * span))

    def keys(self, v: np.ndarray) -> list[np.ndarray]:
        out = []
        for a, (low, span) in zip(self.axes, self.frames):
            y = ((v - self.mean) @ a - low) / span * (1 << BITS)
            out.append(hilbert_keys(np.clip(y, 0, (1 << BITS) - 1).astype(np.int64), BITS))
        return out


def _entries(rows: DataFrame, is_query, k: int) -> tuple[DataFrame, DataFrame]:
    """Index entries (entry, v, ids, asked) by distinct vector, and the queries
    (query_id, asked_entry): one for each query id."""
    order = Window.partitionBy("v").orderBy("vec_id")
    first = (rows.distinct().withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
             .groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    entries = stored(first.join(asked.select("v").distinct().withColumn("asked", F.lit(True)), "v", "left")
                     .select(F.element_at("ids", 1).alias("entry"), "v", "ids", F.coalesce("asked", F.lit(False)).alias("asked")), "entries")
    queries = asked.join(entries.select("v", F.col("entry").alias("asked_entry")), "v").select(
        F.col("vec_id").alias("query_id"), "asked_entry")
    return entries, queries


def ranked(keys: DataFrame, ranges: int) -> DataFrame:
    """(curve, entry, rank): the place of each entry in the ordering of each
    curve, from its place in a key range and the rows of the ranges before."""
    tie = F.xxhash64("entry", F.lit(17))
    placed = stored(keys.withColumn("tie", tie).repartitionByRange(ranges, "curve", "key", "tie", "entry")
                    .sortWithinPartitions("curve", "key", "tie", "entry")
                    .select("curve", "entry", F.spark_partition_id().alias("part"),
                            F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")), "curves")
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = (placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
             .select("curve", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift")))
    return placed.join(sizes, ["curve", "part"]).select("curve", "entry", (F.col("at") + F.col("shift")).alias("rank"))


def nearest(rows: DataFrame, is_query, k: int = 20, segment: int = SEGMENT) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``rows`` (vec_id, v)
    that meets ``is_query`` the ``k`` best rows found, ties to the smaller id."""
    spark = rows.sparkSession
    rows = stored(rows, "vectors")
    entries, queries = _entries(rows, is_query, k)
    size = entries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dim"),
                       F.max(F.array_max(F.transform("v", F.abs))).alias("most")).first()
    n, dim = size["n"], size["dim"]
    # a power of two that brings every component to at most 1: products order alike
    unit = 2.0 ** -np.frexp(size["most"] or 1.0)[1]
    curves = Curves(stack(sample_of(entries.select(F.col("entry").alias("vec_id"), "v"), SAMPLE), dim) * unit)

    def keyed(batches):
        for pdf in batches:
            for c, key in enumerate(curves.keys(stack(pdf["v"], dim) * unit)):
                yield pd.DataFrame({"curve": c, "key": key, "entry": pdf["entry"]})

    def packed(batches):
        for pdf in batches:
            v = (stack(pdf["v"], dim) * unit).astype(np.float32)
            yield pd.DataFrame({"entry": pdf["entry"], "asked": pdf["asked"], "raw": [x.tobytes() for x in v]})

    places = ranked(entries.select("entry", "v").mapInPandas(keyed, "curve int, key long, entry long"),
                    max(spread(spark), -(-CURVES * n // RANGE)))
    block, half = segment * SEGMENTS, segment // 2
    # each row goes to the block of its place, and over its edge to the next one's windows
    held = (places.join(entries.select("entry", "v", "asked").mapInPandas(packed, "entry long, asked boolean, raw binary"), "entry")
            .withColumn("block", F.explode(F.sequence(F.greatest(F.lit(0), F.floor((F.col("rank") - half) / block)),
                                                      F.floor((F.col("rank") + half) / block)))))

    def met(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("rank")
        place, ids = pdf["rank"].to_numpy(), pdf["entry"].to_numpy()
        asks = pdf["asked"].to_numpy() & (place // block == pdf["block"].to_numpy())
        v = np.frombuffer(b"".join(pdf["raw"]), np.float32).reshape(len(pdf), dim)
        out = []
        for s in np.unique(place[asks] // segment):
            q = np.flatnonzero(asks & (place // segment == s))
            lo, hi = np.searchsorted(place, [s * segment - half, (s + 1) * segment + half])
            rough = v[q] @ v[lo:hi].T
            m = min(k + 1 + BEYOND, hi - lo)
            keep = np.argpartition(-rough, m - 1, axis=1)[:, :m]
            out.append(pd.DataFrame({"asked_entry": np.repeat(ids[q], m), "entry": ids[lo:hi][keep].ravel(),
                                     "rough": np.take_along_axis(rough, keep, 1).ravel()}))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame({"asked_entry": [], "entry": [], "rough": []})

    found = (held.repartition(max(spread(spark), -(-CURVES * n // (8 * block))), "curve", "block")
             .groupBy("curve", "block").applyInPandas(met, "asked_entry long, entry long, rough double"))
    # the windows of all orderings merge; of each query the best few are scored exactly
    best = Window.partitionBy("asked_entry").orderBy(F.desc("rough"), "entry")
    merged = (found.groupBy("asked_entry", "entry").agg(F.max("rough").alias("rough"))
              .withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k + 1 + BEYOND).drop("r"))
    product = F.aggregate(F.zip_with("v", "w", lambda x, y: F.coalesce(x * y, F.lit(0.0))), F.lit(0.0), lambda a, x: a + x)
    named = (merged.join(entries.select("entry", "ids", "v"), "entry")
             .join(entries.filter("asked").select(F.col("entry").alias("asked_entry"), F.col("v").alias("w")), "asked_entry")
             .select("asked_entry", product.alias("score"), F.explode("ids").alias("vec_id")))
    got = queries.join(named, "asked_entry").filter("query_id <> vec_id").select("query_id", "vec_id", "score")
    return answers(got, k)
