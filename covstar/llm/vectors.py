"""Steps shared by the two searches: vectors that take part, bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of the sample that pivots, projections and key bounds are fitted on.
SAMPLE = 4096


def usable(rows: DataFrame, zero: bool) -> DataFrame:
    """(vec_id, v array<double>) without null ids, null vectors, null or
    non-finite components, and without zero vectors unless ``zero``."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    out = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"), bad.alias("bad"))
           .filter("vec_id is not null and v is not null and not bad"))
    if not zero:
        out = out.filter(F.exists("v", lambda x: x != 0))
    return out.select("vec_id", "v")


def sample_of(rows: DataFrame, size: int = SAMPLE) -> np.ndarray:
    """The vectors with the smallest hashes of their ids; at most ``size``."""
    got = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(size).collect()
    return stack([r["v"] for r in got], max((len(r["v"]) for r in got), default=0))


def stack(vs, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vs), dim))
    for row, v in zip(out, vs):
        row[:len(v)] = v
    return out


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the ``k`` highest scores, ties to the smaller id."""
    order = np.lexsort((ids, -scores), axis=-1)[:, :k]
    return np.take_along_axis(scores, order, 1), np.take_along_axis(ids, order, 1)


def answers(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows (query_id, vec_id, score) of each query, ranked."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
