"""Connected components of a graph given as edges, by alternating large-star
and small-star steps. A step gives every edge the least neighbour of its node: an
aggregate of (node, salt) with partial results, the few parts of a node combined,
and a join on (node, salt), so the edges of a hub spread over the salts in both;
each round is stored in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covstar.llm.common import stored
from covstar.llm.grouping import with_totals


def _with_least(e: DataFrame) -> DataFrame:
    """Edges with m, the least of their u and all its neighbours v. The edges of
    a hub are dealt over salts by v, so no task reads all of them."""
    return with_totals(e, "u", "v", {"low": F.min("v")}, {"m": F.min("low")}).withColumn("m", F.least("m", "u"))


def _large_star(e: DataFrame) -> DataFrame:
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # a hub above its neighbours gets the same edge from each of them: folded before it is a key again
    return _with_least(both).filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(e: DataFrame) -> DataFrame:
    down = _with_least(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")))
    return down.select(F.col("v").alias("u"), F.col("m").alias("v")).union(down.select("u", F.col("m").alias("v")))


def components(edges: DataFrame, u: str, v: str) -> DataFrame:
    """(node, component) for every node of an edge; the component is its
    smallest node. Edges with a null end and loops are no edges."""
    e = edges.select(F.col(u).alias("u"), F.col(v).alias("v")).filter("u is not null and v is not null and u <> v").distinct()
    e, before = stored(e, "cc"), None
    while True:
        e = stored(_small_star(_large_star(e)).filter("u <> v").distinct(), "cc")
        now = e.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                    F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == before or now["n"] == 0:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
