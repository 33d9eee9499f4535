"""Exact top-k inner products by dual-tree search over cover trees.

Rows are given to the nearest of a few pivots, then dealt into blocks of bounded
size, so equal vectors spread over blocks too; queries likewise. Each block gets
a cover tree: a node has a centre, its points lie within a covering radius, and
its children cover them at a smaller scale. A pair of a query node (q, radius a)
and a row node (r, radius b) can hold no product above q.r + a|r| + b|q| + ab;
it is dropped with all below it when that lies under the worst kth score of the
node's queries.

The same bound prunes pairs of blocks before anything large moves. A block is
known by a few balls that cover it (centres and radii). Every query block first
searches the row blocks whose balls suit its own best, which gives each of its
queries a kth score to beat. Pairs of blocks are then judged by their balls, cell
by cell, and only pairs whose bound reaches the worst of these scores go on. Row
blocks are dealt in runs to tasks, each tree once; a query block goes once to
every task in which it has a pair left, with its scores to beat.

The query set is a stated share of the rows; it meets the rows block by block.

Results for odd input: vectors that are null, hold null or non-finite
components or have a null id take no part; shorter vectors count as filled up
with zeros; rows that repeat a ``vec_id`` are all candidates, except for the
queries of that id; a query without candidates returns no row.
"""

from __future__ import annotations

import pickle

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from covstar.llm.common import spread, stored
from covstar.llm.vectors import answers, best_of, sample_of, stack, usable

#: Rows of a block, queries of a block, points of a leaf.
ROWS, QUERIES, LEAF = 2048, 1024, 96
#: Factor between the scales of two levels of a cover tree.
BASE = 1.3
PIVOTS = 256
#: Balls that a block is known by, row blocks of a task at most, and blocks of
#: either side whose pairs are judged at once.
NODES, GROUP, CELL = 8, 64, 256


# ------------------------------------------------------------------- tree

class CoverTree:
    """Points in tree order with, for each node, centre, covering radius, span
    of points and span of children (leaves have none)."""

    def __init__(self, ids: np.ndarray, points: np.ndarray):
        order, placed, queue = [], 0, []
        self.centre, self.radius, self.span, self.children = [], [], [], []
        self._add(points, np.arange(len(points)), points.mean(0))
        queue.append((0, np.arange(len(points))))
        while queue:
            node, own = queue.pop()
            radius = self.radius[node]
            parts = self._cover(points, own, self.centre[node], radius / BASE) if len(own) > LEAF and radius > 0 else None
            if parts is None:
                self.span[node] = own
                continue
            first = len(self.centre)
            for centre, part in parts:
                self._add(points, part, centre)
                queue.append((len(self.centre) - 1, part))
            self.children[node] = (first, len(self.centre))
        # points in depth-first order, so that every node is a run of them
        spans = [None] * len(self.centre)
        stack_ = [(0, False)]
        while stack_:
            node, done = stack_.pop()
            first, last = self.children[node]
            if first == last:
                spans[node] = (placed, placed + len(self.span[node]))
                order.append(self.span[node])
                placed += len(self.span[node])
            elif done:
                spans[node] = (spans[first][0], placed)
            else:
                stack_ += [(node, True)] + [(c, False) for c in range(last - 1, first - 1, -1)]
        order = np.concatenate(order)
        self.ids, self.points, self.span = ids[order], points[order], spans
        self.centre, self.radius = np.stack(self.centre), np.array(self.radius)

    def _add(self, points, own, centre):
        self.centre.append(centre)
        self.radius.append(float(np.sqrt(((points[own] - centre) ** 2).sum(1).max())))
        self.span.append(None)
        self.children.append((0, 0))

    @staticmethod
    def _cover(points, own, centre, reach):
        """Children that cover the points at the smaller scale, each centre more
        than ``reach`` from those before; points that stay alone share a leaf."""
        left, parts, alone = own, [], []
        middle = centre
        while len(left):
            d = np.sqrt(((points[left] - middle) ** 2).sum(1))
            near = d <= reach
            if not near.any() and not parts and middle is centre:
                middle = points[left[np.argmin(d)]]
                continue
            part = left[near]
            if len(part) >= LEAF // 8:
                parts.append((middle, part))
            else:
                alone.append(part)
            left, d = left[~near], d[~near]
            if len(left):
                middle = points[left[np.argmax(d)]]
            if len(parts) + len(alone) > 64:
                alone.append(left)
                break
        if alone:
            alone = np.concatenate(alone)
            if len(alone) == len(own):
                return None
            if len(alone):
                parts.append((centre, alone))
        return parts if len(parts) > 1 else None


def most_products(q, q_radius, r, r_radius) -> np.ndarray:
    """Greatest product between points within the radii of each pair of centres."""
    qn, rn = np.sqrt((q ** 2).sum(1)), np.sqrt((r ** 2).sum(1))
    return (q @ r.T + np.outer(q_radius, rn) + np.outer(qn, r_radius) + np.outer(q_radius, r_radius)) * (1 + 1e-12) + 1e-6


def bounds(q: CoverTree, r: CoverTree) -> np.ndarray:
    """Greatest product that each pair of nodes can hold."""
    return most_products(q.centre, q.radius, r.centre, r.radius)


class Best:
    """Running ``k`` best of each query of a tree, at or above its score to beat."""

    def __init__(self, n: int, k: int, floor: np.ndarray | None = None):
        self.k = k
        self.floor = np.full(n, -np.inf) if floor is None else floor
        self.scores, self.ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)

    def worst(self, span) -> float:
        return np.maximum(self.scores[span[0]:span[1], -1], self.floor[span[0]:span[1]]).min()

    def take(self, at: int, scores: np.ndarray, ids: np.ndarray) -> None:
        to_beat = np.maximum(self.scores[at:at + len(scores), -1], self.floor[at:at + len(scores)])
        rows = np.flatnonzero((scores >= to_beat[:, None]).any(1) & np.isfinite(scores).any(1))
        if len(rows):
            s, i = scores[rows], np.broadcast_to(ids, scores.shape)[rows]
            if s.shape[1] > 2 * self.k:               # ties of the kth score stay in
                cut = np.partition(s, -self.k, axis=1)[:, -self.k]
                wide = int((s >= cut[:, None]).sum(1).max())
                part = np.argpartition(-s, min(wide, s.shape[1]) - 1, axis=1)[:, :wide]
                s, i = np.take_along_axis(s, part, 1), np.take_along_axis(i, part, 1)
            s, i = best_of(np.hstack([self.scores[at + rows], s]), np.hstack([self.ids[at + rows], i]), self.k)
            self.scores[at + rows], self.ids[at + rows] = s, i


def search(q: CoverTree, r: CoverTree, best: Best) -> None:
    """Dual-tree descent: the best of every query of ``q`` among the rows of ``r``."""
    most = bounds(q, r)
    todo = [(0, 0)]
    while todo:
        a, b = todo.pop()
        if most[a, b] < best.worst(q.span[a]):
            continue
        qc, rc = q.children[a], r.children[b]
        if qc[0] == qc[1] and rc[0] == rc[1]:
            (q0, q1), (r0, r1) = q.span[a], r.span[b]
            scores = q.points[q0:q1] @ r.points[r0:r1].T
            scores[q.ids[q0:q1, None] == r.ids[None, r0:r1]] = -np.inf
            best.take(q0, scores, r.ids[r0:r1])
        elif rc[0] == rc[1] or (qc[0] != qc[1] and q.radius[a] > r.radius[b]):
            todo += [(c, b) for c in range(*qc)]
        else:
            todo += [(a, rc[0] + c) for c in np.argsort(most[a, rc[0]:rc[1]], kind="stable")]


# ------------------------------------------------------------------- Spark

def pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Far-apart vectors of the sample, the farthest from all before next."""
    if not len(sample):
        return sample
    chosen, d = [0], ((sample - sample[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(sample)) and d.max() > 0:
        chosen.append(int(d.argmax()))
        d = np.minimum(d, ((sample - sample[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def cover(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """At most ``NODES`` balls around all points: the ball of each point, centres, radii."""
    far = pivots(points, NODES)
    of = ((far ** 2).sum(1) - 2 * points @ far.T).argmin(1)
    of = np.unique(of, return_inverse=True)[1]
    centres = np.stack([points[of == c].mean(0) for c in range(of.max() + 1)])
    d = np.sqrt(((points - centres[of]) ** 2).sum(1))
    return of, centres, np.array([d[of == c].max() for c in range(len(centres))])


def _blocks(rows: DataFrame, centres: np.ndarray, size: int, dim: int, name: str) -> tuple[DataFrame, int]:
    """(block, centres, radii, tree): a cover tree for each block of at most
    about ``size`` rows around a pivot, numbered pivot by pivot; their number."""
    def near(batches):
        for pdf in batches:
            v = stack(pdf["v"], dim)
            pdf["pivot"] = ((centres ** 2).sum(1) - 2 * v @ centres.T).argmin(1) if len(pdf) else []
            yield pdf

    def built(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        t = CoverTree(pdf["vec_id"].to_numpy(), stack(pdf["v"], dim))
        _, centres, radii = cover(t.points)
        return pd.DataFrame({"block": [first[pdf["pivot"].iloc[0]] + pdf["slot"].iloc[0]], "centres": [list(centres)],
                             "radii": [radii], "tree": [pickle.dumps(t)]})

    placed = rows.mapInPandas(near, "vec_id long, v array<double>, pivot int")
    slots, first, total = {}, {}, 0                   # as many figures as pivots
    for r in placed.groupBy("pivot").agg(F.count(F.lit(1)).alias("n")).orderBy("pivot").collect():
        slots[r["pivot"]], first[r["pivot"]] = -(-r["n"] // size), total
        total += slots[r["pivot"]]
    of = F.create_map(*[F.lit(x) for kv in slots.items() for x in kv]) if slots else F.lit(None).cast("map<int,int>")
    slot = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.element_at(of, F.col("pivot")).cast("long")).cast("int")
    return stored(placed.withColumn("slot", slot).groupBy("pivot", "slot").applyInPandas(
        built, "block long, centres array<array<double>>, radii array<double>, tree binary"), name), total


def _pairs(queries: DataFrame, query_cells: int, rows: DataFrame, row_cells: int, judge) -> DataFrame:
    """(query, node, block, most): what ``judge`` keeps, cell by cell, from the
    nodes of the blocks (and ``worst`` of the query nodes); no tree is read."""
    cells = lambda side, own, other, n: side.withColumn(own, F.floor(F.col("block") / CELL)).withColumn(
        other, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(1, n) - 1).cast("long"))))
    q = cells(queries.select("block", "centres", "radii", "worst"), "qc", "rc", row_cells)
    r = cells(rows.select("block", "centres", "radii"), "rc", "qc", query_cells)

    def nodes(pdf):
        count = pdf["radii"].map(len).to_numpy()
        return (np.repeat(pdf["block"].to_numpy(), count), np.concatenate([np.arange(c) for c in count]),
                np.array([c for cs in pdf["centres"] for c in cs]), np.concatenate(list(pdf["radii"])))

    def judged(q: pd.DataFrame, r: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(r):
            return pd.DataFrame({"query": [], "node": [], "block": [], "most": []})
        (qb, qn, qc, qr), (rb, _, rc, rr) = nodes(q), nodes(r)
        i, j, most = judge(qc, qr, np.concatenate(list(q["worst"])), rc, rr)
        out = pd.DataFrame({"query": qb[i], "node": qn[i], "block": rb[j], "most": most})
        return out.sort_values("most", ascending=False, kind="stable").drop_duplicates(["query", "node", "block"])

    return q.groupBy("qc", "rc").cogroup(r.groupBy("qc", "rc")).applyInPandas(judged, "query long, node int, block long, most double")


def _suited(q, q_radius, worst, r, r_radius):
    """For each query node the row node of the cell with the largest product of centres."""
    near = q @ r.T
    j = near.argmax(1)
    return np.arange(len(q)), j, near[np.arange(len(q)), j]


def _reach(q, q_radius, worst, r, r_radius):
    """Pairs of nodes that can hold a product as good as the worst score to beat."""
    most = most_products(q, q_radius, r, r_radius)
    i, j = np.nonzero(most >= worst[:, None])
    return i, j, most[i, j]


def top_products(rows: DataFrame, is_query, k: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``rows`` (vec_id, v)
    that meets ``is_query`` the ``k`` rows of other ids with the largest inner
    product, ties to the smaller id."""
    spark = rows.sparkSession
    rows = stored(rows, "vectors")
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("v")), F.lit(0)).alias("dim"),
                    F.coalesce(F.sum(is_query.cast("long")), F.lit(0)).alias("q")).first()
    dim, sample = size["dim"], stack(sample_of(rows), size["dim"])
    row_blocks, n_rows = _blocks(rows, pivots(sample, min(PIVOTS, -(-size["n"] // ROWS))), ROWS, dim, "row-trees")
    queries = rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))      # one query for an id
    query_blocks, n_queries = _blocks(queries, pivots(sample, min(PIVOTS, -(-size["q"] // QUERIES))), QUERIES, dim, "query-trees")
    cells = (-(-n_queries // CELL), -(-n_rows // CELL))

    # every query block and the row blocks that suit its nodes best: scores to beat
    best = Window.partitionBy("query", "node").orderBy(F.desc("most"), "block")
    seeds = stored(_pairs(query_blocks.withColumn("worst", F.col("radii")), cells[0], row_blocks, cells[1], _suited)
                   .withColumn("r", F.row_number().over(best)).filter("r = 1").select("query", "block").distinct(), "seeds")
    both = (query_blocks.select(F.col("block").alias("query"), F.lit(True).alias("asks"), "tree")
            .union(seeds.join(row_blocks, "block").select("query", F.lit(False).alias("asks"), "tree")))

    def seeded(pdf: pd.DataFrame) -> pd.DataFrame:
        q = pickle.loads(pdf["tree"][pdf["asks"]].iloc[0])
        got = Best(len(q.ids), k)
        for tree in pdf["tree"][~pdf["asks"]]:
            search(q, pickle.loads(tree), got)
        hits, floor, of = _rows(q, got), got.scores[:, -1], cover(q.points)[0]
        return pd.DataFrame({"query": [pdf["query"].iloc[0]], "worst": [[floor[of == c].min() for c in range(of.max() + 1)]], "floor": [floor.tobytes()],
                             "hits": [[hits[c].to_numpy() for c in ("query_id", "vec_id")]], "scores": [hits["score"].to_numpy()]})

    seen = stored(both.repartition(spread(spark), "query").groupBy("query").applyInPandas(
        seeded, "query long, worst array<double>, floor binary, hits array<array<long>>, scores array<double>"), "seeded")

    # the other pairs that can still hold an answer
    pairs = stored(_pairs(query_blocks.join(seen.select(F.col("query").alias("block"), "worst"), "block"), cells[0], row_blocks, cells[1], _reach)
                   .groupBy("query", "block").agg(F.max("most").alias("most")).join(seeds, ["query", "block"], "left_anti"), "pairs")
    groups = max(-(-n_rows // GROUP), min(n_rows, spark.sparkContext.defaultParallelism), 1)
    group = F.floor(F.col("block") * groups / max(1, n_rows))
    trees = (row_blocks.join(pairs.select("block").distinct(), "block", "left_semi")
             .select(group.alias("grp"), "block", F.lit(None).cast("array<long>").alias("blocks"), "tree", F.lit(None).cast("binary").alias("floor")))
    met = pairs.withColumn("grp", group).groupBy("grp", "query").agg(
        F.transform(F.array_sort(F.collect_list(F.struct((-F.col("most")).alias("back"), "block"))), lambda x: x["block"]).alias("blocks"))
    own = (met.join(query_blocks.select(F.col("block").alias("query"), "tree"), "query").join(seen.select("query", "floor"), "query")
           .select("grp", F.lit(None).cast("long").alias("block"), "blocks", "tree", "floor"))

    def found(batches):
        at, held = None, {}
        for pdf in batches:
            for row in pdf.itertuples():
                if row.grp != at:
                    at, held = row.grp, {}
                if row.floor is None:
                    held[int(row.block)] = pickle.loads(row.tree)
                else:
                    q = pickle.loads(row.tree)
                    got = Best(len(q.ids), k, np.frombuffer(row.floor))
                    for b in row.blocks:
                        search(q, held[b], got)
                    yield _rows(q, got)

    later = (trees.union(own).repartition(max(spread(spark), groups), "grp").sortWithinPartitions("grp", F.asc_nulls_last("block"))
             .mapInPandas(found, "query_id long, vec_id long, score double"))
    first = seen.select(F.explode(F.arrays_zip(F.col("hits")[0].alias("q"), F.col("hits")[1].alias("i"), F.col("scores").alias("s"))).alias("h")).select(
        F.col("h.q").alias("query_id"), F.col("h.i").alias("vec_id"), F.col("h.s").alias("score"))
    return answers(first.union(later), k)


def _rows(tree: CoverTree, best: Best) -> pd.DataFrame:
    full = np.isfinite(best.scores) & (best.scores >= best.floor[:, None])
    return pd.DataFrame({"query_id": np.repeat(tree.ids, full.sum(1)), "vec_id": best.ids[full], "score": best.scores[full]})


def scaled(rows: DataFrame, by: int = 64) -> DataFrame:
    """Usable vectors with every component floor(by * x)."""
    return usable(rows, zero=True).select("vec_id", F.transform("v", lambda x: F.floor(x * by).cast("double")).alias("v"))
