"""Vector code compression: product codes whose codebooks are fitted and assigned
through a lexicographic trie over distinct parts.

Components become integers, vectors are cut into consecutive parts. The distinct
parts are counted and range-partitioned in lexicographic order, so a task holds
one stretch of the trie of a part position. The trie is walked depth first: a node
holds the squared distances of its dimension prefix to every codebook entry, and
all parts below share that vector. A subtree of ``LEAVES`` leaves or fewer is
finished level by level in numpy, one accumulation for each node. A leaf takes
the nearest entry (ties to the lower index) and adds its part to the entry's sum
as often as the part occurs.

A round sends the sums of each entry to the driver: ``parts`` x ``entries`` rows,
whatever the size of the table. Codes are assigned to rows where they lie.

Results for odd input: vectors that are null or hold null or non-finite components
are dropped; shorter vectors are filled up with zeros, and all up to a multiple
of ``parts``; components beyond 2**30 / sqrt(dimensions) after scaling count as
that (with 64 dimensions: 32,768 before scaling by 4096), which keeps distances
within 64 bits; null ids are kept and seed codebooks last; repeated ids are rows
of their own; fewer rows than entries give shorter codebooks; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covstar.llm.common import spread, stored

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
LEAVES = 2048


def whole(rows: DataFrame, vector: str = "embedding", parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """``rows`` that take part with ``vc_parts`` array<int>, and the number of dimensions."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    good = rows.filter(F.col(vector).isNotNull()).filter(~bad)
    most = good.agg(F.max(F.size(vector)).alias("n")).first()["n"]
    dim = max(1, -(-(most or 0) // parts)) * parts
    bound = math.isqrt((1 << 60) // dim)
    cell = lambda x: F.floor(F.greatest(F.lit(-bound).cast("double"), F.least(F.lit(bound).cast("double"), x.cast("double") * scale))).cast("int")
    filled = F.concat(F.transform(vector, cell), F.array_repeat(F.lit(0), F.lit(dim) - F.size(vector)))
    return good.withColumn("vc_parts", filled), dim


def _subtree(rows: np.ndarray, depth: int, above: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Distances of sorted ``rows`` that share their first ``depth`` components."""
    new = np.zeros(len(rows), bool)
    new[:1] = True
    node, shared = np.zeros(len(rows), np.int64), above[None, :]
    for d in range(depth, rows.shape[1]):
        new[1:] |= rows[1:, d] != rows[:-1, d]
        first = np.flatnonzero(new)
        shared = shared[node[first]] + (rows[first, d, None] - entries[None, :, d]) ** 2
        node = np.cumsum(new) - 1
    return shared[node]


def distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of lexicographically sorted integer ``rows`` to ``entries``,
    by a depth-first walk of their trie."""
    n, width = rows.shape
    out = np.empty((n, len(entries)), np.int64)
    stack = [(0, n, 0, np.zeros(len(entries), np.int64))] if n else []
    while stack:
        lo, hi, depth, above = stack.pop()
        if hi - lo <= LEAVES or depth == width:
            out[lo:hi] = _subtree(rows[lo:hi], depth, above, entries)
            continue
        column = rows[lo:hi, depth]
        ends = np.append(np.flatnonzero(column[1:] != column[:-1]) + 1, hi - lo)
        a = 0
        while a < hi - lo:
            # one large child, or as many small neighbours as a subtree may hold
            b = int(ends[max(np.searchsorted(ends, a + LEAVES, "right") - 1, np.searchsorted(ends, a, "right"))])
            alone = column[a] == column[b - 1]
            stack.append((lo + a, lo + b, depth + alone, above + (column[a] - entries[:, depth]) ** 2 if alone else above))
            a = b
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def _round(distinct: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: the codebooks moved to the means of their parts."""
    n_parts, n_entries, width = books.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, n_entries, width), np.int64)
        count = np.zeros((n_parts, n_entries), np.int64)
        for batch in batches:
            at, times = batch.column("at").to_numpy(), batch.column("times").to_numpy()
            rows = _matrix(batch.column("part"), width)
            for p in np.unique(at).tolist():
                own = at == p
                code = distances(rows[own], books[p]).argmin(1)
                np.add.at(total[p], code, rows[own] * times[own, None])
                np.add.at(count[p], code, times[own])
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)), pa.array(count[p, e]),
                                          pa.array(total[p, e].tolist(), pa.list_(pa.int64()))], ["at", "entry", "n", "total"])

    found = distinct.mapInArrow(sums, "at int, entry int, n long, total array<long>")
    moved = books.copy()
    for r in found.groupBy("at", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(width)]).collect():
        moved[r["at"], r["entry"]] = [r[f"t{i}"] // r["n"] for i in range(width)]
    return moved


def fit(rows: DataFrame, dim: int, order: str = "vec_id", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) of rows with ``vc_parts``, begun with the rows smallest by ``order``."""
    first = rows.orderBy(F.col(order).asc_nulls_last(), "vc_parts").limit(entries).collect()
    width = dim // parts
    books = np.array([r["vc_parts"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: F.slice("vc_parts", p * width + 1, F.lit(width)))
    found = rows.select(F.posexplode(cut).alias("at", "part")).groupBy("at", "part").agg(F.count(F.lit(1)).alias("times"))
    distinct = stored(found.repartitionByRange(spread(rows.sparkSession), "at", "part").sortWithinPartitions("at", "part"), "vc-parts")
    for _ in range(rounds if len(first) else 0):
        books = _round(distinct, books)
    return books


def assign(rows: DataFrame, books: np.ndarray) -> DataFrame:
    """``rows`` with ``vc_code`` (binary, an index for each part) and ``vc_error``
    (squared distances summed over the parts) in place of ``vc_parts``."""
    n_parts, _, width = books.shape
    carried = [f for f in rows.schema.fields if f.name != "vc_parts"]

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("vc_parts"), n_parts * width)
            code, error = np.zeros((len(v), n_parts), np.uint8), np.zeros(len(v), np.int64)
            for p in range(n_parts if len(v) else 0):
                part = v[:, p * width:(p + 1) * width]
                order = np.lexsort(part.T[::-1])
                far = distances(part[order], books[p])
                near = far.argmin(1)
                code[order, p] = near
                error[order] += far[np.arange(len(far)), near]
            yield pa.RecordBatch.from_arrays(
                [batch.column(f.name) for f in carried] + [pa.array([c.tobytes() for c in code], pa.binary()), pa.array(error)],
                [f.name for f in carried] + ["vc_code", "vc_error"])

    schema = T.StructType(carried + [T.StructField("vc_code", T.BinaryType()), T.StructField("vc_error", T.LongType())])
    return rows.mapInArrow(codes, schema)


def compressed(rows: DataFrame, vector: str = "embedding", order: str = "vec_id", carry: list[str] | None = None,
               parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(``carry`` columns, all but the vector if None, ``vc_code``, ``vc_error``) of every
    row that takes part, and the codebooks. At most 256 entries."""
    taken, dim = whole(rows, vector, parts, scale)
    carry = [c for c in rows.columns if c != vector] if carry is None else carry
    kept = stored(taken.select(*carry, "vc_parts"), "vc-rows")
    books = fit(kept, dim, order, parts, entries, rounds)
    return assign(kept, books), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
