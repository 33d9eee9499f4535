"""Table maintenance on plain DataFrames (K1-K3, K5, K6 helpers).

There is no MERGE without a table format, so inserts and upserts are
expressed as joins producing the *new* table content (dimensions) or the
rows to append (facts).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timekeys import ts_literal
from .joins import dim_join


def insert_ignore(existing: DataFrame | None, new: DataFrame, keys: list[str],
                  existing_rows: int | None = None) -> DataFrame:
    """K1: rows of ``new`` whose key is absent from ``existing`` (insert ...
    on conflict do nothing). Of rows with one key the smallest stays."""
    rest = [c for c in new.columns if c not in keys]
    fresh = new.distinct() if not rest else (
        new.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_first")).select(*keys, *[f"_first.{c}" for c in rest]).select(*new.columns))
    if existing is None:
        return fresh
    return dim_join(fresh, existing.select(*keys).distinct(), keys, "left_anti", existing_rows)


def upsert_accumulate(existing: DataFrame | None, delta: DataFrame, keys: list[str],
                      sum_cols: list[str]) -> DataFrame:
    """K2: accumulating upsert. Keys only in ``delta`` are inserted; for keys
    in both, ``sum_cols`` add up and every other column keeps the existing
    value. Returns the whole new table (one full outer join on the keys)."""
    if existing is None:
        return delta
    others = [c for c in existing.columns if c not in keys]
    o = existing.select(*[F.col(c).alias(f"_o_{c}") for c in existing.columns], F.lit(True).alias("_o"))
    n = delta.select(*[F.col(c).alias(f"_n_{c}") for c in existing.columns if c in delta.columns])
    same = [F.col(f"_o_{k}").eqNullSafe(F.col(f"_n_{k}")) for k in keys]      # a NULL key meets itself
    j = o.join(n, reduce(and_, same), "full_outer")
    out = [F.when(F.col("_o"), F.col(f"_o_{k}")).otherwise(F.col(f"_n_{k}")).alias(k) for k in keys]
    for c in others:
        has_new = c in delta.columns
        if c in sum_cols:
            expr = F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.coalesce(F.col(f"_n_{c}"), F.lit(0))
        elif has_new:
            expr = F.coalesce(F.col(f"_o_{c}"), F.col(f"_n_{c}"))
        else:
            expr = F.col(f"_o_{c}")
        out.append(expr.cast(existing.schema[c].dataType).alias(c))
    return j.select(*out)


def new_facts(existing: DataFrame | None, new: DataFrame, keys=("source_id", "timestamp"),
              partition_col: str = "semana", touched: list[str] | None = None,
              ts_range: tuple | None = None, ts_col: str = "timestamp",
              existing_rows: int | None = None) -> DataFrame:
    """K3: fact rows whose (source_id, timestamp) is not stored yet. The
    stored side is cut down before the anti join (``touched`` and
    ``ts_range`` must cover the batch): to the weeks the batch
    touches (partition pruning), to the batch's [min, max] time range (a
    pushed filter; files are time-sorted, so row groups outside are
    skipped - an incremental batch past the watermark reads almost
    nothing), and to the key columns (column pruning). ``existing_rows`` is
    the counted size of that key set: within the broadcast limit it is
    broadcast, so the batch keeps its partitioning."""
    keys = list(keys)
    if existing is None:
        return new
    ex = stored_keys(existing, keys, partition_col, touched, ts_range, ts_col)
    ex = ex.select(*[F.col(k).alias(f"_s_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]              # a NULL id is a key like any other
    return dim_join(new, ex, reduce(and_, same), "left_anti", existing_rows)


def stored_keys(existing: DataFrame, keys=("source_id", "timestamp"), partition_col: str = "semana",
                touched: list[str] | None = None, ts_range: tuple | None = None,
                ts_col: str = "timestamp") -> DataFrame:
    """The stored fact keys a batch can collide with (see ``new_facts``)."""
    ex = existing
    if touched is not None:
        ex = ex.filter(F.col(partition_col).isin(touched))
    if ts_range is not None and ts_range[0] is not None:
        lo, hi = ts_range
        dtype = existing.schema[ts_col].dataType
        ex = ex.filter(F.col(ts_col).between(ts_literal(lo, dtype), ts_literal(hi, dtype)))
    return ex.select(*keys)


def with_audit_cols(df: DataFrame, now=None, cols=("created_at",)) -> DataFrame:
    """K5: audit columns defaulting to now (injectable for tests)."""
    if not cols:
        return df
    ts = F.current_timestamp() if now is None else ts_literal(now, "timestamp")
    return df.withColumns({c: ts for c in cols})
