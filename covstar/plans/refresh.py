"""Materialised aggregates (K8), refreshed incrementally.

A refresh reads the facts of the weeks that changed since the last one, writes
their mergeable partial states (``operators.rollups``), and merges the states of
all weeks into new snapshots. Weeks without new facts are not read again. The
states and the snapshots become current in commits of their own; a refresh that
dies leaves the previous ones. The order of the top-devices list is applied when
it is read (an order inside a stored table is not kept).
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import or_

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import rollups
from ..operators.warehouse import Warehouse
from . import commits, store

AGGREGATES = Warehouse.AGGREGATES
SUMMARY = "resumen"


def touched_weeks(st: commits.State) -> list[str]:
    """Weeks whose facts changed since the states were written."""
    return sorted(w for w, seq in st.changed.items() if seq > st.covers)


#: Refreshes whose states are read side by side before one of them takes over all weeks.
MOST_REFRESHES = 16


def _state_path(root: str, name: str, refresh: int | None = None) -> str:
    return store._path(root, "_partials", name, *([] if refresh is None else [f"refresh={refresh}"]))


def refresh_states(spark: SparkSession, root: str) -> commits.State:
    """Bring the partial states up to date: reads the facts of the changed weeks only."""
    st = commits.state(spark, root)
    if st.facts is None:
        raise FileNotFoundError(f"no warehouse at {root}: run the load first")
    reset = st.reset_at > st.covers
    weeks = sorted(st.facts) if reset else touched_weeks(st)
    if not weeks and not reset:
        return st
    kept = {} if reset else {w: r for w, r in st.partials.items() if w not in weeks}
    fold = len(set(kept.values())) >= MOST_REFRESHES
    facts = store.read_facts(spark, root, st, weeks).persist(StorageLevel.MEMORY_AND_DISK)   # one scan, four states

    def write(name: str) -> None:
        out = rollups.partial_state(facts, name, ("semana",))
        if fold:                                  # the small states of the other weeks move along
            out = out.unionByName(states(spark, root, name, commits.State(partials=kept)))
        out.write.mode("overwrite").parquet(_state_path(root, name, st.seq))

    try:
        facts.count()
        with ThreadPoolExecutor(max_workers=len(rollups.SPECS)) as pool:
            list(pool.map(write, rollups.SPECS))
    finally:
        facts.unpersist()
    commits.commit(spark, root, st, {"kind": "partials", "refresh": st.seq, "weeks": sorted({*weeks, *kept} if fold else weeks),
                                     "covers": st.seq, "reset": reset})
    return commits.state(spark, root)


def states(spark: SparkSession, root: str, name: str, st: commits.State | None = None) -> DataFrame:
    """The partial states of all weeks, each from the refresh that wrote it last."""
    st = commits.state(spark, root) if st is None else st
    none = rollups.partial_state(spark.createDataFrame([], store.FACT_SCHEMA), name, ("semana",))
    if not st.partials:
        return none
    of: dict[int, list[str]] = {}
    for week, r in st.partials.items():
        of.setdefault(r, []).append(week)
    schema = T.StructType([*none.schema.fields, T.StructField("refresh", T.LongType())])
    rows = (spark.read.schema(schema).option("basePath", _state_path(root, name))
            .parquet(*[_state_path(root, name, r) for r in sorted(of)]))
    live = reduce(or_, [(F.col("refresh") == r) & F.col("semana").isin(weeks) for r, weeks in sorted(of.items())])
    return rows.filter(live).drop("refresh")


def _write_aggregate(w: Warehouse, root: str, name: str, version: int, st: commits.State) -> tuple[str, int, float]:
    t0 = time.time()
    store.write_version(rollups.aggregate(states(w.spark, root, name, st), name, w), root, name, version)
    rows = store.read_version(w.spark, root, name, version).count()
    return name, rows, round(time.time() - t0, 3)


def refresh(spark: SparkSession, root: str, name: str) -> tuple[str, int, float]:
    """Re-materialise one aggregate -> (name, rows, seconds)."""
    st = refresh_states(spark, root)
    version = store.new_version()
    out = _write_aggregate(Warehouse.load(spark, root), root, name, version, st)
    store.record_versions(spark, root, {name: version})
    return out


def refresh_all(spark: SparkSession, root: str) -> dict:
    """The refresh job: partition counts, the three aggregates, the global
    summary (A8, K8 x3, A6), all from the partial states. The aggregates are
    independent jobs and run side by side (submitted from several driver
    threads), each writing its own snapshot directory; the new versions become
    current together, in one commit."""
    st = refresh_states(spark, root)
    w = Warehouse.load(spark, root)
    targets = {n: store.new_version() for n in AGGREGATES}
    summary = states(spark, root, SUMMARY, st)
    with ThreadPoolExecutor(max_workers=len(AGGREGATES) + 2) as pool:
        parts_f = pool.submit(lambda: [tuple(r) for r in summary.filter("kind = ''").groupBy("semana").agg(
            F.sum("n").alias("registros")).orderBy("semana").collect()])                    # one row per week
        summary_f = pool.submit(lambda: rollups.aggregate(summary, SUMMARY, w).first())     # one row
        done = list(pool.map(lambda n: _write_aggregate(w, root, n, targets[n], st), AGGREGATES))
        parts, total = parts_f.result(), summary_f.result()
    store.record_versions(spark, root, targets)
    return {"partitions": parts, "refreshed": done, "summary": total.asDict() if total else {}}


def read_aggregate(spark: SparkSession, root: str, name: str) -> DataFrame:
    df = store.read_table(spark, root, name)
    if name == "mv_top_dispositivos":
        df = df.orderBy(F.col("total_mediciones").desc(), "dispositivo_id")
    return df
