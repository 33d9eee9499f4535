"""Upkeep after many loads (K6, K2, K10): the run directories of a week become
one, zone increments fold into a snapshot, the logs into one file each.

New directories are written first and one commit swaps them in, so a crash
inside the job changes nothing. A load that commits meanwhile makes the commit
fail with ``ConcurrentLoadError``: the job is rerun. The directories that were
replaced stay for readers of an older state until ``vacuum`` removes them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import commits, store


def _rewritten(spark: SparkSession, root: str, st: commits.State, weeks: list[str], run_id: str) -> None:
    """The facts of some weeks, range-partitioned and sorted by time, under one run id.
    The layout is that of a load, so a week that holds most rows is split over many tasks."""
    store.append_facts(store.read_facts(spark, root, st, weeks), root, run_id)


def compact(spark: SparkSession, root: str, min_runs: int = 2) -> dict:
    """Merge the weeks that ``min_runs`` or more runs hold, fold the zone
    increments and the quarantine, checkpoint the commit log and fold the
    control log."""
    st = commits.state(spark, root)
    weeks = sorted(w for w, runs in (st.facts or {}).items() if len(runs) >= min_runs)
    run_id = "c" + uuid.uuid4().hex[:11]
    change = {"kind": "compact", "run": run_id, "weeks": weeks, "tables": {},
              "replaces": [[r, w] for w in weeks for r in st.facts[w]]}
    if weeks:
        _rewritten(spark, root, st, weeks, run_id)
    if st.zone_runs:
        zones = store.read_zones(spark, root, st)
        version = store.new_version()
        store.write_version(zones, root, "dim_zonas", version, coalesce=store.files_for(zones.count()))
        change["tables"]["dim_zonas"], change["folded_zones"] = version, st.zone_runs
    if len(st.quarantine) > 1:
        kept = store.read_quarantine(spark, root, st)
        store.write_quarantine(kept.coalesce(store.files_for(kept.count())), root, run_id)
        change["folded_quarantine"] = st.quarantine
    if weeks or st.zone_runs or "folded_quarantine" in change:
        commits.commit(spark, root, st, change)
    return {"weeks": len(weeks), "replaced": len(change["replaces"]), "zones": len(st.zone_runs),
            "commits": commits.checkpoint(spark, root), "control_files": store.fold_control_log(spark, root)}


def dead_directories(spark: SparkSession, root: str) -> list[str]:
    """Fact, zone and quarantine directories that no commit names any more:
    replaced ones, those of loads that died and of loads before an overwrite."""
    st = commits.state(spark, root)
    live = {(r, w) for w, runs in (st.facts or {}).items() for r in runs}
    out = []

    def children(path: str) -> list[str]:
        fs, p = commits._fs(spark, path)
        return [s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()] if fs.exists(p) else []

    base = store._path(root, store.FACT)
    for run in children(base):
        for week in children(f"{base}/{run}"):
            if week.startswith("semana=") and (run.split("=")[1], week.split("=")[1]) not in live:
                out.append(f"{base}/{run}/{week}")
    for folder, runs in ((store.ZONES_MORE, st.zone_runs), ("_quarantine", st.quarantine)):
        base = store._path(root, folder)
        out += [f"{base}/{r}" for r in children(base) if r.split("=")[-1] not in runs]
    return out


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove dead directories. Run it when no load and no reader of an older
    state is at work: a load in progress is not committed yet."""
    paths = dead_directories(spark, root)
    for path in paths:
        fs, p = commits._fs(spark, path)
        fs.delete(p, True)
    return len(paths)
