"""The load job (K1-K4, K6, K9, K10, J5-J7, A21): raw feed -> warehouse.

``run`` reads the raw feed (full or past the watermark), inserts new
dimension members with fresh serial ids, accumulates zone totals from the
*accepted* facts only, and appends the new facts to their weekly partitions.
Re-running on the same input adds nothing; splitting the input into k
increments gives the same warehouse as one full run.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from .. import functions as X
from ..operators.clean import normalize
from ..operators.dimensions import (AUDIT_COLUMNS, DIM_COLUMNS, assign_ids, dedupe_counted, device_members,
                                    hour_members, network_members, operator_members, quality_dim, time_members,
                                    zone_members, zone_stats)
from ..operators.joins import dim_join
from ..operators.maintenance import insert_ignore, new_facts, stored_keys, with_audit_cols
from ..operators.warehouse import to_fact_rows, with_reason
from ..sources.raw import extract, high_watermark, since
from . import commits, store
from .commits import ConcurrentLoadError


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def _as_datetime(now) -> _dt.datetime:
    if now is None:
        return _now()
    if isinstance(now, str):
        return _dt.datetime.fromisoformat(now)
    return now


def _count(df: DataFrame | None) -> int | None:
    return None if df is None else df.count()


def _stored_columns(name: str) -> list[str]:
    return DIM_COLUMNS[name] + AUDIT_COLUMNS.get(name, [])


def _held(held: list, df: DataFrame) -> DataFrame:
    """Cache a frame of the load until the load ends."""
    held.append(df.persist(StorageLevel.MEMORY_AND_DISK))
    return df


def _merge_serial_dim(existing: DataFrame | None, n_existing: int, members: DataFrame, keys: list[str],
                      id_col: str, name: str, now, held: list) -> tuple[DataFrame, int]:
    """K1 + K4 + K5: members absent from the dimension get ids after the
    largest existing id and load-time audit columns; returns (whole new
    dimension, number of new members)."""
    cols = _stored_columns(name)
    fresh = _held(held, insert_ignore(existing, members, keys, n_existing))
    n = fresh.count()
    fresh = with_audit_cols(assign_ids(fresh, id_col, keys, existing, n_rows=n), now, AUDIT_COLUMNS.get(name, []))
    fresh = fresh.select(*cols)
    table = fresh if existing is None else existing.select(*cols).unionByName(fresh)
    return table, n


def _merge_natural_dim(existing: DataFrame | None, n_existing: int, members: DataFrame, keys: list[str],
                       cols: list[str], held: list) -> tuple[DataFrame, int]:
    fresh = _held(held, insert_ignore(existing, members.select(*cols), keys, n_existing))
    n = fresh.count()
    table = fresh if existing is None else existing.select(*cols).unionByName(fresh)
    return table, n


def _zone_increment(existing: DataFrame | None, delta: DataFrame, now, held: list, n_existing: int | None) -> tuple[DataFrame, DataFrame]:
    """K2 + K4: (whole rows of new cells, with ids after the largest; counts to
    add to known cells, other attributes NULL as they keep their first values).
    Its size is that of the batch, whatever the number of zones."""
    keys, cols = ["grid_lat", "grid_lon"], _stored_columns("dim_zonas")
    delta = _held(held, with_audit_cols(delta, now, AUDIT_COLUMNS["dim_zonas"]))
    if existing is None:
        return assign_ids(delta, "zona_id", keys).select(*cols), None
    known = dim_join(delta, existing.select("zona_id", *keys), keys, "left", n_existing)
    known = _held(held, known)
    fresh = assign_ids(known.filter(F.col("zona_id").isNull()).drop("zona_id"), "zona_id", keys, existing).select(*cols)
    kinds = {f.name: f.dataType for f in existing.schema.fields}
    more = known.filter(F.col("zona_id").isNotNull()).select(
        *[F.col(c) if c in ("zona_id", "total_mediciones") else F.lit(None).cast(kinds[c]).alias(c) for c in cols])
    return fresh, more


def load_batch(spark: SparkSession, batch: DataFrame, root: str, now=None, mode: str = "incremental",
               batch_id: int | None = None, overwrite: bool = False,
               grid_size: float = C.GRID_SIZE_ETL, grid_mode: str = "trunc") -> dict:
    """Load one batch of raw rows into the warehouse at ``root``.

    Dimension snapshots, zone increments, quarantined rows and facts are
    written first and become current together, in one commit: a run that fails
    anywhere before leaves the warehouse as it was, and its rerun assigns the
    same ids (they are a function of the stored dimension and the batch). Of
    two loads that started from one state, one commits and the other raises
    ``ConcurrentLoadError``."""
    t0 = time.time()
    now = _as_datetime(now)
    run_id = uuid.uuid4().hex[:12]
    st = commits.state(spark, root)
    vers = store.current_versions(spark, root)
    if overwrite:
        dims = {n: None for n in DIM_COLUMNS}
        fact = None
    else:
        dims = {n: (store.read_version(spark, root, n, vers[n]) if n in vers else None) for n in DIM_COLUMNS}
        dims["dim_zonas"] = store.read_zones(spark, root, st)
        fact = store.read_facts(spark, root, st)

    def recorded(status: str, **more) -> None:
        store.record_run(spark, root, {"table_name": store.FACT, "run_id": run_id, "mode": mode, "batch_id": batch_id,
                                       "records_processed": 0, "status": status, "updated_at": _now(), **more})

    if st.seq == 0 and store.control_log(spark, root) is None:      # the seeded control row
        store.record_run(spark, root, {"table_name": store.FACT, "last_extracted_at": _dt.datetime(1970, 1, 1),
                                       "records_processed": 0, "status": "IDLE", "updated_at": _now()})
    recorded("RUNNING")

    # a narrow projection of the scan; the feed itself is never cached
    norm = normalize(batch, grid_size, grid_mode)
    ts = F.col("timestamp").cast("timestamp_ntz")
    held: list = []
    # days x hours x operators x networks: small, and four dimensions, the weeks
    # and the time range of the batch come from it
    combos = _held(held, norm.groupBy("fecha", "hora", "operador_normalizado", "red_normalizada").agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("first"), F.max(ts).alias("last")))
    result = {"run_id": run_id, "mode": mode, "new_facts": 0, "new_members": {}}
    try:
        stats = combos.agg(F.coalesce(F.sum("n"), F.lit(0)), F.min("first"), F.max("last")).first()
        result.update({"valid_rows": stats[0], "last_extracted_at": stats[2]})
        if stats[0] or overwrite:
            result.update(_load_normalized(spark, norm, combos, root, dims, st, fact, now, overwrite, grid_size,
                                           (stats[1], stats[2]), run_id, held))
        status, err = "OK", None
    except Exception as e:  # recorded, then re-raised
        status, err = "ERROR", f"{type(e).__name__}: {e}"[:2000]
        raise
    finally:
        for df in held:
            df.unpersist()
        recorded(status, last_extracted_at=result.get("last_extracted_at"), last_loaded_at=now,
                 records_processed=result.get("new_facts", 0), error_message=err)
    dur = max(time.time() - t0, 1e-9)
    result.update({"seconds": round(dur, 3), "rows_per_s": round(result["new_facts"] / dur, 1)})
    return result


def _check_versions(spark, root, vers: dict) -> None:
    """Stop early, before the facts are written, if another load has committed
    since this one started; the commit itself is the check that decides."""
    now_vers = store.current_versions(spark, root)
    changed = [n for n in set(vers) | set(now_vers) if now_vers.get(n) != vers.get(n)]
    if changed:
        raise ConcurrentLoadError(f"tables changed by another load: {sorted(changed)}; rerun this load")


def _stored_quarantine(spark, root, st, overwrite, ts_range) -> DataFrame | None:
    """Keys (source_id, timestamp, motivo) already quarantined in the time range of the batch."""
    kept = None if overwrite else store.read_quarantine(spark, root, st)
    if kept is None:
        return None
    lo, hi = (X.ts_literal(t, kept.schema["timestamp"].dataType) for t in ts_range)
    return kept.filter(F.col("timestamp").between(lo, hi)).select("source_id", "timestamp", "motivo")


def _load_normalized(spark, norm, combos, root, dims, st, fact, now, overwrite, grid_size, ts_range,
                     run_id, held) -> dict:
    vers = dict(st.tables)
    out = {"new_members": {}}
    written: dict[str, int] = {}
    current, sizes = {}, {}

    def publish(name: str, table: DataFrame, n_rows: int | None = None) -> None:
        if n_rows is None:       # count first: the size picks the file count and the broadcast
            table = _held(held, table)
            n_rows = table.count()
        v = store.new_version()
        store.write_version(table, root, name, v, coalesce=store.files_for(n_rows))
        written[name] = v
        current[name] = store.read_version(spark, root, name, v)
        sizes[name] = n_rows

    plans = {
        "dim_tiempo": lambda e, n: _merge_natural_dim(e, n, time_members(combos), ["tiempo_id"],
                                                      DIM_COLUMNS["dim_tiempo"], held),
        "dim_hora": lambda e, n: _merge_natural_dim(e, n, hour_members(combos), ["hora_id"],
                                                    DIM_COLUMNS["dim_hora"], held),
        "dim_operador": lambda e, n: _merge_serial_dim(e, n, operator_members(combos), ["operador_nombre"],
                                                       "operador_id", "dim_operador", now, held),
        "dim_red": lambda e, n: _merge_serial_dim(e, n, network_members(combos), ["red_tipo"], "red_id",
                                                  "dim_red", now, held),
        "dim_dispositivo": lambda e, n: _merge_serial_dim(e, n, device_members(norm), ["device_id"],
                                                          "dispositivo_id", "dim_dispositivo", now, held),
    }
    def merge(name: str):
        n_existing = _count(dims[name]) or 0
        table, n_new = plans[name](dims[name], n_existing)
        version = None
        if n_new or dims[name] is None:
            version = store.new_version()
            store.write_version(table, root, name, version, coalesce=store.files_for(n_existing + n_new))
        return name, version, n_existing, n_new

    # the dimension merges are independent small jobs: submitted from several
    # driver threads they run side by side instead of one after another
    with ThreadPoolExecutor(max_workers=len(plans)) as pool:
        merged = list(pool.map(merge, plans))
    for name, version, n_existing, n_new in merged:
        out["new_members"][name] = n_new
        if version is not None:
            written[name] = version
            current[name] = store.read_version(spark, root, name, version)
            sizes[name] = n_existing + n_new
        else:
            current[name], sizes[name] = dims[name], n_existing
    if dims["dim_calidad"] is None:
        publish("dim_calidad", quality_dim(spark), len(C.QUALITY_SEED))
    else:
        current["dim_calidad"], sizes["dim_calidad"] = dims["dim_calidad"], len(C.QUALITY_SEED)

    # rows whose key (source_id, timestamp, motivo) is stored neither as a fact
    # (no motivo) nor in the quarantine (K3), then one row per key: a rerun drops
    # its rows before the dedupe's shuffle
    rows = with_reason(norm).withColumn("semana", X.week_partition("timestamp"))
    # weeks of the batch (bounded list), from the small aggregate
    touched = [r[0] for r in combos.select(X.week_partition("fecha")).distinct().collect()]
    keys = ["source_id", "timestamp", "motivo"]
    kept = _stored_quarantine(spark, root, st, overwrite, ts_range)
    known = None
    if fact is not None:
        # the stored keys the batch can collide with: pruned to its weeks and time
        # range, counted (cheap on time-sorted files) for the broadcast check
        known = stored_keys(fact, touched=touched, ts_range=ts_range).withColumn("motivo", F.lit(None).cast("string"))
    if kept is not None:
        known = kept if known is None else known.unionByName(kept.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))
    unseen = rows if known is None else new_facts(known, rows, keys, existing_rows=known.count())
    # persisted, not checkpointed: the plan is deterministic and the scan of
    # the stored fact has a fixed file list, so a recomputation after a lost
    # executor gives the same rows
    fresh = _held(held, dedupe_counted(unseen, keys, ["device_id", "signal"], held))
    good, bad = fresh.filter(F.col("motivo").isNull()).drop("motivo"), fresh.filter(F.col("motivo").isNotNull())
    n_fresh, n_bad = fresh.agg(F.count(F.lit(1)), F.count("motivo")).first()
    out["quarantined"] = n_bad
    out["new_facts"] = n_fresh - n_bad
    new = n_fresh > n_bad

    # zones accumulate the accepted facts only, so a rerun adds zero
    zones = dims["dim_zonas"]
    n_zones = _count(zones)
    more_zones = False
    if zones is None:
        fresh_zones, _ = _zone_increment(None, zone_members(zone_stats(good, grid_size, cells_ready=True), grid_size), now, held, None)
        publish("dim_zonas", fresh_zones)
    elif new:
        delta = zone_members(zone_stats(good, grid_size, cells_ready=True), grid_size)
        fresh_zones, counts = _zone_increment(zones, delta, now, held, n_zones)
        store.write_zone_increment(fresh_zones.unionByName(counts), root, run_id)
        more_zones = True
        # the keys of new cells are read back from this load's own increment
        own = spark.read.schema(zones.schema).parquet(store._path(root, store.ZONES_MORE, f"run_id={run_id}"))
        own = own.filter(F.col("grid_lat").isNotNull())
        current["dim_zonas"], sizes["dim_zonas"] = zones.unionByName(own), n_zones + own.count()
    else:
        current["dim_zonas"], sizes["dim_zonas"] = zones, n_zones

    if n_bad:
        store.write_quarantine(bad, root, run_id)
    _check_versions(spark, root, vers)
    weeks = []
    if new:
        store.append_facts(to_fact_rows(good, current, sizes, now), root, run_id)
        weeks = sorted(r[0] for r in good.select("semana").distinct().collect())     # bounded: weeks of the batch
    if new or overwrite or store.FACT not in vers:
        written[store.FACT] = store.new_version()
    if written or n_bad or more_zones:
        commits.commit(spark, root, st, {"kind": "load", "tables": written, "run": run_id, "weeks": weeks, "reset": overwrite,
                                         "quarantine": bool(n_bad), "zones": more_zones})
    return out


def run(spark: SparkSession, raw: DataFrame, root: str, mode: str = "incremental", limit: int | None = None,
        now=None, overwrite: bool = False, lookback: _dt.timedelta | None = None, validate: bool | str = False,
        **kw) -> dict:
    """K9: ``mode="initial"`` loads the whole feed (still idempotent: known
    keys are skipped); ``"incremental"`` loads rows strictly newer than the
    stored high watermark; ``overwrite=True`` rebuilds every table.

    ``lookback`` (T13) moves the incremental cut that far back, so rows that
    arrive late (older than the watermark, not loaded yet) are still picked
    up; rows re-read that are already stored are dropped by the key anti
    join, so the result stays exact.

    ``validate=True`` runs the constraint report (K11) on the loaded
    warehouse, ``validate="increment"`` on the rows of this load alone; the
    violated rules are returned under ``"violations"``."""
    wm = None
    if mode != "initial" and not overwrite:
        fact = store.read_table(spark, root, store.FACT)
        if fact is not None:
            # the newest week holds the newest row: other weeks are not read
            newest = fact.agg(F.max("semana")).first()[0]
            wm = high_watermark(fact.filter(F.col("semana") == newest)).first()[0]
            kept = store.read_quarantine(spark, root)
            if kept is not None:        # rows that were read and set aside are not read again
                wm = max(wm, kept.agg(F.max(F.col("timestamp").cast("timestamp_ntz"))).first()[0])
            if lookback is not None and wm is not None and wm.year > 1970:
                wm = wm - lookback
    batch = extract(since(raw, wm), limit)
    res = load_batch(spark, batch, root, now=now, mode=mode, overwrite=overwrite, **kw)
    res["watermark"] = wm
    if validate:
        report = checked_run(spark, root, res["run_id"]) if validate == "increment" else None
        if report is None:
            from ..operators.audit import warehouse_checks
            from ..operators.warehouse import Warehouse
            report = warehouse_checks(Warehouse.load(spark, root))
        res["violations"] = [tuple(r) for r in report.filter(F.col("violaciones") > 0).collect()]   # at most one row per rule
    return res


def checked_run(spark: SparkSession, root: str, run_id: str) -> DataFrame | None:
    """K11 on the rows of one load: reads its own weeks, and of the facts stored
    there its time range. ``None`` if the load added no fact."""
    from ..operators.increment import increment_checks
    from ..operators.warehouse import Warehouse
    st = commits.state(spark, root)
    weeks = sorted(w for w, runs in (st.facts or {}).items() if run_id in runs)
    if not weeks:
        return None
    w = Warehouse.load(spark, root)
    own = commits.State(facts={week: [run_id] for week in weeks})
    new = store.read_facts(spark, root, own)
    n, lo, hi = new.agg(F.count(F.lit(1)), F.min("timestamp"), F.max("timestamp")).first()
    stored = store.read_facts(spark, root, st, weeks)
    kind = stored.schema["timestamp"].dataType
    stored = stored.filter(F.col("timestamp").between(X.ts_literal(lo, kind), X.ts_literal(hi, kind)))
    return increment_checks(new, stored, w.dims, w.sizes, n)
