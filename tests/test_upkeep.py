"""Many loads into one warehouse: incremental aggregates, compaction, quarantine
keyed by row, zone increments, one writer at a time."""

import glob
import os
import tempfile
import threading

import pytest
from pyspark.sql import functions as F

from covstar import Warehouse, raw_from_dir
from covstar.operators import early, rollups
from covstar.plans import commits, compact, etl, refresh, repair, store

SF = "/root/testdata/sf0.001"
NOW = "2025-01-01 00:00:00"
CUTS = ["2024-01-09", "2024-01-17", "2024-01-25", "2100-01-01"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def zones(w):
    return rows(w.dims["dim_zonas"].select("grid_lat", "grid_lon", "total_mediciones", "zona_nombre", "centro_lat"))


@pytest.fixture(scope="module")
def loaded(spark):
    """Four increments, a refresh after each (the last one takes over the states of
    all weeks); the root, what each refresh read, and the feed."""
    root = tempfile.mkdtemp(prefix="covstar-up-")
    raw = raw_from_dir(spark, SF)
    read, before = [], "1900-01-01"
    for cut in CUTS:
        part = raw.filter((F.col("timestamp") >= F.lit(before).cast("timestamp_ntz")) & (F.col("timestamp") < F.lit(cut).cast("timestamp_ntz")))
        etl.run(spark, part, root, mode="initial", now=NOW)
        read.append(refresh.touched_weeks(commits.state(spark, root)))
        refresh.MOST_REFRESHES = 2 if cut == CUTS[-1] else 16
        refresh.refresh_all(spark, root)
        before = cut
    refresh.MOST_REFRESHES = 16
    return root, read, raw


def test_a_refresh_reads_touched_weeks_and_equals_the_full_form(spark, loaded):
    root, read, raw = loaded
    st = commits.state(spark, root)
    assert refresh.touched_weeks(st) == [] and set(st.partials) == set(st.facts) and len(set(st.partials.values())) == 1
    assert all(read) and len(read[1]) < len(st.facts) / 2 and not set(read[1]) & {"2024-01-22"}
    w = Warehouse.load(spark, root)
    for name in Warehouse.AGGREGATES:
        assert rows(store.read_table(spark, root, name)) == rows(w.aggregate(name, use_snapshot=False))
    out = rollups.aggregate(refresh.states(spark, root, "resumen"), "resumen", w)
    assert rows(out) == rows(w.global_summary())
    # the scan of a refresh lists the directories of its weeks alone
    plan = store.read_facts(spark, root, st, read[1])
    assert {f.split("semana=")[1].split("/")[0] for f in plan.inputFiles()} <= set(read[1])


def test_three_loads_of_one_feed_quarantine_its_rows_once(spark, loaded):
    root, _, raw = loaded
    kept = rows(store.read_quarantine(spark, root).select("source_id", "timestamp", "motivo"))
    assert len(kept) == len(set(kept)) > 0
    for _ in range(2):
        r = etl.run(spark, raw, root, mode="initial", now=NOW)
        assert r["quarantined"] == 0 and r["new_facts"] == 0
    assert rows(store.read_quarantine(spark, root).select("source_id", "timestamp", "motivo")) == kept
    # a row set aside comes back whole: it loads
    bad = raw.filter("battery > 1000 and latitude is not null").orderBy("id").limit(1)
    mended = bad.withColumns({"battery": F.lit(50.0), "device_id": F.lit("dev-1")})
    assert etl.run(spark, mended, root, mode="initial", now=NOW)["new_facts"] == 1


def test_compaction_leaves_one_directory_a_week_and_the_same_rows(spark, loaded, monkeypatch):
    root, _, _ = loaded
    w = Warehouse.load(spark, root)
    facts, cells, kept = rows(w.fact), zones(w), rows(store.read_quarantine(spark, root))
    st = commits.state(spark, root)
    assert sum(map(len, st.facts.values())) > len(st.facts) and st.zone_runs
    # a crash before the commit changes nothing
    real = commits.commit
    monkeypatch.setattr(commits, "commit", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        compact.compact(spark, root)
    monkeypatch.setattr(commits, "commit", real)
    assert commits.state(spark, root) == st and rows(Warehouse.load(spark, root).fact) == facts
    done = compact.compact(spark, root)
    st = commits.state(spark, root)
    assert done["weeks"] > 0 and all(len(r) == 1 for r in st.facts.values()) and not st.zone_runs
    assert len({os.path.dirname(f) for f in store.read_table(spark, root, store.FACT).inputFiles()}) <= len(st.facts)
    w = Warehouse.load(spark, root)
    assert rows(w.fact) == facts and zones(w) == cells and rows(store.read_quarantine(spark, root)) == kept
    assert len(glob.glob(f"{root}/_control/commits/*.json")) == 1
    log = rows(store.control_log(spark, root).select("run_id", "status"))
    assert len(glob.glob(f"{root}/_control/etl_control/*.json")) == 1 and (None, "IDLE") in log
    assert compact.vacuum(spark, root) > 0 and compact.dead_directories(spark, root) == []
    assert rows(Warehouse.load(spark, root).fact) == facts
    assert refresh.touched_weeks(st) == refresh.touched_weeks(commits.state(spark, root))
    assert compact.compact(spark, root)["weeks"] == 0


def test_repair_gives_early_facts_their_members(spark, loaded):
    """Facts stored under key 0: member 0 keeps them in the analytic frame, the repair
    rewrites their weeks and no other, and the changed weeks are refreshed."""
    root, _, raw = loaded
    whole = rows(Warehouse.load(spark, root).fact)
    st = commits.state(spark, root)
    weeks = sorted(st.facts)[:2]
    zeroed = store.read_facts(spark, root, st, weeks).withColumns({
        "dispositivo_id": F.when(F.col("dispositivo_id") % 3 != 0, F.col("dispositivo_id")).otherwise(0),
        "zona_id": F.when(F.col("zona_id") % 4 != 0, F.col("zona_id")).otherwise(0)})
    store.append_facts(zeroed, root, "early")
    commits.commit(spark, root, st, {"kind": "repair", "run": "early", "weeks": weeks})
    w = Warehouse.load(spark, root)
    n = w.fact.count()
    assert n == len(whole) and w.analytic_frame().count() < n
    assert early.with_unknown_members(w).analytic_frame().count() == n
    assert early.with_unknown_members(w).analytic_frame().filter("device_name = 'DESCONOCIDO'").count() == w.fact.filter("dispositivo_id = 0").count()
    done = repair.repair_early_facts(spark, root, raw)
    assert done["weeks"] == 2 and done["early"] > 0
    assert rows(Warehouse.load(spark, root).fact) == whole
    assert set(weeks) <= set(refresh.touched_weeks(commits.state(spark, root)))
    assert repair.repair_early_facts(spark, root, raw) == {"weeks": 0, "early": 0}


def test_extract_selects_without_a_window_and_keeps_ties(spark):
    from covstar.sources.raw import extract
    raw = raw_from_dir(spark, SF)
    tied = raw.withColumn("timestamp", F.date_trunc("hour", "timestamp").cast("timestamp_ntz"))
    for feed in (raw, tied, tied.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))):
        times = sorted(r[0] for r in feed.filter("timestamp is not null").select("timestamp").collect())
        for n in (1, 7, 500, len(times), len(times) + 5):
            part = extract(feed, n)
            plan = part._jdf.queryExecution().executedPlan().toString()
            assert "Window" not in plan and "Exchange" not in plan and "Sort" not in plan
            assert part.count() == sum(t <= times[min(n, len(times)) - 1] for t in times)


def test_rows_of_repeated_keys_are_reduced_apart_from_the_rest(spark):
    from covstar.operators.clean import normalize
    from covstar.operators.dimensions import dedupe_counted, first_per_key
    from covstar.operators.warehouse import with_reason
    rows_ = with_reason(normalize(raw_from_dir(spark, SF)))
    hot = rows_.unionByName(rows_.filter("id = '7'").withColumn("_k", F.explode(F.sequence(F.lit(1), F.lit(3000)))).drop("_k"))
    keys, held = ["source_id", "timestamp", "motivo"], []
    got = dedupe_counted(hot, keys, ["device_id", "signal"], held)
    assert rows(got) == rows(first_per_key(hot, keys, ["device_id", "signal"]).select(*hot.columns))
    plan = got._jdf.queryExecution().executedPlan().toString()
    single = plan.split("Union")[1].split("SortAggregate")[0]
    assert "LeftAnti" in single and "BroadcastHashJoin" in single and "Exchange hashpartitioning" not in single.split("BroadcastExchange")[0]
    assert len(held) == 1
    held[0].unpersist()


def test_zone_increments_hold_the_cells_of_the_batch_only(spark):
    root = tempfile.mkdtemp(prefix="covstar-up-")
    raw = raw_from_dir(spark, SF)
    dense = F.col("latitude") == -17.805
    etl.run(spark, raw.filter((F.col("id").cast("long") % 50) != 0), root, mode="initial", now=NOW)
    first = store.current_version(spark, root, "dim_zonas")
    few = raw.filter((F.col("id").cast("long") % 50 == 0) & dense)
    assert etl.run(spark, few, root, mode="initial", now=NOW)["new_facts"] > 0
    st = commits.state(spark, root)
    assert st.tables["dim_zonas"] == first and len(st.zone_runs) == 1
    assert spark.read.parquet(f"{root}/{store.ZONES_MORE}/run_id={st.zone_runs[0]}").count() == 1
    every = raw.filter(((F.col("id").cast("long") % 50) != 0) | dense)
    assert [z[:4] for z in zones(Warehouse.load(spark, root))] == [z[:4] for z in zones(Warehouse.from_raw(every, now=NOW))]


def test_of_two_racing_writers_one_commits(spark):
    root = tempfile.mkdtemp(prefix="covstar-up-")
    base = commits.state(spark, root)
    won, lost = [], []

    def write(k):
        try:
            won.append(commits.commit(spark, root, base, {"kind": "tables", "tables": {"t": k}}))
        except commits.ConcurrentLoadError:
            lost.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert won == [1] and len(lost) == 7 and commits.state(spark, root).seq == 1


def test_two_racing_loads_give_one_winner_and_one_clean_error(spark):
    root = tempfile.mkdtemp(prefix="covstar-up-")
    raw = raw_from_dir(spark, SF).filter(F.col("timestamp") < F.lit("2024-01-06").cast("timestamp_ntz"))
    results = []
    gate = threading.Barrier(2)

    def load(part):
        gate.wait()
        try:
            results.append(etl.run(spark, part, root, mode="initial", now=NOW)["new_facts"])
        except etl.ConcurrentLoadError as e:
            results.append(e)

    odd = F.col("id").cast("long") % 2 == 1
    threads = [threading.Thread(target=load, args=(p,)) for p in (raw.filter(odd), raw.filter(~odd))]
    [t.start() for t in threads]
    [t.join() for t in threads]
    errors = [r for r in results if isinstance(r, Exception)]
    assert len(errors) == 1 and len(results) == 2
    won = next(r for r in results if not isinstance(r, Exception))
    assert Warehouse.load(spark, root).fact.count() == won
    status = {r.status for r in store.control_log(spark, root).collect()}
    assert {"IDLE", "RUNNING", "OK", "ERROR"} <= status
    # the loser's rerun completes the warehouse
    etl.run(spark, raw, root, mode="initial", now=NOW)
    assert Warehouse.load(spark, root).fact.count() == Warehouse.from_raw(raw, now=NOW).fact.count()
    assert store.control_state(spark, root).first().status == "OK"


def test_the_state_names_weeks_not_loads():
    st = commits.State()
    for k in range(200):
        st.apply({"seq": k + 1, "kind": "load", "run": f"r{k}", "weeks": [f"w{k % 3}"], "tables": {}, "zones": True})
    assert sum(map(len, st.facts.values())) == 200
    st.apply({"seq": 201, "kind": "compact", "run": "c", "weeks": ["w0", "w1"], "folded_zones": st.zone_runs[:150],
              "replaces": [[r, w] for w in ("w0", "w1") for r in st.facts[w]]})
    assert st.facts["w0"] == st.facts["w1"] == ["c"] and len(st.facts["w2"]) == 66 and len(st.zone_runs) == 50
    assert st.changed == {"w0": 199, "w1": 200, "w2": 198}
    st.apply({"seq": 202, "kind": "load", "run": "z", "weeks": ["w9"], "reset": True})
    assert st.facts == {"w9": ["z"]} and st.reset_at == 202 and st.zone_runs == []
