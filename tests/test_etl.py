"""Load job properties: idempotent reruns, k increments = one full load,
overwrite rebuild, control log, refresh snapshots, CSV export round trip."""

import tempfile

import pytest
from pyspark.sql import functions as F

from covstar import Warehouse, raw_from_dir
from covstar.plans import etl, refresh, store
from covstar.plans.zone_build import run_zone_build
from covstar.operators.zones import ZONE_BUILD_COLUMNS

SF = "/root/testdata/sf0.001"
NOW = "2025-01-01 00:00:00"


def _loadable(raw):
    """Rows of the feed that no rule quarantines."""
    key = F.coalesce(F.when(F.col("device_id") != "", F.col("device_id")), F.col("device_name"))
    return raw.dropna(subset=["latitude", "longitude"]).filter(key.isNotNull() & (F.col("battery") < 1000))


def _view_rows(w):
    v = w.full_view(extra=("source_id",))
    return sorted(tuple(r) for r in v.drop("medicion_id").collect())


def _zones(w):
    return sorted(tuple(r) for r in w.dims["dim_zonas"].select("grid_lat", "grid_lon", "total_mediciones",
                                                             "zona_nombre").collect())


@pytest.fixture(scope="module")
def reference(spark):
    return Warehouse.from_raw(raw_from_dir(spark, SF), now=NOW)


def test_increments_equal_full_load_and_rerun_adds_nothing(spark, reference):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    cuts = ["2024-01-08", "2024-01-20"]
    parts = [raw.filter(F.col("timestamp") < F.lit(cuts[0]).cast("timestamp_ntz")),
             raw.filter(F.col("timestamp") < F.lit(cuts[1]).cast("timestamp_ntz")),
             raw]
    r0 = etl.run(spark, parts[0], root, mode="initial", now=NOW)
    r1 = etl.run(spark, parts[1], root, mode="incremental", now=NOW)
    r2 = etl.run(spark, parts[2], root, mode="incremental", now=NOW)
    w = Warehouse.load(spark, root)
    assert r0["new_facts"] + r1["new_facts"] + r2["new_facts"] == reference.fact.count()
    assert _view_rows(w) == _view_rows(reference)
    assert _zones(w) == _zones(reference)
    # a full rerun finds every key already stored
    again = etl.run(spark, raw, root, mode="initial", now=NOW)
    assert again["new_facts"] == 0
    w2 = Warehouse.load(spark, root)
    assert w2.fact.count() == reference.fact.count()
    assert _zones(w2) == _zones(reference)
    # ids stay dense and unique across increments
    d = w2.dims["dim_dispositivo"].agg(F.min("dispositivo_id"), F.max("dispositivo_id"),
                                      F.count_distinct("dispositivo_id"), F.count("*")).first()
    assert d[0] == 1 and d[1] == d[2] == d[3]
    log = store.control_log(spark, root)
    assert log.filter(F.col("status") == "OK").count() == 4


def test_watermark_skips_old_rows(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw, root, mode="initial", now=NOW)
    r = etl.run(spark, raw, root, mode="incremental", now=NOW)
    assert r["valid_rows"] == 0 and r["new_facts"] == 0
    assert r["watermark"] is not None


def test_overwrite_rebuilds(spark, reference):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw.limit(100), root, mode="initial", now=NOW)
    etl.run(spark, raw, root, mode="initial", now=NOW, overwrite=True)
    w = Warehouse.load(spark, root)
    assert _view_rows(w) == _view_rows(reference)


def test_refresh_and_aggregates_match_lazy(spark, reference):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    etl.run(spark, raw_from_dir(spark, SF), root, mode="initial", now=NOW)
    out = refresh.refresh_all(spark, root)
    names = [n for n, _, _ in out["refreshed"]]
    assert names == list(refresh.AGGREGATES)
    got = sorted(tuple(r) for r in refresh.read_aggregate(spark, root, "mv_stats_diarias_operador").collect())
    exp = sorted(tuple(r) for r in reference.daily_operator_stats().collect())
    assert got == exp
    top = refresh.read_aggregate(spark, root, "mv_top_dispositivos").collect()
    assert [r.total_mediciones for r in top] == sorted((r.total_mediciones for r in top), reverse=True)
    assert sum(c for _, c in out["partitions"]) == out["summary"]["total_mediciones"]


def test_zone_export_round_trip(spark):
    out = tempfile.mkdtemp(prefix="covstar-zones-") + "/DIM_ZONAS"
    res = run_zone_build(raw_from_dir(spark, SF), out)
    assert len(res["top"]) == 10 and res["top"][0]["zona_id"] == 1
    schema = ("zona_id long, zona_nombre string, centro_lat double, centro_lon double, total_mediciones long, "
              "altitud_promedio double, grid_latitud_inicio double, grid_latitud_fin double, "
              "grid_longitud_inicio double, grid_longitud_fin double")
    back = store.read_dim_csv(spark, out, schema)
    assert back.columns == ZONE_BUILD_COLUMNS
    assert back.agg(F.sum("total_mediciones")).first()[0] == \
        raw_from_dir(spark, SF).dropna(subset=["latitude", "longitude"]).count()


def test_audit_columns_keep_first_load_time(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    early = raw.filter(F.col("timestamp") < F.lit("2024-01-02").cast("timestamp_ntz"))
    etl.run(spark, early, root, mode="initial", now="2025-01-01 00:00:00")
    first = {r.device_id for r in Warehouse.load(spark, root).dims["dim_dispositivo"].collect()}
    etl.run(spark, raw, root, mode="incremental", now="2025-02-01 00:00:00")
    # dates formatted in Spark (session time zone), not by the Python process
    d = Warehouse.load(spark, root).dims["dim_dispositivo"].select(
        "device_id", F.date_format("created_at", "yyyy-MM-dd").alias("c"),
        F.date_format("updated_at", "yyyy-MM-dd").alias("u")).collect()
    for r in d:
        expect = "2025-01-01" if r.device_id in first else "2025-02-01"
        assert r.c == expect and r.u == expect
    z = Warehouse.load(spark, root).dims["dim_zonas"]
    assert z.filter(F.col("created_at").isNull()).count() == 0


def test_lookback_picks_up_late_rows(spark):
    import datetime as dt
    raw = raw_from_dir(spark, SF).filter(F.col("timestamp") < F.lit("2024-02-01").cast("timestamp_ntz"))
    late = (F.col("id").cast("long") % 10 == 0) & (F.col("timestamp") >= F.lit("2024-01-28").cast("timestamp_ntz"))
    on_time = raw.filter(~late)
    total = Warehouse.from_raw(raw, now=NOW).fact.count()
    for lookback, expect_all in ((None, False), (dt.timedelta(days=5), True)):
        root = tempfile.mkdtemp(prefix="covstar-wh-")
        etl.run(spark, on_time, root, mode="initial", now=NOW)
        r = etl.run(spark, raw, root, mode="incremental", now=NOW, lookback=lookback)
        n = Warehouse.load(spark, root).fact.count()
        assert (n == total) == expect_all
        if expect_all:
            assert r["valid_rows"] > r["new_facts"] > 0   # re-read rows were dropped by the key


def test_new_fact_anti_join_reads_only_touched_range(spark):
    from covstar import functions as X
    from covstar.operators.clean import normalize
    from covstar.operators.maintenance import new_facts
    from covstar.operators.warehouse import accepted_rows
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw, root, mode="initial", now=NOW)
    fact = store.read_table(spark, root, store.FACT)
    lo, hi = "2024-01-25 00:00:00", "2024-01-30 23:59:59"   # the batch lies inside this range
    batch = raw.filter(F.col("timestamp").between(F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")))
    acc = accepted_rows(normalize(batch)).withColumn("semana", X.week_partition("timestamp"))
    nf = new_facts(fact, acc, touched=["2024-01-22", "2024-01-29"],
                   ts_range=(lo, hi))
    plan = nf._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(semana" in plan or "semana" in plan
    assert "GreaterThanOrEqual(timestamp" in plan and "LessThanOrEqual(timestamp" in plan
    assert nf.count() == 0      # everything is stored already


def test_rows_without_device_key_are_quarantined(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    orphan = raw.withColumn("device_id", F.when(F.col("id").cast("long") % 50 == 0, F.lit(None))
                            .otherwise(F.col("device_id"))) \
                .withColumn("device_name", F.when(F.col("id").cast("long") % 50 == 0, F.lit(None))
                            .otherwise(F.col("device_name")))
    r = etl.run(spark, orphan, root, mode="initial", now=NOW, validate=True)
    assert r["violations"] == []          # quarantined rows never reach the fact
    w = Warehouse.load(spark, root)
    q = store.read_quarantine(spark, root)
    assert r["quarantined"] == q.count() > 0
    assert r["new_facts"] == w.fact.count()
    from covstar.operators import audit as D
    assert D.check_fk(w.fact, w.dims["dim_dispositivo"], "dispositivo_id",
                      dim_rows=w.sizes["dim_dispositivo"]).count() == 0


def test_loading_an_empty_root_says_so(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    with pytest.raises(FileNotFoundError):
        Warehouse.load(spark, root)


def test_concurrent_load_is_detected(spark, monkeypatch):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    early = raw.filter(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp_ntz"))
    etl.run(spark, early, root, mode="initial", now=NOW)
    real = store.current_versions
    calls = {"n": 0}

    def racing(spark_, root_):
        calls["n"] += 1
        v = real(spark_, root_)
        if calls["n"] > 1:     # another writer published meanwhile
            v = dict(v, dim_zonas=v.get("dim_zonas", 0) + 1)
        return v

    monkeypatch.setattr(store, "current_versions", racing)
    with pytest.raises(etl.ConcurrentLoadError):
        etl.run(spark, raw, root, mode="incremental", now=NOW)


def test_precomputed_zone_layer_reads_the_snapshot(spark, reference):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    etl.run(spark, raw_from_dir(spark, SF), root, mode="initial", now=NOW)
    w = Warehouse.load(spark, root)
    computed = sorted(tuple(r) for r in w.zone_layer_precomputed().collect())
    refresh.refresh_all(spark, root)
    w = Warehouse.load(spark, root)
    layer = w.zone_layer_precomputed()
    plan = layer._jdf.queryExecution().executedPlan().toString()
    assert "mv_stats_zonas" in plan          # read from the refreshed snapshot
    assert sorted(tuple(r) for r in layer.collect()) == computed


def test_limited_increments_take_the_oldest_rows_first(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = _loadable(raw_from_dir(spark, SF))
    r1 = etl.run(spark, raw, root, mode="initial", limit=100, now=NOW)
    r2 = etl.run(spark, raw, root, mode="incremental", limit=100, now=NOW)
    assert r1["valid_rows"] >= 100 and r2["valid_rows"] >= 100
    fact = Warehouse.load(spark, root).fact.select("source_id", "timestamp").collect()
    last = max(r.timestamp for r in fact)
    assert {r.source_id for r in fact} == {r.id for r in raw.filter(F.col("timestamp") <= F.lit(last)).collect()}


def test_limited_increments_lose_no_row_of_one_timestamp(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = _loadable(raw_from_dir(spark, SF))
    same = raw.withColumn("timestamp", F.date_trunc("day", "timestamp").cast("timestamp_ntz"))
    total = 0
    for _ in range(40):
        n = etl.run(spark, same, root, limit=100, now=NOW)["new_facts"]
        total += n
        if not n:
            break
    assert total == same.select("id", "timestamp").distinct().count()


class Stop(RuntimeError):
    pass


def _state(spark, root):
    w = Warehouse.load(spark, root)
    dangling = w.fact.join(w.dims["dim_zonas"], "zona_id", "left_anti").count()
    return _view_rows(w), _zones(w), w.dims["dim_zonas"].agg(F.sum("total_mediciones")).first()[0], dangling


@pytest.mark.parametrize("where", ["append_facts", "write_version"])
def test_a_load_that_dies_anywhere_is_healed_by_its_rerun(spark, monkeypatch, where):
    root, clean = tempfile.mkdtemp(prefix="covstar-wh-"), tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    early = raw.filter(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp_ntz"))
    for r in (root, clean):
        etl.run(spark, early, r, mode="initial", now=NOW)
    before = _state(spark, root)
    real = getattr(store, where)

    def dies(*a, **k):
        if where == "append_facts":        # the facts are written, the load is not recorded
            real(*a, **k)
        raise Stop()

    monkeypatch.setattr(store, where, dies)
    with pytest.raises(Stop):
        etl.run(spark, raw, root, mode="initial", now=NOW)
    monkeypatch.setattr(store, where, real)
    assert _state(spark, root) == before
    etl.run(spark, raw, root, mode="initial", now=NOW)
    etl.run(spark, raw, clean, mode="initial", now=NOW)
    assert _state(spark, root) == _state(spark, clean)
    assert before[3] == _state(spark, root)[3] == 0


def test_a_load_leaves_no_cached_frame(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    before = len(spark.sparkContext._jsc.getPersistentRDDs())
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw.filter("id < '5'"), root, mode="initial", now=NOW)
    etl.run(spark, raw, root, mode="initial", now=NOW)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= before


def test_null_ids_are_loaded_once(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF).withColumn("id", F.when(F.col("id").cast("long") % 20 != 0, F.col("id")))
    n = etl.run(spark, raw, root, mode="initial", now=NOW)["new_facts"]
    zones = _zones(Warehouse.load(spark, root))
    assert etl.run(spark, raw, root, mode="initial", now=NOW)["new_facts"] == 0
    w = Warehouse.load(spark, root)
    assert w.fact.count() == n and w.fact.filter("source_id is null").count() > 0 and _zones(w) == zones


def test_overwrite_with_an_empty_feed_empties_the_fact(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw, root, mode="initial", now=NOW)
    etl.run(spark, raw.filter("false"), root, mode="initial", now=NOW, overwrite=True)
    w = Warehouse.load(spark, root)
    assert w.fact.count() == 0 and w.dims["dim_zonas"].count() == 0
    etl.run(spark, raw, root, mode="initial", now=NOW)
    assert _zones(Warehouse.load(spark, root)) == _zones(Warehouse.from_raw(raw, now=NOW))


def test_values_beyond_their_types_are_quarantined_with_a_reason(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = _loadable(raw_from_dir(spark, SF))
    k = F.col("id").cast("long") % 200
    bad = raw.withColumns({
        "altitude": F.when(k == 1, F.lit(1e17)).otherwise(F.col("altitude")),
        "latitude": F.when(k == 2, F.lit(123456.0)).when(k == 3, F.lit(1e300)).otherwise(F.col("latitude")),
        "battery": F.when(k == 4, F.lit(5000.0)).otherwise(F.col("battery")),
        "signal": F.when(k == 5, F.lit(float("inf"))).otherwise(F.col("signal"))})
    r = etl.run(spark, bad, root, mode="initial", now=NOW)
    reasons = {x.motivo: x.n for x in store.read_quarantine(spark, root).groupBy("motivo").agg(F.count("*").alias("n")).collect()}
    assert set(reasons) == {"medida_altitud_fuera_de_rango", "coordenada_fuera_de_rango", "medida_bateria_fuera_de_rango",
                            "medida_senal_fuera_de_rango"}
    w = Warehouse.load(spark, root)
    assert r["quarantined"] == sum(reasons.values()) and w.fact.count() == r["new_facts"] > 0
    assert w.fact.filter("latitude is null or longitude is null").count() == 0
    assert etl.run(spark, bad, root, mode="initial", now=NOW)["new_facts"] == 0
    Warehouse.from_raw(bad, now=NOW).dims["dim_zonas"].collect()


def test_fact_ids_do_not_depend_on_the_feed_type(spark):
    raw = raw_from_dir(spark, SF)
    text = raw.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/La_Paz")
    try:
        ids = [{(r.source_id, r.timestamp): r.medicion_id for r in
                Warehouse.from_raw(feed, now=NOW).fact.select("source_id", "timestamp", "medicion_id").collect()}
               for feed in (raw, text)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert ids[0] == ids[1]


def test_snapshot_file_count_follows_size(spark, monkeypatch):
    import glob
    monkeypatch.setattr(store, "ROWS_PER_FILE", 200)
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    big = spark.range(1000).repartition(8)
    store.write_version(big, root, "big", 1, coalesce=store.files_for(1000))
    small = spark.range(150).repartition(8)
    store.write_version(small, root, "small", 1, coalesce=store.files_for(150))
    assert len(glob.glob(f"{root}/big/v=000001/*.parquet")) == 5
    assert len(glob.glob(f"{root}/small/v=000001/*.parquet")) == 1
