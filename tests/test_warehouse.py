"""Warehouse build: constraints (K11), plan shape (broadcast dims, pruning,
no Python UDF), and the analytics on the small fixture."""

import pytest
from pyspark.sql import functions as F

from covstar import Warehouse, raw_from_dir
from covstar.operators import analytics as A
from covstar.operators import audit as D
from covstar.operators import layers as L
from covstar.operators import zones as Z

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_raw(raw_from_dir(spark, SF), now="2025-01-01 00:00:00")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_constraints_hold(wh):
    f = wh.fact
    assert D.check_unique(f, ["source_id", "timestamp"]).count() == 0
    assert D.check_not_null(f, ["timestamp", "tiempo_id", "hora_id", "dispositivo_id", "latitude",
                                "longitude"]).count() == 0
    for key, dim in [("tiempo_id", "dim_tiempo"), ("hora_id", "dim_hora"), ("operador_id", "dim_operador"),
                     ("red_id", "dim_red"), ("calidad_id", "dim_calidad"), ("dispositivo_id", "dim_dispositivo"),
                     ("zona_id", "dim_zonas")]:
        assert D.check_fk(f, wh.dims[dim], key, dim_rows=wh.sizes[dim]).count() == 0, key
    for name, keys in [("dim_operador", ["operador_nombre"]), ("dim_dispositivo", ["device_id"]),
                       ("dim_zonas", ["grid_lat", "grid_lon"]), ("dim_tiempo", ["fecha"])]:
        assert D.check_unique(wh.dims[name], keys).count() == 0


def test_serial_ids_are_dense(wh):
    for name, col in [("dim_operador", "operador_id"), ("dim_red", "red_id"),
                      ("dim_dispositivo", "dispositivo_id"), ("dim_zonas", "zona_id")]:
        r = wh.dims[name].agg(F.min(col), F.max(col), F.count("*")).first()
        assert (r[0], r[1]) == (1, r[2])


def test_fact_ids_unique(wh):
    assert wh.fact.select("medicion_id").distinct().count() == wh.fact.count()


def test_dimension_joins_broadcast_and_no_python(wh):
    plan = _plan(A.kpis(wh.analytic_frame()))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan


def test_unproven_dimension_is_not_broadcast(spark, wh):
    from covstar.operators.joins import dim_join
    facts = spark.range(1000).select((F.col("id") % 90).cast("int").alias("zona_id"))
    unknown = dim_join(facts, wh.dims["dim_zonas"], "zona_id", "inner", dim_rows=None)
    counted = dim_join(facts, wh.dims["dim_zonas"], "zona_id", "inner", dim_rows=wh.sizes["dim_zonas"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" not in _plan(unknown)
        assert "BroadcastHashJoin" in _plan(counted)
        assert unknown.count() == counted.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_date_slice_prunes_fact_weeks(wh):
    af = wh.analytic_frame(date_from="2024-01-02", date_to="2024-01-03")
    df = A.slice(af, date_from="2024-01-02", date_to="2024-01-03")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "semana" in plan and "2024-01-01" in plan and "20240102" in plan
    assert df.count() == af.filter(F.col("fecha").between("2024-01-02", "2024-01-03")).count()


def test_slicers(wh):
    af = wh.analytic_frame()
    total = af.count()
    assert A.slice(af).count() == total
    assert A.slice(af, hour_from="06:00").count() == total            # one bound only: ignored
    assert A.slice(af, hour_from="18:00", hour_to="06:00").count() == 0  # no midnight wrap
    n = A.slice(af, operador="Todos", red="4G").count()
    assert n == af.filter(F.col("red_normalizada") == "4G").count()


def test_pivot_matches_counts(wh):
    af = wh.analytic_frame()
    m = A.day_part_matrix(af)
    cells = m.select(*[F.coalesce(F.col(c), F.lit(0)) for c in m.columns[1:]]).collect()
    assert sum(sum(r) for r in cells) == af.count()


def test_samples_exact_and_reproducible(wh):
    af = wh.analytic_frame()
    a = L.sample_n(af, 300, seed=3).select("source_id").collect()
    b = L.sample_n(af, 300, seed=3).select("source_id").collect()
    assert len(a) == 300 and a == b
    assert L.sample_n(af, 10 ** 6).count() == af.count()
    assert L.points_layer(af).count() == af.count() and L.points_layer(af, 123).count() == 123
    for n in (0, 1, 300, 777):
        assert L.heat_layer(af, n).count() == min(n, af.count())


def test_samples_order_rows_without_a_key_like_any_other(wh):
    af = wh.analytic_frame().withColumn("source_id", F.when(F.col("source_id").cast("long") % 3 != 0, F.col("source_id")))
    h = L.sample_hash(5)
    full = [(r.source_id, r.timestamp) for r in af.withColumn("_h", h).orderBy("_h", "source_id", "timestamp").limit(300).collect()]
    for digits in (1, 4):
        got = [(r.source_id, r.timestamp) for r in L.sample_n(af, 300, seed=5, digits=digits).collect()]
        assert sorted(got, key=str) == sorted(full, key=str)


def test_results_come_in_their_order(wh):
    from covstar.operators import analytics as A
    af = wh.analytic_frame(ordered=True)
    rows = [(r.timestamp, r.source_id) for r in af.collect()]
    assert rows == sorted(sorted(rows, key=lambda r: r[1]), key=lambda r: r[0], reverse=True)
    counts = [(-r.mediciones, r.nombre_dia) for r in A.value_counts(af, "nombre_dia").collect()]
    assert counts == sorted(counts) and len(counts) == 7
    means = [r.senal_promedio for r in A.signal_by_operator(af).collect()]
    assert means == sorted(means, reverse=True)
    zones = [(-r.total_mediciones, r.zona_id) for r in wh.zone_layer_precomputed().collect()]
    assert zones == sorted(zones)
    top = [(-r.total_mediciones, r.dispositivo_id) for r in wh.top_devices().collect()]
    assert top == sorted(top)


def test_trails_and_endpoints(wh):
    af = wh.analytic_frame()
    ends = {r.device_name: r for r in L.trail_endpoints(af).collect()}
    t = L.device_trails(af).collect()
    first = {}
    for r in t:
        first.setdefault(r.device_name, r)
    for name, r in first.items():
        assert (float(r.latitude), float(r.longitude)) == (ends[name].inicio_lat, ends[name].inicio_lon)


def test_zone_build_ranks(spark):
    z = Z.build_zones(raw_from_dir(spark, SF)).orderBy("zona_id").collect()
    counts = [r.total_mediciones for r in z]
    assert counts == sorted(counts, reverse=True)
    assert [r.zona_id for r in z] == list(range(1, len(z) + 1))


def test_multi_id_models_list_form(spark):
    raw = raw_from_dir(spark, SF)
    lists = D.multi_id_models(raw, as_list=True).collect()
    assert all(len(r.device_ids) == r.num_ids > 1 for r in lists)
    long = D.multi_id_models(raw).count()
    assert long == sum(r.num_ids for r in lists)


def test_distributed_numbering_equals_window(spark):
    from covstar.operators.dimensions import dense_number
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("k"), F.col("id").cast("string").alias("s"))
    one = {r.k: r.n for r in dense_number(df, ["k"], "n", base=10, n_rows=5000).collect()}
    many = {r.k: r.n for r in dense_number(df, ["k"], "n", base=10, per_bucket=300).collect()}
    assert one == many
    assert sorted(one.values()) == list(range(11, 5011))
    two = dense_number(df, [-F.col("k"), "s"], "n", per_bucket=700)
    assert [r.k for r in two.orderBy("n").collect()] == sorted(one, reverse=True)
    assert dense_number(df.filter("false"), ["k"], "n").count() == 0


def test_sample_cutoff_equals_full_top_n(wh):
    af = wh.analytic_frame()
    h = L.sample_hash(11)
    full = [r.source_id for r in af.withColumn("_h", h).orderBy("_h", "source_id", "timestamp").limit(200).collect()]
    fast = {r.source_id for r in L.sample_n(af, 200, seed=11).collect()}
    assert set(full) == fast and len(fast) == 200


def test_warehouse_checks_find_violations(spark, wh):
    from dataclasses import replace
    clean = {(r.tabla, r.regla): r.violaciones for r in D.warehouse_checks(wh).collect()}
    assert set(clean.values()) == {0} and len(clean) == 26
    # break it: one unknown zone, one NULL hour, one duplicated fact key
    f = wh.fact
    one = f.limit(1)
    broken = f.unionByName(one.withColumn("zona_id", F.lit(99999))) \
              .unionByName(one.withColumn("hora_id", F.lit(None).cast("int")).withColumn("source_id", F.lit("x")))
    got = {(r.tabla, r.regla): r.violaciones for r in D.warehouse_checks(replace(wh, fact=broken)).collect()}
    assert got[("fact_mediciones", "fk:zona_id->dim_zonas")] == 1
    assert got[("fact_mediciones", "not_null:hora_id")] == 1
    assert got[("fact_mediciones", "unique:source_id,timestamp")] == 1
