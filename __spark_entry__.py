"""
(the same results as DuckDB SQL over the shipped tables).

Every query reads the shipped tables (``events`` through the adapter, the
warehouse derived from it) in full. Query outputs never contain the fact's
hash id ``medicion_id`` (a Spark ``xxhash64`` no SQL engine reproduces); the
fact's natural key ``source_id`` identifies rows instead.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from covstar import functions as X  # noqa: E402
from covstar.operators import analytics as A  # noqa: E402
from covstar.operators import audit as D  # noqa: E402
from covstar.operators import early as EF  # noqa: E402
from covstar.operators.audit import DIM_UNIQUE, FACT_FOREIGN_KEYS, FACT_NOT_NULL  # noqa: E402
from covstar.operators.increment import increment_checks  # noqa: E402
from covstar.operators import layers as L  # noqa: E402
from covstar.operators import maintenance as M  # noqa: E402
from covstar.operators import rollups as R  # noqa: E402
from covstar.operators import zones as Z  # noqa: E402
from covstar.operators.clean import normalize  # noqa: E402
from covstar.operators.dimensions import (DIM_COLUMNS, assign_ids, dense_number, device_members,  # noqa: E402
                                          zone_members, zone_stats)
from covstar.operators.pyramid import zoom_pyramid  # noqa: E402
from covstar.operators.warehouse import Warehouse, accepted_rows, materialize, to_fact_rows  # noqa: E402
from covstar.plans.oracle_sql import (CLASS_COLOR_SQL, MEAN_COLOR_SQL,  # noqa: E402
                                      SIGNAL_CLASS_SQL, avg2, round_dec, with_pipeline,
                                      zone_stats_sql)
from covstar.session import checkpoint_dir, compiled_stages, cut_lineage, session_key  # noqa: E402
from covstar.sources import raw as S  # noqa: E402
from covstar.sources.adapter import raw_from_dir  # noqa: E402
from covstar.sources.pages import export_pages  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"
FIXED_NOW = "2025-01-01 00:00:00"
SPLIT_TS = "2024-01-15 00:00:00"      # increment tests: first load before, second from here
WATERMARK = "2024-01-20 00:00:00"
PAGES_FROM = "2024-01-08T00:00:00.000000"    # as the pages write it
DEVICE_SPLIT_TS = "2024-01-01 06:00:00"   # device increments: few devices are known this early
SLICE = dict(date_from="2024-01-05", date_to="2024-01-20", hour_from="06:00", hour_to="18:00",
             operador="ENTEL")
DEVICE = "MODEL 3"
ZOOMS = (3, 13)
PLANT_NULL, PLANT_KEY, PLANT_TWICE, NO_MEMBER = 61, 67, 71, 900_000
INCREMENT_WEEK = "2024-01-15"

_CACHE: dict = {}


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    compiled_stages(spark)
    return raw_from_dir(spark, sf_dir)


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The warehouse of ``sf_dir``, built once per application: dimensions
    are materialised; the fact is checkpointed once into the session's shared
    checkpoint folder when one is named, else it stays a lazy plan."""
    key = (session_key(spark), sf_dir)
    if key not in _CACHE:
        _CACHE[key] = Warehouse.from_raw(_raw(spark, sf_dir), now=FIXED_NOW, materialize_fact=True)
    return _CACHE[key]


def _shared(spark: SparkSession) -> str:
    """The shared folder of the session; on a local master without one a folder of its warehouse."""
    d = checkpoint_dir(spark)
    master = spark.sparkContext.master
    if d is None and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return (d or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_covstar").rstrip("/")


def _af(spark, sf_dir, **kw) -> DataFrame:
    return _wh(spark, sf_dir).analytic_frame(**kw).drop("medicion_id")


def _placed(df: DataFrame, *order) -> DataFrame:
    """The rows with their place in the order they are returned in (numbered by
    buckets, never in one task), so that a comparison of sets covers the order."""
    return dense_number(df, list(order), "orden", id_type="long")


def _dbl(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in cols})


# --------------------------------------------------------------- the queries

def q_daily_operator_stats(spark, d):
    return _wh(spark, d).daily_operator_stats()


def q_normalized_measurements(spark, d):
    n = normalize(_raw(spark, d))
    return n.select("id", "timestamp", "device_id", "operador_normalizado", "red_normalizada",
                    "calidad_senal", "grid_lat", "grid_lon", "zona_altitud", "speed_kmh", "sector_id",
                    "fecha", "hora", "tiempo_id")


def q_paged_measurements(spark, d):
    """The feed exported as two batches of pages, read back from a watermark on and normalised."""
    raw, path, at = _raw(spark, d), f"{_shared(spark)}/pages-{uuid.uuid4().hex[:12]}", F.lit(SPLIT_TS).cast("timestamp_ntz")
    export_pages(raw.filter(F.col("timestamp") < at), path, 1)
    export_pages(raw.filter(F.col("timestamp") >= at), path, 2)
    pages = S.since(S.read_measurements(spark, path, "measurement_pages"), PAGES_FROM)
    n = normalize(pages).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
    return n.select("id", "timestamp", "device_id", "operador_normalizado", "red_normalizada", "calidad_senal",
                    "grid_lat", "grid_lon", "zona_altitud", "speed_kmh", "sector_id", "fecha", "hora", "tiempo_id")


def q_signal_class_ids(spark, d):
    r = _raw(spark, d)
    return r.select("id", "signal", X.signal_class("signal").alias("calidad_senal"),
                    X.signal_class_id("signal").alias("calidad_id"))


def q_calendar_dim(spark, d):
    t = _wh(spark, d).dims["dim_tiempo"]
    return t.withColumn("es_fin_semana", X.weekend_flag("dia_semana"))


def q_hour_dim(spark, d):
    h = _wh(spark, d).dims["dim_hora"]
    return h.withColumn("etiqueta", X.hour_label("hora")).withColumn("hora_leida", X.parse_hour("etiqueta"))


def q_operator_dim(spark, d):
    return _wh(spark, d).dims["dim_operador"]


def q_network_dim(spark, d):
    return _wh(spark, d).dims["dim_red"]


def q_quality_dim(spark, d):
    """The seeded quality classes with the number of facts in each (a left
    join: a class without facts keeps its row with 0)."""
    w = _wh(spark, d)
    counts = w.fact.groupBy("calidad_id").agg(F.count(F.lit(1)).alias("mediciones"))
    q = w.dims["dim_calidad"].join(counts, "calidad_id", "left")
    return q.withColumn("mediciones", F.coalesce(F.col("mediciones"), F.lit(0)))


def q_device_dim(spark, d):
    return _wh(spark, d).dims["dim_dispositivo"]


def q_zone_dim(spark, d):
    return _wh(spark, d).dims["dim_zonas"]


def q_fact_rows(spark, d):
    f = _wh(spark, d).fact.drop("medicion_id", "etl_loaded_at")
    return _dbl(f, "medida_senal", "medida_velocidad", "medida_altitud", "medida_bateria",
                "latitude", "longitude")


def q_full_view(spark, d):
    # the natural key replaces the hash id (see module doc)
    v = _wh(spark, d).full_view(extra=("source_id",)).drop("medicion_id")
    return _dbl(v, "latitude", "longitude", "medida_senal", "medida_velocidad", "medida_altitud",
                "medida_bateria")


def q_analytic_frame(spark, d):
    return _af(spark, d)


def q_sample_labels(spark, d):
    return _wh(spark, d).sample_labels(5).drop("medicion_id")


def q_zone_layer_precomputed(spark, d):
    return _placed(_wh(spark, d).zone_layer_precomputed(), -F.col("total_mediciones"), "zona_id")


def q_zone_summary(spark, d):
    return _wh(spark, d).zone_summary()


def q_top_devices(spark, d):
    return _placed(_wh(spark, d).top_devices(), -F.col("total_mediciones"), "dispositivo_id")


def q_global_summary(spark, d):
    return _wh(spark, d).global_summary()


def q_header_counts(spark, d):
    return A.header_counts(_af(spark, d), _wh(spark, d).dims["dim_operador"])


def q_partition_counts(spark, d):
    return _wh(spark, d).partition_counts()


def q_partition_counts_reference(spark, d):
    return _wh(spark, d).partition_counts(reference_bounds=True)


def q_table_counts(spark, d):
    return _wh(spark, d).table_counts()


def q_kpis(spark, d):
    return A.kpis(_af(spark, d))


def q_kpis_sliced(spark, d):
    w = _wh(spark, d)
    af = w.analytic_frame(date_from=SLICE["date_from"], date_to=SLICE["date_to"]).drop("medicion_id")
    return A.kpis(A.slice(af, **SLICE))


def q_operator_counts(spark, d):
    return _placed(A.value_counts(_af(spark, d), "operador_normalizado"), -F.col("mediciones"), "operador_normalizado")


def q_quality_counts(spark, d):
    return _placed(A.value_counts(_af(spark, d), "calidad_senal"), -F.col("mediciones"), "calidad_senal")


def q_weekday_counts(spark, d):
    return _placed(A.value_counts(_af(spark, d), "nombre_dia"), -F.col("mediciones"), "nombre_dia")


def q_day_part_counts(spark, d):
    return _placed(A.value_counts(_af(spark, d), "franja_horaria"), -F.col("mediciones"), "franja_horaria")


def q_operator_share(spark, d):
    return A.operator_share(_af(spark, d))


def q_signal_by_operator(spark, d):
    return _placed(A.signal_by_operator(_af(spark, d)), F.isnull("senal_promedio"), -F.col("senal_promedio"), "operador_normalizado")


def q_zone_layer(spark, d):
    w = _wh(spark, d)
    return A.zone_layer(A.slice(_af(spark, d), red="4G"), w.dims["dim_zonas"], w.sizes["dim_zonas"])


def q_zone_layer_all(spark, d):
    w = _wh(spark, d)
    return A.zone_layer(_af(spark, d), w.dims["dim_zonas"], w.sizes["dim_zonas"])


def q_daily_evolution(spark, d):
    af = _wh(spark, d).analytic_frame()
    return A.daily_evolution(af)


def q_day_part_matrix(spark, d):
    return A.day_part_matrix(_af(spark, d))


def q_device_kpis(spark, d):
    return A.device_kpis(_af(spark, d))


def q_centroid(spark, d):
    return A.centroid(_af(spark, d))


def q_device_centroids(spark, d):
    return A.centroid(_af(spark, d), by="device_name")


def q_filter_domains(spark, d):
    return A.filter_domains(_af(spark, d))


def q_points_layer_rows(spark, d):
    return L.points_columns(_wh(spark, d).analytic_frame()).drop("medicion_id", "source_id", "timestamp")


def q_heat_layer_rows(spark, d):
    af = _wh(spark, d).analytic_frame().select("medicion_id", "source_id", "timestamp", "latitude", "longitude",
                                               "medida_senal")
    return L.heat_columns(af).drop("medicion_id", "source_id", "timestamp")


def q_cluster_layer(spark, d):
    return L.cluster_layer(_wh(spark, d).analytic_frame()).drop("medicion_id")


def q_cluster_cells(spark, d):
    return L.cluster_layer(_af(spark, d), cell=0.05)


def q_device_trails(spark, d):
    return _placed(L.device_trails(_af(spark, d)), "device_name", "timestamp", "source_id")


def q_trail_endpoints(spark, d):
    return L.trail_endpoints(_af(spark, d))


def q_device_timeline(spark, d):
    return _placed(L.device_timeline(_af(spark, d)), "device_name", "timestamp", "source_id")


def q_device_log(spark, d):
    return L.device_log(_af(spark, d), DEVICE)


def q_heat_sample(spark, d):
    return L.heat_layer(_wh(spark, d).analytic_frame(), 2000, seed=7).drop("medicion_id")


def q_points_sample(spark, d):
    return L.points_layer(_wh(spark, d).analytic_frame(), 4000, seed=7).drop("medicion_id")


def q_operator_list(spark, d):
    return _wh(spark, d).dim_list("operador")


def q_device_list(spark, d):
    return _wh(spark, d).dim_list("dispositivo")


def q_zone_stats_floor(spark, d):
    """A2 with true cells (``floor``): each cell's bounds contain its points."""
    n = normalize(_raw(spark, d), grid_mode="floor")
    return zone_members(zone_stats(n, cells_ready=True))


def q_zone_build(spark, d):
    return Z.build_zones(_raw(spark, d))


def q_top_zones(spark, d):
    return Z.top_zones(Z.build_zones(_raw(spark, d)), 10)


def q_zone_build_summary(spark, d):
    return Z.zone_build_summary(Z.build_zones(_raw(spark, d)))


def q_devices_without_data(spark, d):
    return _placed(_wh(spark, d).devices_without_data(), "device_name", "dispositivo_id")


def q_device_reconciliation(spark, d):
    return _wh(spark, d).device_reconciliation()


def q_multi_id_models(spark, d):
    return D.multi_id_models(S.device_columns(_raw(spark, d)))


def q_device_completeness(spark, d):
    return D.device_completeness(S.device_columns(_raw(spark, d)))


def q_device_pairs(spark, d):
    return _placed(D.device_pairs(S.device_columns(_raw(spark, d))), "device_id", "device_name")


def q_not_null_violations(spark, d):
    return D.check_not_null(_raw(spark, d), ["latitude", "longitude", "timestamp"])


def q_fact_key_violations(spark, d):
    return D.check_unique(_wh(spark, d).fact, ["source_id", "timestamp"])


def q_zone_fk_violations(spark, d):
    w = _wh(spark, d)
    f = w.fact.select("source_id", "zona_id")
    return D.check_fk(f, w.dims["dim_zonas"], "zona_id", dim_rows=w.sizes["dim_zonas"])


def q_warehouse_checks(spark, d):
    return D.warehouse_checks(_wh(spark, d))


def q_high_watermark(spark, d):
    return S.high_watermark(_wh(spark, d).fact)


def q_incremental_scan(spark, d):
    return S.since(_raw(spark, d), WATERMARK)


def q_bounded_extract(spark, d):
    return S.extract(_raw(spark, d), 1000)


def _halves(spark, d, split=SPLIT_TS):
    n = normalize(_raw(spark, d))
    first = n.filter(F.col("timestamp") < F.lit(split).cast("timestamp_ntz"))
    second = n.filter(F.col("timestamp") >= F.lit(split).cast("timestamp_ntz"))
    return n, first, second


def q_insert_ignore_devices(spark, d):
    n, first, _ = _halves(spark, d, DEVICE_SPLIT_TS)
    return M.insert_ignore(device_members(first), device_members(n), ["device_id"])


def q_assign_ids_increment(spark, d):
    n, first, _ = _halves(spark, d, DEVICE_SPLIT_TS)
    existing = assign_ids(device_members(first), "dispositivo_id", ["device_id"])
    new = M.insert_ignore(existing, device_members(n), ["device_id"])
    return assign_ids(new.select("device_id", "device_name"), "dispositivo_id", ["device_id"], existing)


def q_late_members(spark, d):
    """Facts after the split resolve their device against the dimension
    built before it; unseen devices are late members, inserted with ids after
    the largest (K1 + K4), and every fact then resolves."""
    n, first, second = _halves(spark, d, DEVICE_SPLIT_TS)
    existing = assign_ids(device_members(first), "dispositivo_id", ["device_id"])
    late = M.insert_ignore(existing, device_members(second), ["device_id"])
    late = assign_ids(late.select("device_id", "device_name"), "dispositivo_id", ["device_id"], existing)
    dim = existing.unionByName(late)
    facts = accepted_rows(second).select("source_id", "device_id")
    return facts.join(dim.select("device_id", "dispositivo_id"), "device_id", "left")


def q_upsert_zones(spark, d):
    _, first, second = _halves(spark, d)
    old = zone_members(zone_stats(accepted_rows(first), cells_ready=True))
    delta = zone_members(zone_stats(accepted_rows(second), cells_ready=True))
    return M.upsert_accumulate(old, delta, ["grid_lat", "grid_lon"], ["total_mediciones"])


def q_new_facts(spark, d):
    n, first, _ = _halves(spark, d)
    old = accepted_rows(first).withColumn("semana", X.week_partition("timestamp"))
    new = accepted_rows(n).withColumn("semana", X.week_partition("timestamp"))
    return M.new_facts(old, new).select("source_id", "timestamp", "semana")


def _from_weeks(spark, d, name):
    """K8: an aggregate merged from the partial states of the single weeks."""
    w = _wh(spark, d)
    return R.aggregate(R.partial_state(w.fact, name, ("semana",)).drop("semana"), name, w)


def q_merged_daily_operator_stats(spark, d):
    return _from_weeks(spark, d, "mv_stats_diarias_operador")


def q_merged_zone_summary(spark, d):
    return _from_weeks(spark, d, "mv_stats_zonas")


def q_merged_top_devices(spark, d):
    return _from_weeks(spark, d, "mv_top_dispositivos")


def q_merged_global_summary(spark, d):
    return _from_weeks(spark, d, "resumen")


def q_zoom_pyramid(spark, d):
    return zoom_pyramid(_af(spark, d), finest=ZOOMS[1], coarsest=ZOOMS[0])


def q_early_facts(spark, d):
    """Facts loaded before their device or zone is known, under member 0,
    and the same facts after the repair by the members that came late."""
    _, first, second = _halves(spark, d, DEVICE_SPLIT_TS)
    w = _wh(spark, d)
    accepted = cut_lineage(accepted_rows(second))     # one dedupe serves the zones, the facts and the feed of the repair
    grown, before_sizes, after_sizes = {}, dict(w.sizes), dict(w.sizes)
    for name, id_col, keys, early, come in (
            ("dim_dispositivo", "dispositivo_id", ["device_id"], device_members(first), device_members(second)),
            ("dim_zonas", "zona_id", ["grid_lat", "grid_lon"], *[zone_members(zone_stats(n, cells_ready=True))
                                                                 for n in (accepted_rows(first), accepted)])):
        early, n_early = materialize(early)
        known, before_sizes[name] = materialize(assign_ids(early, id_col, keys, n_rows=n_early).select(*DIM_COLUMNS[name]))
        late, n_late = materialize(M.insert_ignore(known, come.select(*[c for c in DIM_COLUMNS[name] if c != id_col]), keys))
        late = assign_ids(late, id_col, keys, known, n_late).select(*DIM_COLUMNS[name])
        grown[name] = (known, known.unionByName(late))
        after_sizes[name] = before_sizes[name] + n_late
    before = to_fact_rows(accepted, w.dims | {n: k for n, (k, _) in grown.items()}, before_sizes, FIXED_NOW)
    after = EF.repaired(before, accepted, w.dims | {n: g for n, (_, g) in grown.items()}, after_sizes)
    named = EF.with_unknown_member(grown["dim_dispositivo"][0], "dim_dispositivo").select(
        F.col("dispositivo_id").alias("dispositivo_antes"), F.col("device_name").alias("nombre_antes"))
    old = before.select("source_id", "timestamp", F.col("dispositivo_id").alias("dispositivo_antes"), F.col("zona_id").alias("zona_antes"))
    new = after.select(F.col("source_id").alias("_s"), F.col("timestamp").alias("_t"), F.col("dispositivo_id").alias("dispositivo_despues"),
                       F.col("zona_id").alias("zona_despues"))
    return (old.join(named, "dispositivo_antes")
            .join(new, F.col("source_id").eqNullSafe(F.col("_s")) & (F.col("timestamp") == F.col("_t"))).drop("_s", "_t"))


def _planted(spark, d):
    """The warehouse with faults planted by the fact's source id: a NULL in each
    NOT NULL column, a key without member in each foreign key, repeated fact keys,
    repeated members in every dimension."""
    w = _wh(spark, d)
    n = F.col("source_id").cast("long")
    f = w.fact
    f = f.unionByName(f.filter(n % PLANT_TWICE == 0))
    f = f.withColumns({c: F.when(n % PLANT_NULL != i, F.col(c)) for i, c in enumerate(FACT_NOT_NULL)})
    f = f.withColumns({k: F.when(n % PLANT_KEY == i, F.lit(NO_MEMBER)).otherwise(F.col(k)) for i, (k, _) in enumerate(FACT_FOREIGN_KEYS)})
    first = {name: keys for name, keys in reversed(DIM_UNIQUE)}
    dims = {name: dim.unionByName(dim.orderBy(*first[name]).limit(2)) for name, dim in w.dims.items()}
    return Warehouse(spark, dims, f, {})


def q_planted_violations(spark, d):
    return D.warehouse_checks(_planted(spark, d))


def q_increment_violations(spark, d):
    """K11 on one load: the planted facts from the split on, against all of them."""
    w = _planted(spark, d)
    new = w.fact.filter(F.col("semana") >= INCREMENT_WEEK)
    return increment_checks(new, w.fact, w.dims, w.sizes, new.count())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in dict(globals()).items() if name.startswith("q_") and callable(fn)
}


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: daily x operator coverage statistics at sf0.001."""
    return q_daily_operator_stats(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data subpackage, none where it is not installed."""
    try:
        import corpus_pipeline

        from covstar.llm.queries import ORACLE_SQL, QUERIES as llm_queries
    except ModuleNotFoundError as e:
        if e.name not in ("corpus_pipeline", "covstar.llm", "covstar.llm.queries"):
            raise               # installed, but a library of it is missing
        return {}, {}
    sql = ORACLE_SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
    return llm_queries | {"pipeline": corpus_pipeline.run}, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | _training_data()[0]


# ------------------------------------------------------------- oracle (SQL)

_SIGNAL_ID = ("CASE WHEN signal IS NULL THEN NULL WHEN signal >= -70 THEN 1 WHEN signal >= -85 THEN 2 "
              "WHEN signal >= -95 THEN 3 WHEN signal >= -105 THEN 4 ELSE 5 END")
_SLICE_SQL = ("fecha BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND hora BETWEEN 6 AND 18 "
              "AND operador_normalizado = 'ENTEL'")
_HALVES_SQL = """
n1 AS (SELECT * FROM norm WHERE "timestamp" < TIMESTAMP '2024-01-15 00:00:00'),
n2 AS (SELECT * FROM norm WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00'),
acc1 AS (SELECT * FROM acc WHERE "timestamp" < TIMESTAMP '2024-01-15 00:00:00'),
acc2 AS (SELECT * FROM acc WHERE "timestamp" >= TIMESTAMP '2024-01-15 00:00:00'),
dev_all AS (SELECT device_id, min(device_name) AS device_name FROM norm WHERE device_id IS NOT NULL GROUP BY device_id),
dev1 AS (SELECT device_id, min(device_name) AS device_name FROM norm
         WHERE "timestamp" < TIMESTAMP '2024-01-01 06:00:00' AND device_id IS NOT NULL GROUP BY device_id),
zone_old AS (""" + zone_stats_sql("acc1") + """),
zone_new AS (""" + zone_stats_sql("acc2") + """)"""


def _zone_named(src: str) -> str:
    return f"""SELECT grid_lat, grid_lon, total_mediciones, centro_lat, centro_lon, altitud_promedio,
      'ZONA_' || CAST(grid_lat AS VARCHAR) || '_' || CAST(grid_lon AS VARCHAR) AS zona_nombre,
      round(grid_lat * 0.02::DOUBLE, 6) AS grid_latitud_inicio, round((grid_lat + 1) * 0.02::DOUBLE, 6) AS grid_latitud_fin,
      round(grid_lon * 0.02::DOUBLE, 6) AS grid_longitud_inicio, round((grid_lon + 1) * 0.02::DOUBLE, 6) AS grid_longitud_fin
    FROM {src}"""


_ZONE_BUILD_SQL = """
zb_stats AS (""" + zone_stats_sql("(SELECT * FROM raw WHERE latitude IS NOT NULL AND longitude IS NOT NULL)", "0.04") + """),
zb AS (
  SELECT CAST(row_number() OVER (ORDER BY total_mediciones DESC, grid_lat, grid_lon) AS BIGINT) AS zona_id, *
  FROM zb_stats
),
zones AS (
  SELECT zona_id,
    'ZONA_' || CAST(zona_id AS VARCHAR) || '_' ||
      CASE WHEN total_mediciones >= 2000 THEN 'ALTA' WHEN total_mediciones >= 500 THEN 'MEDIA' ELSE 'BAJA' END AS zona_nombre,
    centro_lat, centro_lon, total_mediciones, altitud_promedio,
    grid_lat * 0.04::DOUBLE AS grid_latitud_inicio, (grid_lat + 1) * 0.04::DOUBLE AS grid_latitud_fin,
    grid_lon * 0.04::DOUBLE AS grid_longitud_inicio, (grid_lon + 1) * 0.04::DOUBLE AS grid_longitud_fin,
    grid_lat, grid_lon
  FROM zb
)"""

def _checks_sql() -> str:
    from covstar.operators.audit import DIM_UNIQUE, FACT_FOREIGN_KEYS, FACT_NOT_NULL
    dim_alias = {"dim_tiempo": "d_tiempo", "dim_hora": "d_hora", "dim_operador": "d_operador", "dim_red": "d_red",
                 "dim_calidad": "d_calidad", "dim_dispositivo": "d_dispositivo", "dim_zonas": "d_zonas"}
    q = []
    for c in FACT_NOT_NULL:
        q.append(f"SELECT 'fact_mediciones' AS tabla, 'not_null:{c}' AS regla, count(*) AS violaciones "
                 f"FROM fact WHERE \"{c}\" IS NULL")
    q.append("SELECT 'fact_mediciones', 'unique:source_id,timestamp', count(*) FROM "
             "(SELECT 1 FROM fact GROUP BY source_id, \"timestamp\" HAVING count(*) > 1)")
    for key, dim in FACT_FOREIGN_KEYS:
        t = dim_alias[dim]
        q.append(f"SELECT 'fact_mediciones', 'fk:{key}->{dim}', count(*) FROM fact f WHERE f.{key} IS NOT NULL "
                 f"AND NOT EXISTS (SELECT 1 FROM {t} d WHERE d.{key} = f.{key})")
    for dim, keys in DIM_UNIQUE:
        cols = ", ".join(keys)
        q.append(f"SELECT '{dim}', 'unique:{','.join(keys)}', count(*) FROM "
                 f"(SELECT 1 FROM {dim_alias[dim]} GROUP BY {cols} HAVING count(*) > 1)")
    return "\nUNION ALL ".join(q)


_WAREHOUSE_CHECKS_SQL = _checks_sql()

_AF_COLS = ("source_id, \"timestamp\", latitude, longitude, medida_senal, medida_altitud, zona_id, zona_altitud, "
            "dispositivo_id, fecha, nombre_dia, mes, anio, hora, franja_horaria, operador_normalizado, "
            "red_normalizada, calidad_senal, device_name")

_P = with_pipeline

ORACLE: dict[str, str] = {
    "daily_operator_stats": _P(f"""
SELECT t.fecha, t.anio, t.mes, t.nombre_dia, o.operador_nombre, a.total_mediciones, a.senal_promedio,
       a.senal_minima, a.senal_maxima, a.mediciones_excelente, a.mediciones_buena, a.mediciones_regular,
       a.mediciones_mala, a.mediciones_critica, a.dispositivos_unicos
FROM (
  SELECT tiempo_id, operador_id, count(*) AS total_mediciones, {avg2('medida_senal')} AS senal_promedio,
    CAST(min(medida_senal) AS DOUBLE) AS senal_minima, CAST(max(medida_senal) AS DOUBLE) AS senal_maxima,
    count(*) FILTER (WHERE calidad_id = 1) AS mediciones_excelente,
    count(*) FILTER (WHERE calidad_id = 2) AS mediciones_buena,
    count(*) FILTER (WHERE calidad_id = 3) AS mediciones_regular,
    count(*) FILTER (WHERE calidad_id = 4) AS mediciones_mala,
    count(*) FILTER (WHERE calidad_id = 5) AS mediciones_critica,
    count(DISTINCT dispositivo_id) AS dispositivos_unicos
  FROM fact GROUP BY tiempo_id, operador_id) a
JOIN d_tiempo t ON a.tiempo_id = t.tiempo_id
JOIN d_operador o ON a.operador_id = o.operador_id"""),

    "normalized_measurements": _P("""
SELECT id, "timestamp", device_id, operador_normalizado, red_normalizada, calidad_senal, grid_lat, grid_lon,
       zona_altitud, speed_kmh, sector_id, fecha, hora, tiempo_id FROM norm"""),

    "paged_measurements": _P("""
SELECT id, "timestamp", device_id, operador_normalizado, red_normalizada, calidad_senal, grid_lat, grid_lon,
       zona_altitud, speed_kmh, sector_id, fecha, hora, tiempo_id FROM norm WHERE "timestamp" > TIMESTAMP '2024-01-08 00:00:00'"""),

    "signal_class_ids": _P(f"""
SELECT id, signal, {SIGNAL_CLASS_SQL.format(s='signal')} AS calidad_senal, {_SIGNAL_ID} AS calidad_id FROM raw"""),

    "calendar_dim": _P("""
SELECT *, CASE WHEN dia_semana IN (1, 7) THEN 'SI' ELSE 'NO' END AS es_fin_semana FROM d_tiempo"""),

    "hour_dim": _P("""
SELECT hora_id, hora, franja_horaria, lpad(CAST(hora AS VARCHAR), 2, '0') || ':00' AS etiqueta, hora AS hora_leida
FROM d_hora"""),

    "operator_dim": _P("SELECT operador_id, operador_nombre FROM d_operador"),
    "network_dim": _P("SELECT red_id, red_tipo, generacion FROM d_red"),
    "quality_dim": _P("""
SELECT c.*, COALESCE(n.mediciones, 0) AS mediciones
FROM d_calidad c LEFT JOIN (SELECT calidad_id, count(*) AS mediciones FROM fact GROUP BY calidad_id) n
  ON c.calidad_id = n.calidad_id"""),
    "device_dim": _P("SELECT dispositivo_id, device_id, device_name FROM d_dispositivo"),
    "zone_dim": _P("""
SELECT zona_id, zona_nombre, grid_lat, grid_lon, centro_lat, centro_lon, total_mediciones, altitud_promedio,
       grid_latitud_inicio, grid_latitud_fin, grid_longitud_inicio, grid_longitud_fin FROM d_zonas"""),

    "fact_rows": _P("""
SELECT "timestamp", tiempo_id, hora_id, dispositivo_id, operador_id, red_id, calidad_id, zona_id, zona_altitud,
  CAST(medida_senal AS DOUBLE) AS medida_senal, CAST(medida_velocidad AS DOUBLE) AS medida_velocidad,
  CAST(medida_altitud AS DOUBLE) AS medida_altitud, CAST(medida_bateria AS DOUBLE) AS medida_bateria,
  CAST(latitude AS DOUBLE) AS latitude, CAST(longitude AS DOUBLE) AS longitude, source_id, semana
FROM fact"""),

    "full_view": _P("""
SELECT key.source_id, key."timestamp", key.zona_altitud, key.latitude::DOUBLE AS latitude, key.longitude::DOUBLE AS longitude,
  key.medida_bateria::DOUBLE AS medida_bateria, key.medida_altitud::DOUBLE AS medida_altitud,
  key.medida_velocidad::DOUBLE AS medida_velocidad, key.medida_senal::DOUBLE AS medida_senal,
  (SELECT zona_nombre FROM d_zonas WHERE zona_id = key.zona_id) AS zona_nombre,
  (SELECT calidad_categoria FROM d_calidad WHERE calidad_id = key.calidad_id) AS calidad_categoria,
  (SELECT operador_nombre FROM d_operador WHERE operador_id = key.operador_id) AS operador_nombre,
  net.red_tipo, net.generacion, phone.device_id, phone.device_name, hour.hora, hour.franja_horaria,
  day.nombre_dia, day.mes, day.anio, day.fecha
FROM fact key
LEFT JOIN d_red net USING (red_id) LEFT JOIN d_dispositivo phone USING (dispositivo_id)
LEFT JOIN d_hora hour USING (hora_id) LEFT JOIN d_tiempo day USING (tiempo_id)"""),

    "analytic_frame": _P(f"SELECT {_AF_COLS} FROM af"),

    "sample_labels": _P("""
SELECT f.source_id, o.operador_nombre, r.red_tipo, c.calidad_categoria
FROM fact f
LEFT JOIN d_operador o ON f.operador_id = o.operador_id
LEFT JOIN d_red r ON f.red_id = r.red_id
LEFT JOIN d_calidad c ON f.calidad_id = c.calidad_id
ORDER BY f."timestamp", f.source_id LIMIT 5"""),

    "zone_summary": _P(f"""
SELECT z.zona_id, z.zona_nombre, z.grid_lat, z.grid_lon, z.centro_lat, z.centro_lon, a.total_mediciones,
       a.senal_promedio, a.senal_desviacion, a.operadores_presentes, a.dispositivos_unicos, a.ultima_medicion
FROM (SELECT zona_id, count(*) AS total_mediciones, {avg2('medida_senal')} AS senal_promedio,
        {round_dec('stddev_samp(CAST(medida_senal AS DOUBLE))')} AS senal_desviacion,
        count(DISTINCT operador_id) AS operadores_presentes, count(DISTINCT dispositivo_id) AS dispositivos_unicos,
        max("timestamp") AS ultima_medicion
      FROM fact GROUP BY zona_id) a
JOIN d_zonas z ON a.zona_id = z.zona_id"""),

    "zone_layer_precomputed": _P(f"""
SELECT row_number() OVER (ORDER BY a.total_mediciones DESC, a.zona_id) AS orden,
       a.zona_id, a.total_mediciones, a.senal_promedio, a.senal_desviacion, z.zona_nombre,
       z.grid_latitud_inicio, z.grid_latitud_fin, z.grid_longitud_inicio, z.grid_longitud_fin, z.altitud_promedio
FROM (SELECT zona_id, count(*) AS total_mediciones, {avg2('medida_senal')} AS senal_promedio,
        {round_dec('stddev_samp(CAST(medida_senal AS DOUBLE))')} AS senal_desviacion
      FROM fact GROUP BY zona_id) a
JOIN d_zonas z ON a.zona_id = z.zona_id"""),

    "top_devices": _P(f"""
SELECT row_number() OVER (ORDER BY a.total_mediciones DESC, d.dispositivo_id) AS orden,
       d.dispositivo_id, d.device_id, d.device_name, a.total_mediciones, a.senal_promedio, a.zonas_visitadas,
       a.primera_medicion, a.ultima_medicion
FROM (SELECT dispositivo_id, count(*) AS total_mediciones, {avg2('medida_senal')} AS senal_promedio,
        count(DISTINCT zona_id) AS zonas_visitadas, min("timestamp") AS primera_medicion,
        max("timestamp") AS ultima_medicion
      FROM fact GROUP BY dispositivo_id) a
JOIN d_dispositivo d ON a.dispositivo_id = d.dispositivo_id"""),

    "global_summary": _P(f"""
SELECT count(*) AS total_mediciones, count(DISTINCT dispositivo_id) AS dispositivos, count(DISTINCT zona_id) AS zonas,
       min("timestamp") AS fecha_inicio, max("timestamp") AS fecha_fin, {avg2('medida_senal')} AS senal_promedio
FROM fact"""),

    "header_counts": _P("""
SELECT (SELECT count(*) FROM af) AS mediciones, (SELECT count(DISTINCT dispositivo_id) FROM af) AS dispositivos,
       (SELECT count(DISTINCT device_name) FROM af) AS modelos, (SELECT count(*) FROM d_operador) AS operadores"""),

    "partition_counts": _P("SELECT semana, count(*) AS registros FROM fact GROUP BY semana"),

    "partition_counts_reference": _P("""
SELECT CASE
  WHEN "timestamp" >= TIMESTAMP '2025-11-14' AND "timestamp" < TIMESTAMP '2025-11-21' THEN '2025_11_w1'
  WHEN "timestamp" >= TIMESTAMP '2025-11-21' AND "timestamp" < TIMESTAMP '2025-11-28' THEN '2025_11_w2'
  WHEN "timestamp" >= TIMESTAMP '2025-11-28' AND "timestamp" < TIMESTAMP '2025-12-05' THEN '2025_11_w3'
  WHEN "timestamp" >= TIMESTAMP '2025-12-05' AND "timestamp" < TIMESTAMP '2025-12-07' THEN '2025_12_w1'
  ELSE 'default' END AS semana, count(*) AS registros
FROM fact GROUP BY 1"""),

    "table_counts": _P("""
SELECT 'dim_tiempo' AS tabla, count(*) AS registros FROM d_tiempo
UNION ALL SELECT 'dim_hora', count(*) FROM d_hora
UNION ALL SELECT 'dim_operador', count(*) FROM d_operador
UNION ALL SELECT 'dim_red', count(*) FROM d_red
UNION ALL SELECT 'dim_calidad', count(*) FROM d_calidad
UNION ALL SELECT 'dim_dispositivo', count(*) FROM d_dispositivo
UNION ALL SELECT 'dim_zonas', count(*) FROM d_zonas
UNION ALL SELECT 'fact_mediciones', count(*) FROM fact"""),

    "kpis": _P(f"""
SELECT {avg2('medida_senal')} AS senal_promedio, {avg2('medida_altitud')} AS altitud_promedio,
       count(DISTINCT zona_id) AS zonas_cubiertas, count(*) AS registros_filtrados FROM af"""),

    "kpis_sliced": _P(f"""
SELECT {avg2('medida_senal')} AS senal_promedio, {avg2('medida_altitud')} AS altitud_promedio,
       count(DISTINCT zona_id) AS zonas_cubiertas, count(*) AS registros_filtrados FROM af WHERE {_SLICE_SQL}"""),

    "operator_counts": _P("""SELECT operador_normalizado, count(*) AS mediciones,
  row_number() OVER (ORDER BY count(*) DESC, operador_normalizado) AS orden FROM af
WHERE operador_normalizado IS NOT NULL GROUP BY 1"""),
    "quality_counts": _P("""SELECT calidad_senal, count(*) AS mediciones,
  row_number() OVER (ORDER BY count(*) DESC, calidad_senal) AS orden FROM af
WHERE calidad_senal IS NOT NULL GROUP BY 1"""),
    "weekday_counts": _P("""SELECT nombre_dia, count(*) AS mediciones,
  row_number() OVER (ORDER BY count(*) DESC, nombre_dia) AS orden FROM af
WHERE nombre_dia IS NOT NULL GROUP BY 1"""),
    "day_part_counts": _P("""SELECT franja_horaria, count(*) AS mediciones,
  row_number() OVER (ORDER BY count(*) DESC, franja_horaria) AS orden FROM af
WHERE franja_horaria IS NOT NULL GROUP BY 1"""),

    "operator_share": _P("""
SELECT operador_normalizado, mediciones,
       """ + round_dec('CAST(mediciones AS DOUBLE) * 100.0::DOUBLE / sum(mediciones) OVER ()', 4) + """ AS porcentaje
FROM (SELECT operador_normalizado, count(*) AS mediciones FROM af WHERE operador_normalizado IS NOT NULL GROUP BY 1)"""),

    "signal_by_operator": _P(f"""
SELECT *, row_number() OVER (ORDER BY senal_promedio DESC NULLS LAST, operador_normalizado NULLS FIRST) AS orden
FROM (SELECT operador_normalizado, {avg2('medida_senal')} AS senal_promedio FROM af GROUP BY 1)"""),

    "zone_layer": _P(f"""
SELECT a.*, z.zona_nombre, z.grid_latitud_inicio, z.grid_latitud_fin, z.grid_longitud_inicio, z.grid_longitud_fin,
       {MEAN_COLOR_SQL.format(s='a.senal_promedio')} AS color
FROM (SELECT zona_id, {avg2('medida_senal')} AS senal_promedio,
        {round_dec('stddev_samp(medida_senal)')} AS senal_desviacion, count(medida_senal) AS total_mediciones,
        {avg2('medida_altitud')} AS altitud_promedio, count(DISTINCT dispositivo_id) AS dispositivos_unicos
      FROM af WHERE red_normalizada = '4G' AND latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY zona_id) a
JOIN d_zonas z ON a.zona_id = z.zona_id"""),

    "zone_layer_all": _P(f"""
SELECT a.*, z.zona_nombre, z.grid_latitud_inicio, z.grid_latitud_fin, z.grid_longitud_inicio, z.grid_longitud_fin,
       {MEAN_COLOR_SQL.format(s='a.senal_promedio')} AS color
FROM (SELECT zona_id, {avg2('medida_senal')} AS senal_promedio,
        {round_dec('stddev_samp(medida_senal)')} AS senal_desviacion, count(medida_senal) AS total_mediciones,
        {avg2('medida_altitud')} AS altitud_promedio, count(DISTINCT dispositivo_id) AS dispositivos_unicos
      FROM af WHERE latitude IS NOT NULL AND longitude IS NOT NULL GROUP BY zona_id) a
JOIN d_zonas z ON a.zona_id = z.zona_id"""),

    "daily_evolution": _P(f"""
SELECT fecha, {avg2('medida_senal')} AS senal_promedio, count(source_id) AS cantidad FROM af GROUP BY fecha"""),

    "day_part_matrix": _P("""
SELECT nombre_dia,
  count(*) FILTER (WHERE franja_horaria = 'MADRUGADA') AS "MADRUGADA",
  count(*) FILTER (WHERE franja_horaria = 'MAÑANA') AS "MAÑANA",
  count(*) FILTER (WHERE franja_horaria = 'NOCHE') AS "NOCHE",
  count(*) FILTER (WHERE franja_horaria = 'TARDE') AS "TARDE"
FROM af GROUP BY nombre_dia"""),

    "device_kpis": _P(f"""
SELECT device_name, count(*) AS total_mediciones, {avg2('medida_senal')} AS senal_promedio,
       count(DISTINCT zona_id) AS zonas_visitadas FROM af GROUP BY device_name"""),

    "centroid": _P(f"SELECT {avg2('latitude', 6)} AS centro_lat, {avg2('longitude', 6)} AS centro_lon FROM af"),
    "device_centroids": _P(f"""
SELECT device_name, {avg2('latitude', 6)} AS centro_lat, {avg2('longitude', 6)} AS centro_lon FROM af GROUP BY 1"""),

    "filter_domains": _P("""
SELECT DISTINCT dominio, valor FROM (
  SELECT 'fecha_min' AS dominio, CAST(min(fecha) AS VARCHAR) AS valor FROM af
  UNION ALL SELECT 'fecha_max', CAST(max(fecha) AS VARCHAR) FROM af
  UNION ALL SELECT 'hora', lpad(CAST(hora AS VARCHAR), 2, '0') || ':00' FROM af
  UNION ALL SELECT 'operador_normalizado', operador_normalizado FROM af
  UNION ALL SELECT 'red_normalizada', red_normalizada FROM af
  UNION ALL SELECT 'calidad_senal', calidad_senal FROM af
  UNION ALL SELECT 'franja_horaria', franja_horaria FROM af
  UNION ALL SELECT 'device_name', device_name FROM af
) WHERE valor IS NOT NULL"""),

    "points_layer_rows": _P(f"""
SELECT latitude, longitude, {CLASS_COLOR_SQL.format(c='calidad_senal')} AS color, operador_normalizado,
       red_normalizada, medida_senal, calidad_senal FROM af"""),
    "heat_layer_rows": _P("SELECT latitude, longitude, abs(medida_senal) AS peso FROM af"),
    "cluster_layer": _P("SELECT latitude, longitude, operador_normalizado, medida_senal, device_name FROM af"),
    "cluster_cells": _P("""
SELECT CAST(floor(latitude / 0.05::DOUBLE) AS INTEGER) AS celda_lat, CAST(floor(longitude / 0.05::DOUBLE) AS INTEGER) AS celda_lon,
       count(*) AS puntos, """ + avg2('latitude', 6) + """ AS centro_lat, """ + avg2('longitude', 6) + """ AS centro_lon
FROM af GROUP BY 1, 2"""),

    "device_trails": _P(f"""
SELECT device_name, "timestamp", source_id, latitude, longitude, calidad_senal,
       {CLASS_COLOR_SQL.format(c='calidad_senal')} AS color,
       row_number() OVER (ORDER BY device_name NULLS FIRST, "timestamp", source_id NULLS FIRST) AS orden FROM af"""),
    "trail_endpoints": _P("""
SELECT device_name,
  arg_min(latitude, ("timestamp", source_id)) AS inicio_lat, arg_min(longitude, ("timestamp", source_id)) AS inicio_lon,
  arg_max(latitude, ("timestamp", source_id)) AS fin_lat, arg_max(longitude, ("timestamp", source_id)) AS fin_lon
FROM af GROUP BY device_name"""),
    "device_timeline": _P("""SELECT device_name, "timestamp", source_id, medida_senal,
  row_number() OVER (ORDER BY device_name NULLS FIRST, "timestamp", source_id NULLS FIRST) AS orden FROM af"""),
    "device_log": _P("""
SELECT "timestamp", operador_normalizado, red_normalizada, calidad_senal, medida_senal, latitude, longitude, zona_altitud
FROM af WHERE device_name = 'MODEL 3' ORDER BY "timestamp", source_id LIMIT 100"""),

    "heat_sample": _P("""
SELECT source_id, "timestamp", latitude, longitude, abs(medida_senal) AS peso FROM af
ORDER BY md5('7|' || source_id), source_id, "timestamp" LIMIT 2000"""),
    "points_sample": _P(f"""
SELECT source_id, "timestamp", latitude, longitude, {CLASS_COLOR_SQL.format(c='calidad_senal')} AS color,
       operador_normalizado, red_normalizada, medida_senal, calidad_senal
FROM af ORDER BY md5('7|' || source_id), source_id, "timestamp" LIMIT 4000"""),
    "operator_list": _P("SELECT operador_id, operador_nombre AS operador_normalizado FROM d_operador"),
    "device_list": _P("SELECT dispositivo_id, device_name FROM d_dispositivo"),

    "zone_stats_floor": _P("""
SELECT grid_lat, grid_lon, count(*) AS total_mediciones,
       """ + avg2('latitude', 6) + """ AS centro_lat, """ + avg2('longitude', 6) + """ AS centro_lon,
       """ + avg2('altitude', 2) + """ AS altitud_promedio,
       'ZONA_' || CAST(grid_lat AS VARCHAR) || '_' || CAST(grid_lon AS VARCHAR) AS zona_nombre,
       round(grid_lat * 0.02::DOUBLE, 6) AS grid_latitud_inicio, round((grid_lat + 1) * 0.02::DOUBLE, 6) AS grid_latitud_fin,
       round(grid_lon * 0.02::DOUBLE, 6) AS grid_longitud_inicio, round((grid_lon + 1) * 0.02::DOUBLE, 6) AS grid_longitud_fin
FROM (SELECT *, CAST(floor(latitude / 0.02::DOUBLE) AS INTEGER) AS grid_lat,
             CAST(floor(longitude / 0.02::DOUBLE) AS INTEGER) AS grid_lon FROM parsed)
GROUP BY grid_lat, grid_lon"""),
    "zone_build": _P("""
SELECT zona_id, zona_nombre, centro_lat, centro_lon, total_mediciones, altitud_promedio, grid_latitud_inicio,
       grid_latitud_fin, grid_longitud_inicio, grid_longitud_fin, grid_lat, grid_lon FROM zones""", _ZONE_BUILD_SQL),
    "top_zones": _P("""
SELECT zona_id, zona_nombre, centro_lat, centro_lon, total_mediciones, altitud_promedio, grid_latitud_inicio,
       grid_latitud_fin, grid_longitud_inicio, grid_longitud_fin, grid_lat, grid_lon FROM zones
ORDER BY zona_id LIMIT 10""", _ZONE_BUILD_SQL),
    "zone_build_summary": _P(f"""
SELECT max(total_mediciones) AS max_mediciones, min(total_mediciones) AS min_mediciones,
       {avg2('total_mediciones')} AS promedio_mediciones, count(*) AS zonas FROM zones""", _ZONE_BUILD_SQL),

    "devices_without_data": _P("""
SELECT d.dispositivo_id, d.device_name, row_number() OVER (ORDER BY d.device_name NULLS FIRST, d.dispositivo_id) AS orden
FROM d_dispositivo d WHERE NOT EXISTS (SELECT 1 FROM fact f WHERE f.dispositivo_id = d.dispositivo_id)"""),
    "device_reconciliation": _P("""
SELECT (SELECT count(*) FROM d_dispositivo) AS total_dim,
       (SELECT count(DISTINCT dispositivo_id) FROM fact) AS total_fact,
       (SELECT count(DISTINCT dispositivo_id) FROM fact WHERE latitude IS NOT NULL AND longitude IS NOT NULL) AS con_coords,
       (SELECT count(DISTINCT d.device_name) FROM fact f JOIN d_dispositivo d ON f.dispositivo_id = d.dispositivo_id
         WHERE f.latitude IS NOT NULL AND f.longitude IS NOT NULL) AS con_nombre"""),

    "multi_id_models": _P("""
SELECT p.device_name, p.device_id, c.num_ids
FROM (SELECT DISTINCT device_id, device_name FROM raw WHERE device_id IS NOT NULL AND device_name IS NOT NULL) p
JOIN (SELECT device_name, count(*) AS num_ids
      FROM (SELECT DISTINCT device_id, device_name FROM raw WHERE device_id IS NOT NULL AND device_name IS NOT NULL)
      GROUP BY device_name HAVING count(*) > 1) c ON p.device_name = c.device_name"""),
    "device_completeness": _P("""
SELECT count(DISTINCT device_name) AS modelos_unicos, count(DISTINCT device_id) AS device_ids_unicos,
       count(device_id) AS registros_con_id, count(*) AS registros FROM raw"""),
    "device_pairs": _P("""
SELECT *, row_number() OVER (ORDER BY device_id, device_name NULLS FIRST) AS orden
FROM (SELECT DISTINCT device_id, device_name FROM raw WHERE device_id IS NOT NULL)"""),

    "not_null_violations": _P("""
SELECT * FROM raw WHERE latitude IS NULL OR longitude IS NULL OR "timestamp" IS NULL"""),
    "fact_key_violations": _P("""
SELECT source_id, "timestamp", count(*) AS n FROM fact GROUP BY 1, 2 HAVING count(*) > 1"""),
    "zone_fk_violations": _P("""
SELECT f.source_id, f.zona_id FROM fact f WHERE f.zona_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM d_zonas z WHERE z.zona_id = f.zona_id)"""),

    "warehouse_checks": _P(_WAREHOUSE_CHECKS_SQL),
    "high_watermark": _P("SELECT COALESCE(max(\"timestamp\"), TIMESTAMP '1970-01-01 00:00:00') AS watermark FROM fact"),
    "incremental_scan": _P("SELECT * FROM raw WHERE \"timestamp\" > TIMESTAMP '2024-01-20 00:00:00'"),
    "bounded_extract": _P("""
SELECT * FROM raw WHERE "timestamp" <= (
  SELECT max(t) FROM (SELECT "timestamp" AS t FROM raw WHERE "timestamp" IS NOT NULL ORDER BY t LIMIT 1000))"""),

    "insert_ignore_devices": _P("""
SELECT a.device_id, a.device_name FROM dev_all a WHERE NOT EXISTS (SELECT 1 FROM dev1 b WHERE b.device_id = a.device_id)""",
                                _HALVES_SQL),
    "assign_ids_increment": _P("""
SELECT a.device_id, a.device_name,
       CAST((SELECT count(*) FROM dev1) + row_number() OVER (ORDER BY a.device_id) AS INTEGER) AS dispositivo_id
FROM dev_all a WHERE NOT EXISTS (SELECT 1 FROM dev1 b WHERE b.device_id = a.device_id)""", _HALVES_SQL),
    "late_members": _P("""
SELECT f.source_id, f.device_id, d.dispositivo_id
FROM (SELECT source_id, device_id FROM acc WHERE "timestamp" >= TIMESTAMP '2024-01-01 06:00:00') f
LEFT JOIN (
  SELECT device_id, CAST(row_number() OVER (ORDER BY device_id) AS INTEGER) AS dispositivo_id FROM dev1
  UNION ALL
  SELECT a.device_id, CAST((SELECT count(*) FROM dev1) + row_number() OVER (ORDER BY a.device_id) AS INTEGER)
  FROM (SELECT device_id FROM norm WHERE "timestamp" >= TIMESTAMP '2024-01-01 06:00:00' AND device_id IS NOT NULL
        GROUP BY device_id) a
  WHERE NOT EXISTS (SELECT 1 FROM dev1 b WHERE b.device_id = a.device_id)
) d ON f.device_id = d.device_id""", _HALVES_SQL),
    "upsert_zones": _P(f"""
SELECT COALESCE(o.grid_lat, n.grid_lat) AS grid_lat, COALESCE(o.grid_lon, n.grid_lon) AS grid_lon,
  COALESCE(o.total_mediciones, 0) + COALESCE(n.total_mediciones, 0) AS total_mediciones,
  COALESCE(o.centro_lat, n.centro_lat) AS centro_lat, COALESCE(o.centro_lon, n.centro_lon) AS centro_lon,
  COALESCE(o.altitud_promedio, n.altitud_promedio) AS altitud_promedio,
  COALESCE(o.zona_nombre, n.zona_nombre) AS zona_nombre,
  COALESCE(o.grid_latitud_inicio, n.grid_latitud_inicio) AS grid_latitud_inicio,
  COALESCE(o.grid_latitud_fin, n.grid_latitud_fin) AS grid_latitud_fin,
  COALESCE(o.grid_longitud_inicio, n.grid_longitud_inicio) AS grid_longitud_inicio,
  COALESCE(o.grid_longitud_fin, n.grid_longitud_fin) AS grid_longitud_fin
FROM ({_zone_named('zone_old')}) o FULL OUTER JOIN ({_zone_named('zone_new')}) n
  ON o.grid_lat = n.grid_lat AND o.grid_lon = n.grid_lon""", _HALVES_SQL),
    "new_facts": _P("""
SELECT a.source_id, a."timestamp", strftime(CAST(a."timestamp" AS DATE) - CAST((dayofweek(a."timestamp") + 6) % 7 AS INTEGER), '%Y-%m-%d') AS semana
FROM acc a WHERE NOT EXISTS (SELECT 1 FROM acc1 b WHERE b.source_id = a.source_id AND b."timestamp" = a."timestamp")""",
                  _HALVES_SQL),
}


_EARLY_SQL = """
now_dev AS (SELECT device_id, min(device_name) AS device_name, row_number() OVER (ORDER BY device_id) AS id
            FROM norm WHERE "timestamp" < TIMESTAMP '2024-01-01 06:00:00' AND device_id IS NOT NULL GROUP BY device_id),
late_dev AS (SELECT device_id, (SELECT count(*) FROM now_dev) + row_number() OVER (ORDER BY device_id) AS id
             FROM (SELECT DISTINCT device_id FROM norm WHERE "timestamp" >= TIMESTAMP '2024-01-01 06:00:00' AND device_id IS NOT NULL)
             ANTI JOIN now_dev USING (device_id)),
now_zone AS (SELECT grid_lat, grid_lon, row_number() OVER (ORDER BY grid_lat, grid_lon) AS id
             FROM (SELECT DISTINCT grid_lat, grid_lon FROM acc WHERE "timestamp" < TIMESTAMP '2024-01-01 06:00:00')),
late_zone AS (SELECT grid_lat, grid_lon, (SELECT count(*) FROM now_zone) + row_number() OVER (ORDER BY grid_lat, grid_lon) AS id
              FROM (SELECT DISTINCT grid_lat, grid_lon FROM acc WHERE "timestamp" >= TIMESTAMP '2024-01-01 06:00:00')
              ANTI JOIN now_zone USING (grid_lat, grid_lon))"""

_PYRAMID_SQL = f"""
cells AS (SELECT zoom, CAST(greatest(0, least((1 << zoom) - 1, floor((longitude + 180) / 360 * (1 << zoom)))) AS INTEGER) AS x,
                 CAST(greatest(0, least((1 << zoom) - 1, floor((90 - latitude) / 180 * (1 << zoom)))) AS INTEGER) AS y,
                 medida_senal, latitude, longitude
          FROM af, (SELECT CAST(z AS INTEGER) AS zoom FROM range({ZOOMS[0]}, {ZOOMS[1]} + 1) t(z)))"""

ORACLE |= {f"merged_{name}": ORACLE[name] for name in ("daily_operator_stats", "zone_summary", "global_summary")}
ORACLE["merged_top_devices"] = "SELECT * EXCLUDE (orden) FROM (" + ORACLE["top_devices"] + ")"
ORACLE["zoom_pyramid"] = _P(f"""
SELECT zoom, array_to_string(list_transform(range(zoom - 1, -1, -1), lambda i: ((x >> CAST(i AS INTEGER)) & 1) + 2 * ((y >> CAST(i AS INTEGER)) & 1)), '') AS quadkey,
  count(*) AS puntos, {avg2('medida_senal')} AS senal_promedio, {avg2('latitude', 6)} AS centro_lat, {avg2('longitude', 6)} AS centro_lon
FROM cells GROUP BY zoom, x, y""", _PYRAMID_SQL)
ORACLE["early_facts"] = _P("""
SELECT f.source_id, f."timestamp", CAST(coalesce(nd.id, 0) AS INTEGER) AS dispositivo_antes, CAST(coalesce(nz.id, 0) AS INTEGER) AS zona_antes,
  CASE WHEN nd.id IS NULL THEN 'DESCONOCIDO' ELSE nd.device_name END AS nombre_antes,
  CAST(coalesce(nd.id, ld.id, 0) AS INTEGER) AS dispositivo_despues, CAST(coalesce(nz.id, lz.id, 0) AS INTEGER) AS zona_despues
FROM acc f LEFT JOIN now_dev nd USING (device_id) LEFT JOIN late_dev ld USING (device_id)
LEFT JOIN now_zone nz USING (grid_lat, grid_lon) LEFT JOIN late_zone lz USING (grid_lat, grid_lon)
WHERE f."timestamp" >= TIMESTAMP '2024-01-01 06:00:00'""", _EARLY_SQL)


def _planted_sql() -> str:
    cells = [f"CASE WHEN s % {PLANT_NULL} <> {i} THEN {{}} END" for i in range(len(FACT_NOT_NULL))]
    keys = {k: f"CASE WHEN s % {PLANT_KEY} = {i} THEN {NO_MEMBER} ELSE {{}} END" for i, (k, _) in enumerate(FACT_FOREIGN_KEYS)}
    out = {}
    for c, cell in zip(FACT_NOT_NULL, cells):
        out[c] = cell.format(f'"{c}"')
    for k, key in keys.items():
        out[k] = key.format(out.get(k, f'"{k}"'))
    columns = ", ".join(f'{e} AS "{c}"' for c, e in out.items())
    return f"""
doubled AS (SELECT *, CAST(source_id AS BIGINT) AS s FROM fact
            UNION ALL SELECT *, CAST(source_id AS BIGINT) AS s FROM fact WHERE CAST(source_id AS BIGINT) % {PLANT_TWICE} = 0),
planted AS (SELECT source_id, semana, {columns} FROM doubled)"""


_DIM_SQL = {"dim_tiempo": "d_tiempo", "dim_hora": "d_hora", "dim_operador": "d_operador", "dim_red": "d_red",
            "dim_calidad": "d_calidad", "dim_dispositivo": "d_dispositivo", "dim_zonas": "d_zonas"}


def _fact_rules_sql(src: str, among: str) -> str:
    rules = [f"SELECT 'fact_mediciones' AS tabla, 'not_null:{c}' AS regla, count(*) FILTER (WHERE \"{c}\" IS NULL) AS violaciones FROM {src}"
             for c in FACT_NOT_NULL]
    rules += [f"SELECT 'fact_mediciones', 'fk:{k}->{dim}', count(*) FROM {src} WHERE {k} IS NOT NULL AND {k} NOT IN (SELECT {k} FROM {_DIM_SQL[dim]})"
              for k, dim in FACT_FOREIGN_KEYS]
    # a NULL timestamp is a key value like any other in a grouping
    rules.append(f"""SELECT 'fact_mediciones', 'unique:source_id,timestamp', count(*) FROM
      (SELECT source_id, "timestamp" FROM {among} a WHERE EXISTS (SELECT 1 FROM {src} b WHERE b.source_id = a.source_id
         AND b."timestamp" IS NOT DISTINCT FROM a."timestamp") GROUP BY 1, 2 HAVING count(*) > 1)""")
    return " UNION ALL ".join(rules)


ORACLE["planted_violations"] = _P(
    _fact_rules_sql("planted", "planted") + "".join(
        f" UNION ALL SELECT '{dim}', 'unique:{','.join(keys)}', least(2, count(*)) FROM {_DIM_SQL[dim]}" for dim, keys in DIM_UNIQUE),
    _planted_sql())
ORACLE["increment_violations"] = _P(_fact_rules_sql("fresh", "planted"),
                                    _planted_sql() + f", fresh AS (SELECT * FROM planted WHERE semana >= '{INCREMENT_WEEK}')")


def oracle_sql() -> dict[str, str]:
    return ORACLE | _training_data()[1]
