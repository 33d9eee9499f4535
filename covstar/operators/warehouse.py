"""The star schema as lazy DataFrames: build from raw, load from storage,
views (J1-J4, J8) and the pre-aggregates (A3-A9, Q1).

Dimensions are small and are materialised and *counted* when the warehouse is
built or loaded; the counts decide whether a dimension join broadcasts. The
fact table is never collected or numbered by a global window: its id is a hash
of its natural key.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import functions as X
from .clean import normalize
from .dimensions import (DIM_COLUMNS, assign_ids, device_members, exact_avg, first_per_key,
                         network_members, operator_members, quality_dim, time_members,
                         hour_members, zone_members, zone_stats)
from .joins import dim_join, resolve_key

FACT_COLUMNS = ["medicion_id", "timestamp", "tiempo_id", "hora_id", "dispositivo_id", "operador_id",
                "red_id", "calidad_id", "zona_id", "zona_altitud", "medida_senal", "medida_velocidad",
                "medida_altitud", "medida_bateria", "latitude", "longitude", "etl_loaded_at",
                "source_id", "semana"]

MEASURE_TYPES = {
    "medida_senal": T.DecimalType(10, 2), "medida_velocidad": T.DecimalType(10, 2),
    "medida_altitud": T.DecimalType(10, 2), "medida_bateria": T.DecimalType(5, 2),
    "latitude": T.DecimalType(10, 6), "longitude": T.DecimalType(10, 6),
}


# Rows the fact cannot take, by reason: no device key (neither id nor
# name), no grid cell, or a value that its column type cannot hold
def quarantine_rules() -> list:
    def beyond(column: str, target: str):
        return F.col(column).isNotNull() & F.col(column).try_cast(MEASURE_TYPES[target]).isNull()
    measures = (("signal", "medida_senal"), ("speed_kmh", "medida_velocidad"), ("altitude", "medida_altitud"),
                ("battery", "medida_bateria"))
    return [("sin_dispositivo", F.col("device_id").isNull()),
            ("coordenada_fuera_de_rango", beyond("latitude", "latitude") | beyond("longitude", "longitude")),
            ("sin_celda", F.col("grid_lat").isNull() | F.col("grid_lon").isNull()),
            *[(f"{target}_fuera_de_rango", beyond(column, target)) for column, target in measures]]


def with_reason(norm: DataFrame) -> DataFrame:
    """``norm`` with the fact key's ``source_id`` and ``motivo``, the first rule
    that a row breaks (NULL: the fact can take it)."""
    reason = None
    for name, cond in quarantine_rules():
        reason = F.when(cond, F.lit(name)) if reason is None else reason.when(cond, F.lit(name))
    return norm.withColumn("source_id", F.col("id").cast("string")).withColumn("motivo", reason)


def accepted_rows(norm: DataFrame) -> DataFrame:
    """Rows the fact accepts: of those it can take, one per key (source_id,
    timestamp), the smallest row (deterministic). An aggregate: each task folds
    the copies of a hot key before the shuffle."""
    good = with_reason(norm).filter(F.col("motivo").isNull()).drop("motivo")
    return first_per_key(good, ["source_id", "timestamp"], ["device_id", "signal"])


def quarantined_rows(norm: DataFrame) -> DataFrame:
    """Rows the fact cannot take, one per (source_id, timestamp, motivo)."""
    bad = with_reason(norm).filter(F.col("motivo").isNotNull())
    return first_per_key(bad, ["source_id", "timestamp", "motivo"], ["device_id", "signal"])


def fact_id(source_id: str = "source_id", ts: str = "timestamp"):
    """K4 for facts: a 64-bit hash of the natural key as stored - no coordination,
    no global window, identical on every rerun and for every feed type."""
    return F.xxhash64(F.col(source_id), F.col(ts).cast("timestamp_ntz"))


def to_fact_rows(acc: DataFrame, dims: dict, sizes: dict, now=None) -> DataFrame:
    """Resolve surrogate keys (J5/J6, P26) and type the measures."""
    df = acc
    df = resolve_key(df, dims["dim_dispositivo"], ["device_id"], "dispositivo_id",
                     C.DEFAULT_DEVICE_ID, sizes.get("dim_dispositivo"))
    df = resolve_key(df, dims["dim_operador"].withColumnRenamed("operador_nombre", "operador_normalizado"),
                     ["operador_normalizado"], "operador_id", C.DEFAULT_OPERATOR_ID, sizes.get("dim_operador"))
    df = resolve_key(df, dims["dim_red"].withColumnRenamed("red_tipo", "red_normalizada"),
                     ["red_normalizada"], "red_id", C.DEFAULT_NETWORK_ID, sizes.get("dim_red"))
    df = resolve_key(df, dims["dim_zonas"], ["grid_lat", "grid_lon"], "zona_id",
                     C.DEFAULT_ZONE_ID, sizes.get("dim_zonas"))
    loaded = F.current_timestamp() if now is None else X.ts_literal(now, "timestamp")
    return df.select(
        fact_id().alias("medicion_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("timestamp"), "tiempo_id", F.col("hora").alias("hora_id"),
        "dispositivo_id", "operador_id", "red_id",
        # the quality dimension is a fixed seed: its lookup is an expression
        F.coalesce(X.class_id_of("calidad_senal"), F.lit(C.DEFAULT_QUALITY_ID)).alias("calidad_id"),
        "zona_id", "zona_altitud",
        F.col("signal").try_cast(MEASURE_TYPES["medida_senal"]).alias("medida_senal"),
        F.col("speed_kmh").try_cast(MEASURE_TYPES["medida_velocidad"]).alias("medida_velocidad"),
        F.col("altitude").try_cast(MEASURE_TYPES["medida_altitud"]).alias("medida_altitud"),
        F.col("battery").try_cast(MEASURE_TYPES["medida_bateria"]).alias("medida_bateria"),
        F.col("latitude").try_cast(MEASURE_TYPES["latitude"]).alias("latitude"),
        F.col("longitude").try_cast(MEASURE_TYPES["longitude"]).alias("longitude"),
        loaded.alias("etl_loaded_at"),
        "source_id",
        X.week_partition("timestamp").alias("semana"),
    )


def materialize(df: DataFrame) -> tuple[DataFrame, int]:
    """Persist a small frame and count it: the count is the size check."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    return df, df.count()


@dataclass
class Warehouse:
    spark: SparkSession
    dims: dict
    fact: DataFrame
    sizes: dict = field(default_factory=dict)
    quarantine: DataFrame | None = None
    root: str | None = None

    # ------------------------------------------------------------------ build
    @classmethod
    def from_raw(cls, raw: DataFrame, now=None, grid_size: float = C.GRID_SIZE_ETL,
                 grid_mode: str = "trunc", materialize_fact: bool = False) -> "Warehouse":
        """Initial load of an empty warehouse, kept in memory: dimensions are
        materialised (small, counted), the fact stays a lazy plan over the
        scan, so a query only reads the raw columns it needs. With
        ``materialize_fact`` the deduped rows are persisted (one dedupe
        shuffle for the zone dimension and the fact) and the fact is
        checkpointed once into the session's shared checkpoint folder (when
        one is named), so repeated queries read it instead of its lineage."""
        spark = raw.sparkSession
        norm = normalize(raw, grid_size, grid_mode)
        good, bad = accepted_rows(norm), quarantined_rows(norm)
        if materialize_fact:
            # one dedupe shuffle serves the zone dimension and the fact
            good = good.persist(StorageLevel.MEMORY_AND_DISK)
        # the four small dimensions come from one bounded aggregate (days x
        # hours x operators x networks), i.e. one scan instead of four
        # three independent aggregates, materialised side by side (jobs from
        # several driver threads run concurrently)
        from concurrent.futures import ThreadPoolExecutor
        parts = [norm.groupBy("fecha", "hora", "operador_normalizado", "red_normalizada").count(),
                 device_members(norm),
                 zone_members(zone_stats(good, grid_size, cells_ready=True), grid_size)]
        with ThreadPoolExecutor(max_workers=3) as pool:
            (combos, n_combos), (devices, n_devices), (cells, n_cells) = pool.map(materialize, parts)
        # sizes: devices and zones are counted once (the count also picks their
        # numbering), the seed has 5 rows; the four small dimensions are counted
        # below: the combos count grows far beyond theirs, and a join that is
        # not broadcast for it would shuffle the fact by a few keys
        building = {
            "dim_tiempo": (time_members(combos), n_combos),
            "dim_hora": (hour_members(combos), n_combos),
            "dim_operador": (assign_ids(operator_members(combos), "operador_id", ["operador_nombre"],
                                        n_rows=n_combos), n_combos),
            "dim_red": (assign_ids(network_members(combos), "red_id", ["red_tipo"], n_rows=n_combos), n_combos),
            "dim_calidad": (quality_dim(spark), len(C.QUALITY_SEED)),
            "dim_dispositivo": (assign_ids(devices, "dispositivo_id", ["device_id"], n_rows=n_devices), n_devices),
            "dim_zonas": (assign_ids(cells, "zona_id", ["grid_lat", "grid_lon"], n_rows=n_cells), n_cells),
        }
        dims, sizes = {}, {}
        for name, (df, bound) in building.items():
            dims[name] = df.select(*DIM_COLUMNS[name]).persist(StorageLevel.MEMORY_AND_DISK)
            sizes[name] = bound
        small = ["dim_tiempo", "dim_hora", "dim_operador", "dim_red"]
        with ThreadPoolExecutor(max_workers=len(small)) as pool:
            sizes.update(zip(small, pool.map(lambda n: dims[n].count(), small)))
        fact = to_fact_rows(good, dims, sizes, now)
        if materialize_fact:
            from ..session import cut_lineage
            lazy = fact
            fact = cut_lineage(fact)   # queries read the fact, not its lineage
            if fact is not lazy:       # one feed-sized copy: the checkpoint
                good.unpersist()
        return cls(spark, dims, fact, sizes, quarantine=bad)

    @classmethod
    def load(cls, spark: SparkSession, root: str) -> "Warehouse":
        """The warehouse written by the load job (current snapshots)."""
        from concurrent.futures import ThreadPoolExecutor

        from ..plans import commits
        from ..plans.store import read_facts, read_version, read_zones
        st = commits.state(spark, root)
        missing = [n for n in DIM_COLUMNS if n not in st.tables]
        if missing:
            raise FileNotFoundError(f"no warehouse at {root} (missing {', '.join(missing)}): run the load first")
        dims = {name: read_version(spark, root, name, st.tables[name]) for name in DIM_COLUMNS}
        dims["dim_zonas"] = read_zones(spark, root, st)
        # the size checks are small independent counts: run them side by side
        with ThreadPoolExecutor(max_workers=len(dims)) as pool:
            sizes = dict(zip(dims, pool.map(lambda d: d.count(), dims.values())))
        return cls(spark, dims, read_facts(spark, root, st), sizes, root=root)

    AGGREGATES = ("mv_stats_diarias_operador", "mv_stats_zonas", "mv_top_dispositivos")

    def aggregate(self, name: str, use_snapshot: bool = True) -> DataFrame:
        """A pre-aggregate: the refreshed snapshot when the warehouse is
        stored and one exists (what a dashboard should read), else computed
        from the fact."""
        if use_snapshot and self.root is not None:
            from ..plans.store import read_table
            snap = read_table(self.spark, self.root, name)
            if snap is not None:
                return snap
        return {"mv_stats_diarias_operador": self.daily_operator_stats,
                "mv_stats_zonas": self.zone_summary,
                "mv_top_dispositivos": lambda: self.top_devices(ordered=False)}[name]()

    def dim(self, name: str) -> DataFrame:
        return self.dims[name]

    def join(self, df: DataFrame, name: str, on, how: str = "inner", cols: list[str] | None = None):
        d = self.dims[name]
        if cols is not None:
            d = d.select(*cols)
        return dim_join(df, d, on, how, self.sizes.get(name))

    # ------------------------------------------------------------------ views
    def full_view(self, extra: tuple = ()) -> DataFrame:
        """Fact left-joined to all seven dimensions (22 columns, plus any
        ``extra`` fact columns such as the natural key ``source_id``)."""
        f = self.fact.select("medicion_id", "timestamp", "latitude", "longitude", "medida_senal",
                             "medida_velocidad", "medida_altitud", "medida_bateria", "zona_altitud",
                             "tiempo_id", "hora_id", "dispositivo_id", "operador_id", "red_id",
                             "calidad_id", "zona_id", *extra)
        f = self.join(f, "dim_tiempo", "tiempo_id", "left", ["tiempo_id", "fecha", "anio", "mes", "nombre_dia"])
        f = self.join(f, "dim_hora", "hora_id", "left", ["hora_id", "hora", "franja_horaria"])
        f = self.join(f, "dim_dispositivo", "dispositivo_id", "left", ["dispositivo_id", "device_id", "device_name"])
        f = self.join(f, "dim_operador", "operador_id", "left", ["operador_id", "operador_nombre"])
        f = self.join(f, "dim_red", "red_id", "left", ["red_id", "red_tipo", "generacion"])
        f = self.join(f, "dim_calidad", "calidad_id", "left", ["calidad_id", "calidad_categoria"])
        f = self.join(f, "dim_zonas", "zona_id", "left", ["zona_id", "zona_nombre"])
        return f.select("medicion_id", "timestamp", "latitude", "longitude", "medida_senal",
                        "medida_velocidad", "medida_altitud", "medida_bateria", "zona_altitud",
                        "fecha", "anio", "mes", "nombre_dia", "hora", "franja_horaria", "device_id",
                        "device_name", "operador_nombre", "red_tipo", "generacion", "calidad_categoria",
                        "zona_nombre", *extra)

    def analytic_frame(self, ordered: bool = False, date_from=None, date_to=None) -> DataFrame:
        """Fact inner-joined to six dimensions, points only, with the
        analytic column names. Measures are doubles (the analytic frame is a
        float frame). ``date_from``/``date_to`` prune the weekly fact
        partitions and skip row groups before the scan (the only helper
        partition pruning needs: the date slicer is on a dimension column,
        the partition on the fact).
        ``ordered=True`` adds the newest-first order: only at a result edge."""
        f = self.fact
        # the date slicer is on the time dimension; the same bounds are put
        # on the fact itself: the week partition column (partition pruning)
        # and the yyyymmdd key (row-group min/max skipping in time-sorted files)
        if date_from is not None:
            d0 = _dt.date.fromisoformat(str(date_from)[:10])
            monday = d0 - _dt.timedelta(days=d0.weekday())
            f = f.filter((F.col("semana") >= monday.isoformat())
                         & (F.col("tiempo_id") >= int(d0.strftime("%Y%m%d"))))
        if date_to is not None:
            d1 = _dt.date.fromisoformat(str(date_to)[:10])
            f = f.filter((F.col("semana") <= d1.isoformat())
                         & (F.col("tiempo_id") <= int(d1.strftime("%Y%m%d"))))
        f = f.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
        f = f.select("medicion_id", "timestamp",
                     F.col("latitude").cast("double").alias("latitude"),
                     F.col("longitude").cast("double").alias("longitude"),
                     F.col("medida_senal").cast("double").alias("medida_senal"),
                     F.col("medida_altitud").cast("double").alias("medida_altitud"),
                     "zona_id", "zona_altitud", "dispositivo_id", "tiempo_id", "hora_id",
                     "operador_id", "red_id", "calidad_id", "source_id")
        f = self.join(f, "dim_tiempo", "tiempo_id", "inner", ["tiempo_id", "fecha", "nombre_dia", "mes", "anio"])
        f = self.join(f, "dim_hora", "hora_id", "inner", ["hora_id", "hora", "franja_horaria"])
        f = self.join(f, "dim_operador", "operador_id", "inner",
                      ["operador_id", F.col("operador_nombre").alias("operador_normalizado")])
        f = self.join(f, "dim_red", "red_id", "inner", ["red_id", F.col("red_tipo").alias("red_normalizada")])
        f = self.join(f, "dim_calidad", "calidad_id", "inner",
                      ["calidad_id", F.col("calidad_categoria").alias("calidad_senal")])
        f = self.join(f, "dim_dispositivo", "dispositivo_id", "inner", ["dispositivo_id", "device_name"])
        out = f.select("medicion_id", "timestamp", "latitude", "longitude", "medida_senal",
                       "medida_altitud", "zona_id", "zona_altitud", "dispositivo_id", "fecha",
                       "nombre_dia", "mes", "anio", "hora", "franja_horaria", "operador_normalizado",
                       "red_normalizada", "calidad_senal", "device_name", "source_id")
        return out.orderBy(F.col("timestamp").desc(), F.col("source_id")) if ordered else out

    def sample_labels(self, n: int = 5) -> DataFrame:
        """N fact rows with operator, network and quality names (the order
        is by fact key so the sample is reproducible)."""
        f = (self.fact.select("medicion_id", "source_id", "timestamp", "operador_id", "red_id", "calidad_id")
             .orderBy("timestamp", "source_id").limit(n))          # before the joins: they name n rows
        f = self.join(f, "dim_operador", "operador_id", "left", ["operador_id", "operador_nombre"])
        f = self.join(f, "dim_red", "red_id", "left", ["red_id", "red_tipo"])
        f = self.join(f, "dim_calidad", "calidad_id", "left", ["calidad_id", "calidad_categoria"])
        return (f.orderBy("timestamp", "source_id").limit(n)
                 .select("medicion_id", "source_id", "operador_nombre", "red_tipo", "calidad_categoria"))

    # ----------------------------------------------------------- aggregates
    def daily_operator_stats(self) -> DataFrame:
        """A3: per day and operator: count, avg/min/max signal, count per
        quality class, distinct devices. Dimension names are joined *after*
        the aggregate on ids, so the shuffle carries ids, not strings."""
        f = self.fact
        agg = f.groupBy("tiempo_id", "operador_id").agg(
            F.count(F.lit(1)).alias("total_mediciones"),
            exact_avg("medida_senal", 2).alias("senal_promedio"),
            F.min("medida_senal").cast("double").alias("senal_minima"),
            F.max("medida_senal").cast("double").alias("senal_maxima"),
            *[F.count_if(F.col("calidad_id") == cid).alias(f"mediciones_{label.lower()}")
              for _, label, cid in C.SIGNAL_CLASSES + [(None, *C.SIGNAL_CLASS_LAST)]],
            F.count_distinct("dispositivo_id").alias("dispositivos_unicos"),
        )
        agg = self.join(agg, "dim_tiempo", "tiempo_id", "inner", ["tiempo_id", "fecha", "anio", "mes", "nombre_dia"])
        agg = self.join(agg, "dim_operador", "operador_id", "inner", ["operador_id", "operador_nombre"])
        return agg.select("fecha", "anio", "mes", "nombre_dia", "operador_nombre", "total_mediciones",
                          "senal_promedio", "senal_minima", "senal_maxima", "mediciones_excelente",
                          "mediciones_buena", "mediciones_regular", "mediciones_mala",
                          "mediciones_critica", "dispositivos_unicos")

    def zone_summary(self) -> DataFrame:
        """A4: per zone: count, avg and sample stddev of signal, distinct
        operators and devices, last timestamp."""
        agg = self.fact.groupBy("zona_id").agg(
            F.count(F.lit(1)).alias("total_mediciones"),
            exact_avg("medida_senal", 2).alias("senal_promedio"),
            F.round(F.stddev_samp(F.col("medida_senal").cast("double")), 2).alias("senal_desviacion"),
            F.count_distinct("operador_id").alias("operadores_presentes"),
            F.count_distinct("dispositivo_id").alias("dispositivos_unicos"),
            F.max("timestamp").alias("ultima_medicion"),
        )
        z = self.join(agg, "dim_zonas", "zona_id", "inner",
                      ["zona_id", "zona_nombre", "grid_lat", "grid_lon", "centro_lat", "centro_lon"])
        return z.select("zona_id", "zona_nombre", "grid_lat", "grid_lon", "centro_lat", "centro_lon",
                        "total_mediciones", "senal_promedio", "senal_desviacion", "operadores_presentes",
                        "dispositivos_unicos", "ultima_medicion")

    def top_devices(self, ordered: bool = True) -> DataFrame:
        """A5: per device: count, avg signal, distinct zones, first/last
        timestamp; most measurements first (order applied at read, T21)."""
        agg = self.fact.groupBy("dispositivo_id").agg(
            F.count(F.lit(1)).alias("total_mediciones"),
            exact_avg("medida_senal", 2).alias("senal_promedio"),
            F.count_distinct("zona_id").alias("zonas_visitadas"),
            F.min("timestamp").alias("primera_medicion"),
            F.max("timestamp").alias("ultima_medicion"),
        )
        d = self.join(agg, "dim_dispositivo", "dispositivo_id", "inner",
                      ["dispositivo_id", "device_id", "device_name"])
        out = d.select("dispositivo_id", "device_id", "device_name", "total_mediciones",
                       "senal_promedio", "zonas_visitadas", "primera_medicion", "ultima_medicion")
        return out.orderBy(F.col("total_mediciones").desc(), "dispositivo_id") if ordered else out

    def global_summary(self) -> DataFrame:
        """One row: count, distinct devices and zones, period, avg signal."""
        return self.fact.agg(
            F.count(F.lit(1)).alias("total_mediciones"),
            F.count_distinct("dispositivo_id").alias("dispositivos"),
            F.count_distinct("zona_id").alias("zonas"),
            F.min("timestamp").alias("fecha_inicio"),
            F.max("timestamp").alias("fecha_fin"),
            exact_avg("medida_senal", 2).alias("senal_promedio"),
        )

    def partition_counts(self, reference_bounds: bool = False) -> DataFrame:
        """Rows per weekly partition, the default partition included.
        ``reference_bounds=True`` labels by the fixed original ranges."""
        label = (X.reference_partition("timestamp") if reference_bounds else F.col("semana"))
        return self.fact.groupBy(label.alias("semana")).agg(F.count(F.lit(1)).alias("registros"))

    def table_counts(self) -> DataFrame:
        """Row count per table (one small frame per table, unioned)."""
        parts = [d.agg(F.count(F.lit(1)).alias("registros")).select(F.lit(n).alias("tabla"), "registros")
                 for n, d in self.dims.items()]
        parts.append(self.fact.agg(F.count(F.lit(1)).alias("registros"))
                     .select(F.lit("fact_mediciones").alias("tabla"), "registros"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def zone_layer_precomputed(self) -> DataFrame:
        """The zone pre-aggregate (its refreshed snapshot when stored)
        joined to the zone geometry."""
        s = self.aggregate("mv_stats_zonas").select("zona_id", "total_mediciones", "senal_promedio",
                                                    "senal_desviacion", "zona_nombre")
        z = self.join(s, "dim_zonas", "zona_id", "inner",
                      ["zona_id", "grid_latitud_inicio", "grid_latitud_fin", "grid_longitud_inicio",
                       "grid_longitud_fin", "altitud_promedio"])
        return z.orderBy(F.col("total_mediciones").desc(), "zona_id")

    def devices_without_data(self) -> DataFrame:
        """Dimension devices with no fact row, by name. The anti join probes the
        (small) distinct fact device ids, so the fact side is reduced by a
        partial aggregate before any shuffle."""
        used = self.fact.select("dispositivo_id").distinct()
        return (self.dims["dim_dispositivo"].join(used, "dispositivo_id", "left_anti")
                .select("dispositivo_id", "device_name").orderBy(F.col("device_name").asc_nulls_first(), "dispositivo_id"))

    def device_reconciliation(self) -> DataFrame:
        """Q1: devices in the dimension, in the fact, with coordinates, and
        distinct names with located data - four numbers in one row."""
        by_device = self.fact.groupBy("dispositivo_id").agg(
            F.count_if(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).alias("located"))
        members = self.dims["dim_dispositivo"].select(F.col("dispositivo_id").alias("member"), "device_name")
        met = by_device.join(members, F.col("dispositivo_id") == F.col("member"), "full_outer")
        return met.agg(F.count("member").alias("total_dim"), F.count("dispositivo_id").alias("total_fact"),
                       F.count_if(F.col("located") > 0).alias("con_coords"),
                       F.count_distinct(F.when(F.col("located") > 0, F.col("device_name"))).alias("con_nombre"))

    def dim_list(self, name: str) -> DataFrame:
        """T2s: the ordered member lists of the slicers."""
        spec = {
            "operador": ("dim_operador", ["operador_id", F.col("operador_nombre").alias("operador_normalizado")],
                         "operador_normalizado"),
            "red": ("dim_red", ["red_id", F.col("red_tipo").alias("red_normalizada")], "red_normalizada"),
            "calidad": ("dim_calidad", ["calidad_id", F.col("calidad_categoria").alias("calidad_senal")],
                        "calidad_id"),
            "dispositivo": ("dim_dispositivo", ["dispositivo_id", "device_name"], "device_name"),
        }[name]
        dim, cols, order = spec
        return self.dims[dim].select(*cols).orderBy(order)

    def register_views(self, prefix: str = "") -> list[str]:
        """Expose the warehouse to Spark SQL as temporary views with the
        warehouse's table names: the seven dimensions, ``fact_mediciones``,
        the wide view ``v_mediciones_completas`` (J2) and the three
        aggregates (their snapshots when stored). SQL over them is planned by
        Catalyst like the DataFrame code (pushdown, pruning, broadcast)."""
        names = []
        for name, df in self.dims.items():
            df.createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        self.fact.createOrReplaceTempView(prefix + "fact_mediciones")
        self.full_view().createOrReplaceTempView(prefix + "v_mediciones_completas")
        names += [prefix + "fact_mediciones", prefix + "v_mediciones_completas"]
        for name in self.AGGREGATES:
            self.aggregate(name).createOrReplaceTempView(prefix + name)
            names.append(prefix + name)
        return names

    def unpersist(self) -> None:
        for d in self.dims.values():
            d.unpersist()

