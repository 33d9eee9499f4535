"""Dimension members, surrogate keys and zone statistics."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import functions as X
from .clean import drop_null_members
from .joins import broadcastable


def exact_avg(c: str | Column, scale: int) -> Column:
    """Average rounded to ``scale`` decimals without double rounding: the
    values are widened to DECIMAL(28,12) so the sum is exact and the quotient
    carries 16 decimals before the final HALF_UP rounding. A value beyond that
    type counts as missing."""
    x = F.col(c) if isinstance(c, str) else c
    return F.round(F.avg(x.try_cast(T.DecimalType(28, 12))), scale).cast("double")


# Rows that one numbering bucket holds on average.
ROWS_PER_BUCKET = 1_000_000


def _bounds_upto(bounds: list[Column], key: Column, before: int = 0) -> Column:
    """How many of the ascending bounds are at most ``key``, by halving."""
    if not bounds:
        return F.lit(before)
    mid = len(bounds) // 2
    return (F.when(bounds[mid] <= key, _bounds_upto(bounds[mid + 1:], key, before + mid + 1))
             .otherwise(_bounds_upto(bounds[:mid], key, before)))


def dense_number(df: DataFrame, order_by: list, id_col: str, base: int = 0, n_rows: int | None = None,
                 per_bucket: int = ROWS_PER_BUCKET, id_type: str = "int") -> DataFrame:
    """Consecutive numbers ``base+1 .. base+n`` in ascending ``order_by`` order
    (the order columns must identify a row; NULL first), in one form for every
    size: rows fall into ordered buckets between fixed bounds (quantiles of a
    hash sample, 32 rows for each bucket; a row finds its own by halving them),
    ``row_number`` numbers a bucket, and the rows of the buckets before it (one
    count for each bucket) are added.
    Bounds and counts are literals in the plan, so a recomputed task gives the
    same numbers."""
    key = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(f"k{i}") for i, c in enumerate(order_by)])
    keyed = df.withColumn("_key", key)
    n_rows = df.count() if n_rows is None else n_rows
    buckets = max(1, -(-n_rows // per_bucket))
    sample = keyed.select("_key").orderBy(F.xxhash64("_key")).limit(32 * buckets).orderBy("_key").collect() if buckets > 1 else []
    kind = keyed.schema["_key"].dataType
    bounds = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r["_key"], kind.fields)])
              for r in sample[32::32]]
    # inside a lambda a tree of any size is evaluated along one path, not generated as code
    bucket = F.transform(F.array("_key"), lambda k: _bounds_upto(bounds, k))[0] if bounds else F.lit(0)
    keyed = keyed.withColumn("_bucket", bucket)
    before = F.lit(0)
    if bounds:                                # one row for each bucket
        counts = dict(keyed.groupBy("_bucket").agg(F.count(F.lit(1))).collect())
        at = [sum(n for b, n in counts.items() if b < i) for i in range(len(bounds) + 1)]
        before = F.get(F.array(*[F.lit(x).cast("long") for x in at]), F.col("_bucket"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("_key"))
    return (keyed.withColumn(id_col, (F.lit(int(base)) + before + rank).cast(id_type)).drop("_key", "_bucket"))


def assign_ids(new: DataFrame, id_col: str, order_by: list[str],
               existing: DataFrame | None = None, n_rows: int | None = None) -> DataFrame:
    """K4: serial surrogate keys for new members, continuing after the largest
    existing id, numbered in natural-key order. Only dimension members are
    numbered (never facts), and only the new ones."""
    base = 0
    if existing is not None:
        # one scalar: the largest id already used
        base = existing.agg(F.max(id_col)).first()[0] or 0
    return dense_number(new, order_by, id_col, base, n_rows)


def first_per_key(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key in ``order_by`` order, as an aggregate
    (``min`` of a struct) rather than a window: the map-side partial
    aggregation folds a hot key before the shuffle."""
    rest = [c for c in df.columns if c not in keys]
    ordered = order_by + [c for c in rest if c not in order_by]
    packed = F.min(F.struct(*[F.col(c) for c in ordered])).alias("_first")
    return df.groupBy(*keys).agg(packed).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in rest])


def dedupe_counted(df: DataFrame, keys: list[str], order_by: list[str], held: list) -> DataFrame:
    """W3 in two steps, for frames with few repeated keys: one hash aggregate
    counts the keys (only keys travel, a hot key is folded in each task); rows
    of keys that occur once pass with their partitioning, the others are
    reduced by ``first_per_key``. The repeated keys are persisted (appended to
    ``held``) and counted: beyond the broadcast limit all rows take the second
    step, with the same result."""
    again = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    again = again.select(*[F.col(k).alias(f"_r_{k}") for k in keys]).persist(StorageLevel.MEMORY_AND_DISK)
    held.append(again)
    if not broadcastable(again, again.count()):
        return first_per_key(df, keys, order_by).select(*df.columns)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    single = df.join(F.broadcast(again), same, "left_anti")
    many = df.join(F.broadcast(again), same, "left_semi")
    return single.unionByName(first_per_key(many, keys, order_by).select(*df.columns))


# --- dimension members from the normalised frame (A1) ----------------------

def time_members(norm: DataFrame) -> DataFrame:
    """dim_tiempo: one row per date with its calendar attributes."""
    d = drop_null_members(norm.select("fecha"), "fecha").distinct()
    return d.select("fecha", *[e.alias(n) for n, e in X.calendar_columns("fecha").items()])


def hour_members(norm: DataFrame) -> DataFrame:
    """dim_hora: hora_id = hour, day part."""
    h = drop_null_members(norm.select("hora"), "hora").distinct()
    return h.select(F.col("hora").alias("hora_id"), "hora", X.day_part("hora").alias("franja_horaria"))


def operator_members(norm: DataFrame) -> DataFrame:
    return drop_null_members(norm.select(F.col("operador_normalizado").alias("operador_nombre")),
                             "operador_nombre").distinct()


def network_members(norm: DataFrame) -> DataFrame:
    m = drop_null_members(norm.select(F.col("red_normalizada").alias("red_tipo")), "red_tipo").distinct()
    return m.withColumn("generacion", X.network_generation("red_tipo"))


def device_members(norm: DataFrame) -> DataFrame:
    """dim_dispositivo members: one row per device key; of several names the
    smallest is kept (deterministic form of keep-first)."""
    # distinct pairs first (hash aggregate, partial per task), so the
    # min-by-name step only sees one row per (id, name)
    d = drop_null_members(norm.select("device_id", "device_name"), "device_id").distinct()
    return d.groupBy("device_id").agg(F.min("device_name").alias("device_name"))


def quality_dim(spark: SparkSession) -> DataFrame:
    """The seeded quality dimension."""
    schema = "calidad_id int, calidad_categoria string, signal_min int, signal_max int, descripcion string"
    return spark.createDataFrame(C.QUALITY_SEED, schema)


def zone_stats(df: DataFrame, size: float = C.GRID_SIZE_ETL, grid_mode: str = "trunc",
               cells_ready: bool = False) -> DataFrame:
    """A2: per grid cell, count, centre (6 dp) and mean altitude (2 dp).
    A hash aggregate: partial counts/sums per task, one shuffle of one row
    per (task, cell)."""
    if not cells_ready:
        df = df.withColumns({"grid_lat": X.grid_cell("latitude", size, grid_mode),
                             "grid_lon": X.grid_cell("longitude", size, grid_mode)})
    return df.groupBy("grid_lat", "grid_lon").agg(
        F.count(F.lit(1)).alias("total_mediciones"),
        exact_avg("latitude", 6).alias("centro_lat"),
        exact_avg("longitude", 6).alias("centro_lon"),
        exact_avg("altitude", 2).alias("altitud_promedio"),
    )


def zone_members(stats: DataFrame, size: float = C.GRID_SIZE_ETL) -> DataFrame:
    """dim_zonas attributes of zone stats: name and cell bounds."""
    z = stats.withColumn("zona_nombre", X.zone_name("grid_lat", "grid_lon"))
    lat0, lat1 = X.cell_bounds("grid_lat", size)
    lon0, lon1 = X.cell_bounds("grid_lon", size)
    return z.withColumns({
        "grid_latitud_inicio": F.round(lat0, 6), "grid_latitud_fin": F.round(lat1, 6),
        "grid_longitud_inicio": F.round(lon0, 6), "grid_longitud_fin": F.round(lon1, 6),
    })


DIM_COLUMNS = {
    "dim_tiempo": ["tiempo_id", "fecha", "anio", "trimestre", "mes", "semana_anio", "dia_mes",
                   "dia_semana", "nombre_dia", "nombres_mes"],
    "dim_hora": ["hora_id", "hora", "franja_horaria"],
    "dim_operador": ["operador_id", "operador_nombre"],
    "dim_red": ["red_id", "red_tipo", "generacion"],
    "dim_calidad": ["calidad_id", "calidad_categoria", "signal_min", "signal_max", "descripcion"],
    "dim_dispositivo": ["dispositivo_id", "device_id", "device_name"],
    "dim_zonas": ["zona_id", "zona_nombre", "grid_lat", "grid_lon", "centro_lat", "centro_lon",
                  "total_mediciones", "altitud_promedio", "grid_latitud_inicio", "grid_latitud_fin",
                  "grid_longitud_inicio", "grid_longitud_fin"],
}

# K5: audit columns of the stored dimensions (default: load time)
AUDIT_COLUMNS = {
    "dim_operador": ["created_at"], "dim_red": ["created_at"],
    "dim_dispositivo": ["created_at", "updated_at"], "dim_zonas": ["created_at"],
}

