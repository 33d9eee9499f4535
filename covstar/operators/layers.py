"""Render-ready map layers, samples and device trails (L1-L8, T3s-T6s, W4).

No function here collects rows: samples are the n smallest seeded hashes,
found through an exact cutoff of the hash; trails are
globally sorted long-form rows (range partitioning splits a hot device
across tasks); endpoints are aggregates with map-side partial results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .. import functions as X
from .dimensions import exact_avg


def sample_hash(seed: int = 42, key: str = "source_id"):
    """Seeded sample order: md5 of ``seed|key`` as lowercase hex (a NULL key as
    an empty one). Its leading hex digits are uniform, and any SQL engine
    computes the same value, so a sample can be checked against SQL."""
    return F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col(key).cast("string"), F.lit(""))))


def sample_n(df: DataFrame, n: int, seed: int = 42, key: str = "source_id", ties=("timestamp",),
             digits: int = 4) -> DataFrame:
    """T5s: exactly ``min(n, rows)`` rows, reproducible for a seed: the rows
    with the n smallest seeded hashes (ties by the key columns).

    One aggregate counts the rows by the first ``digits`` hex digits of the
    hash (65,536 counts); the smallest prefix up to which n rows lie is an exact
    cutoff, so only those rows (and no more than one further prefix) are
    ordered, whatever the size of ``df``."""
    n = int(n)
    h = sample_hash(seed, key)
    prefix = F.substring(h, 1, digits)
    upto, cutoff = 0, ""
    for r in df.groupBy(prefix.alias("p")).agg(F.count(F.lit(1)).alias("n")).orderBy("p").collect():
        upto, cutoff = upto + r["n"], r["p"]
        if upto >= n:
            break
    return df.filter(prefix <= cutoff).withColumn("_h", h).orderBy("_h", key, *ties).limit(n).drop("_h")


def points_columns(df: DataFrame) -> DataFrame:
    """L1 rows before sampling: coordinates, colour and the popup fields."""
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return pts.select("medicion_id", "source_id", "timestamp", "latitude", "longitude",
                      X.class_color("calidad_senal").alias("color"),
                      "operador_normalizado", "red_normalizada", "medida_senal", "calidad_senal")


def points_layer(df: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """L1: the quality points, all of them, or a seeded sample of ``n``."""
    pts = points_columns(df)
    return pts if n is None else sample_n(pts, n, seed)


def heat_columns(df: DataFrame) -> DataFrame:
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return pts.select("medicion_id", "source_id", "timestamp", "latitude", "longitude",
                      X.heat_weight("medida_senal").alias("peso"))


def heat_layer(df: DataFrame, n: int = C.HEAT_DEFAULT_POINTS, seed: int = 42) -> DataFrame:
    """L2: ``min(n, rows)`` sampled heat points weighted by |signal|."""
    return sample_n(heat_columns(df), n, seed)


def cluster_layer(df: DataFrame, cell: float | None = None) -> DataFrame:
    """L3: every filtered point with operator, signal and device. With
    ``cell`` the points are pre-clustered on a grid (count + centroid per
    cell), so the output is bounded by the number of cells."""
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    if cell is None:
        return pts.select("medicion_id", "latitude", "longitude", "operador_normalizado",
                          "medida_senal", "device_name")
    g = pts.withColumns({"celda_lat": X.grid_cell("latitude", cell, "floor"),
                         "celda_lon": X.grid_cell("longitude", cell, "floor")})
    return g.groupBy("celda_lat", "celda_lon").agg(
        F.count(F.lit(1)).alias("puntos"),
        exact_avg("latitude", 6).alias("centro_lat"),
        exact_avg("longitude", 6).alias("centro_lon"))


def device_trails(df: DataFrame, ordered: bool = True) -> DataFrame:
    """The trail of every device model as ordered long-form rows
    (model, time, id, lat, lon). The global sort range-partitions on
    (model, time, id), so one very active model spreads over many tasks."""
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    out = pts.select("device_name", "timestamp", "source_id", "latitude", "longitude", "calidad_senal",
                     X.class_color("calidad_senal").alias("color"))
    return out.orderBy("device_name", "timestamp", "source_id") if ordered else out


def trail_endpoints(df: DataFrame) -> DataFrame:
    """Start and end point of each model's trail: ``min_by`` / ``max_by``
    on (time, id) - an aggregate, partial per task, skew-safe."""
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    order = F.struct("timestamp", "source_id")
    point = F.struct("latitude", "longitude")
    return (pts.groupBy("device_name")
               .agg(F.min_by(point, order).alias("inicio"), F.max_by(point, order).alias("fin"))
               .select("device_name",
                       F.col("inicio.latitude").alias("inicio_lat"), F.col("inicio.longitude").alias("inicio_lon"),
                       F.col("fin.latitude").alias("fin_lat"), F.col("fin.longitude").alias("fin_lon")))


def device_timeline(df: DataFrame, name: str | None = None, ordered: bool = True) -> DataFrame:
    """Signal over time of one model (or all models, keyed by name)."""
    d = df if name is None else df.filter(F.col("device_name") == name)
    out = d.select("device_name", "timestamp", "source_id", "medida_senal")
    return out.orderBy("device_name", "timestamp", "source_id") if ordered else out


DEVICE_LOG_COLUMNS = ["timestamp", "operador_normalizado", "red_normalizada", "calidad_senal",
                      "medida_senal", "latitude", "longitude", "zona_altitud"]


def device_log(df: DataFrame, name: str, n: int = C.DEVICE_LOG_ROWS) -> DataFrame:
    """T3s: first ``n`` rows of a model in time order, 8 columns."""
    d = df.filter(F.col("device_name") == name)
    return d.orderBy("timestamp", "source_id").limit(int(n)).select(*DEVICE_LOG_COLUMNS)

