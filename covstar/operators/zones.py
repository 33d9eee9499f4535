"""Density-ranked zone build (A2 at 0.04, W1, P18, P19, T4s, A19)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .. import functions as X
from .clean import nan_to_null, valid_points
from .dimensions import dense_number, zone_stats

ZONE_BUILD_COLUMNS = ["zona_id", "zona_nombre", "centro_lat", "centro_lon", "total_mediciones",
                      "altitud_promedio", "grid_latitud_inicio", "grid_latitud_fin",
                      "grid_longitud_inicio", "grid_longitud_fin"]


def rank_zones(stats: DataFrame) -> DataFrame:
    """Density rank = position by count descending (ties by cell), as a
    consecutive id over the cell aggregate (never the measurements); many
    cells are numbered without a single task (``dense_number``)."""
    order = [-F.col("total_mediciones"), "grid_lat", "grid_lon"]
    return dense_number(stats, order, "zona_id", id_type="long")


def build_zones(raw: DataFrame, size: float = C.GRID_SIZE_ZONES, grid_mode: str = "trunc") -> DataFrame:
    """The zone build: points with coordinates -> grid cells -> count, centre,
    mean altitude -> density rank -> ``ZONA_<rank>_<density>`` -> bounds."""
    pts = valid_points(nan_to_null(raw.select("latitude", "longitude", "altitude")))
    z = rank_zones(zone_stats(pts, size, grid_mode))
    z = z.withColumn("zona_nombre", X.density_zone_name("zona_id", "total_mediciones"))
    z = X.with_cell_bounds(z, size)
    return z.select(*ZONE_BUILD_COLUMNS, "grid_lat", "grid_lon")


def top_zones(zones: DataFrame, n: int = 10) -> DataFrame:
    """T4s: the n densest zones, in id order."""
    return zones.orderBy("zona_id").limit(int(n))


def zone_build_summary(zones: DataFrame) -> DataFrame:
    """Largest, smallest and mean measurement count per zone."""
    return zones.agg(F.max("total_mediciones").alias("max_mediciones"),
                     F.min("total_mediciones").alias("min_mediciones"),
                     F.round(F.avg(F.col("total_mediciones").cast("decimal(28,12)")), 2)
                      .cast("double").alias("promedio_mediciones"),
                     F.count(F.lit(1)).alias("zonas"))
