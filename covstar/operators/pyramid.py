"""Zoom pyramid of the cluster layer (L3): cells of every zoom from one scan.

The plane of degrees is a quadtree: zoom z has 2**z columns of longitude and 2**z
rows of latitude. The points are aggregated once, in the cells of the finest zoom;
these cells are then folded into all zooms by one aggregate, so no point is read
twice. Sums are exact decimals, so every zoom equals a direct aggregate of the points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SUMS = {"puntos": "long", "con_senal": "long", "suma_senal": "decimal(30,2)", "suma_lat": "decimal(30,6)", "suma_lon": "decimal(30,6)"}


def _folded(cells: DataFrame, *keys: str) -> DataFrame:
    return cells.groupBy(*keys).agg(*[F.sum(c).cast(t).alias(c) for c, t in _SUMS.items()])


def quadkey(x: str, y: str, zoom: int):
    """The cell's path from the root, one digit 0 to 3 for each zoom."""
    if zoom == 0:
        return F.lit("")
    digit = lambda i: F.expr(f"CAST((shiftright({x}, {i}) & 1) + 2 * (shiftright({y}, {i}) & 1) AS STRING)")
    return F.concat(*[digit(i) for i in range(zoom - 1, -1, -1)])


def zoom_pyramid(points: DataFrame, finest: int = 14, coarsest: int = 0, lat: str = "latitude", lon: str = "longitude",
                 signal: str = "medida_senal") -> DataFrame:
    """(zoom, quadkey, puntos, senal_promedio, centro_lat, centro_lon) of every
    occupied cell of the zooms ``coarsest`` to ``finest``. Points without
    coordinates are left out; those on the far edges belong to the last cell."""
    side = 1 << finest
    cell = lambda share: F.least(F.greatest(F.floor(share * side), F.lit(0)), F.lit(side - 1)).cast("int")
    cells = _folded(points.filter(F.col(lat).isNotNull() & F.col(lon).isNotNull()).select(
        cell((F.col(lon) + 180) / 360).alias("x"), cell((F.lit(90) - F.col(lat)) / 180).alias("y"),
        F.lit(1).cast("long").alias("puntos"), F.col(signal).isNotNull().cast("long").alias("con_senal"),
        F.col(signal).cast("decimal(12,2)").alias("suma_senal"),
        F.col(lat).cast("decimal(12,6)").alias("suma_lat"), F.col(lon).cast("decimal(12,6)").alias("suma_lon")), "x", "y")
    zooms = F.explode(F.array(*[F.lit(z) for z in range(coarsest, finest + 1)])).alias("zoom")
    up = lambda c: F.expr(f"shiftright({c}, {finest} - zoom)").alias(c)
    level = _folded(cells.select("x", "y", *_SUMS, zooms).select("zoom", up("x"), up("y"), *_SUMS), "zoom", "x", "y")
    mean = lambda total, n, scale: F.round(F.col(total).cast("decimal(24,6)") / F.col(n).cast("decimal(14,0)"), scale).cast("double")
    path = None
    for z in range(coarsest, finest + 1):
        path = F.when(F.col("zoom") == z, quadkey("x", "y", z)) if path is None else path.when(F.col("zoom") == z, quadkey("x", "y", z))
    return level.select(
        "zoom", path.alias("quadkey"), "puntos",
        F.when(F.col("con_senal") > 0, mean("suma_senal", "con_senal", 2)).alias("senal_promedio"),
        mean("suma_lat", "puntos", 6).alias("centro_lat"), mean("suma_lon", "puntos", 6).alias("centro_lon"))
