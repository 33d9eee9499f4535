"""Grid and geometry expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from ._util import ColumnOrName, col


def grid_cell(c: ColumnOrName, size: float = C.GRID_SIZE_ETL, mode: str = "trunc") -> Column:
    """Grid index of a coordinate.

    ``mode="trunc"`` reproduces the warehouse rule ``int(coord / size)``, which
    truncates toward zero (so the cells either side of 0 merge, and for
    negative coordinates the ``[g, g+1] * size`` box is the neighbouring cell).
    ``mode="floor"`` gives true cells whose box contains every point.
    ``try_cast`` keeps an out-of-range value NULL instead of failing the job.
    """
    q = col(c) / F.lit(float(size))
    if mode == "trunc":
        return q.try_cast("int")
    if mode == "floor":
        return F.floor(q).try_cast("int")
    raise ValueError(f"unknown grid mode {mode!r}")


def cell_bounds(g: ColumnOrName, size: float = C.GRID_SIZE_ETL) -> tuple[Column, Column]:
    """(start, end) of cell ``g`` on one axis: ``g*size`` and ``(g+1)*size``."""
    x = col(g)
    return x * F.lit(float(size)), (x + 1) * F.lit(float(size))


def with_cell_bounds(df, size: float = C.GRID_SIZE_ETL, lat: str = "grid_lat", lon: str = "grid_lon"):
    lat0, lat1 = cell_bounds(lat, size)
    lon0, lon1 = cell_bounds(lon, size)
    return df.withColumns({
        "grid_latitud_inicio": lat0, "grid_latitud_fin": lat1,
        "grid_longitud_inicio": lon0, "grid_longitud_fin": lon1,
    })


def sector_id(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Fine sector key ``int(lat*1e4)_int(lon*1e4)`` (truncation toward zero)."""
    return F.concat((col(lat) * 10000).try_cast("int"), F.lit("_"),
                    (col(lon) * 10000).try_cast("int"))


def zone_name(grid_lat: ColumnOrName, grid_lon: ColumnOrName) -> Column:
    """Warehouse zone name ``ZONA_<grid_lat>_<grid_lon>``."""
    return F.concat(F.lit(C.ZONE_PREFIX), col(grid_lat), F.lit("_"), col(grid_lon))


def density_label(n: ColumnOrName) -> Column:
    x = col(n)
    expr = None
    for bound, label in C.ZONE_DENSITY:
        cond = x >= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.ZONE_DENSITY_LAST))


def density_zone_name(rank: ColumnOrName, n: ColumnOrName) -> Column:
    """Ranked zone name ``ZONA_<rank>_<ALTA|MEDIA|BAJA>``."""
    return F.concat(F.lit(C.ZONE_PREFIX), col(rank), F.lit("_"), density_label(n))


def kmh(c: ColumnOrName) -> Column:
    """m/s -> km/h."""
    return col(c) * F.lit(3.6)
