"""The zone build job: density-ranked grid zones -> CSV export (K7)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from .. import constants as C
from ..operators.zones import ZONE_BUILD_COLUMNS, build_zones, top_zones, zone_build_summary
from . import store


def run_zone_build(raw: DataFrame, out_path: str, size: float = C.GRID_SIZE_ZONES) -> dict:
    """Build the zones, export them as one CSV (a dimension: one row per
    cell) and return the top-10 and the summary as small row lists."""
    zones = build_zones(raw, size).persist()
    n = zones.count()
    store.export_csv(zones.select(*ZONE_BUILD_COLUMNS).orderBy("zona_id"), out_path, single_file=True, rows=n)
    top = [r.asDict() for r in top_zones(zones, 10).collect()]          # 10 rows
    summary = zone_build_summary(zones).first().asDict()                # 1 row
    zones.unpersist()
    return {"top": top, "summary": summary}
