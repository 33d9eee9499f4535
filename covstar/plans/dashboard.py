"""The dashboard's datasets for one set of slicers, as lazy DataFrames.

``dashboard(w, ...)`` returns every dataset the four dashboard tabs show
(summary, coverage map, time analysis, device tracking). Nothing is
computed until a dataset is used; the map layers that sample (points, heat)
are returned as functions because a sample needs one aggregate first.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import constants as C
from ..operators import analytics as A
from ..operators import layers as L
from ..operators.warehouse import Warehouse


def dashboard(w: Warehouse, date_from=None, date_to=None, hour_from=None, hour_to=None, operador=None,
              red=None, calidad=None, franja=None, device: str | None = None,
              heat_points: int = C.HEAT_DEFAULT_POINTS, points: int | None = None, seed: int = 42) -> dict:
    base = w.analytic_frame()                                   # unsliced (device tab, domains)
    pruned = w.analytic_frame(date_from=None if date_from in A.ALL else date_from,
                              date_to=None if date_to in A.ALL else date_to)
    df = A.slice(pruned, date_from, date_to, hour_from, hour_to, operador, red, calidad, franja)
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    out = {
        # header and slicers
        "header": A.header_counts(base, w.dims["dim_operador"]),
        "domains": A.filter_domains(base),
        "filtered_rows": df.agg(F.count(F.lit(1)).alias("registros_filtrados")),
        # summary tab
        "kpis": A.kpis(df),
        "operator_share": A.operator_share(df),
        "quality_counts": A.value_counts(df, "calidad_senal"),
        "signal_by_operator": A.signal_by_operator(df),
        # map tab
        "map_center": A.centroid(pts),
        "points_layer": lambda: L.points_layer(pts, points, seed),
        "heat_layer": lambda: L.heat_layer(pts, heat_points, seed),
        "cluster_layer": L.cluster_layer(pts),
        "zone_layer": A.zone_layer(pts, w.dims["dim_zonas"], w.sizes.get("dim_zonas")),
        # time tab
        "weekday_counts": A.value_counts(df, "nombre_dia"),
        "day_part_counts": A.value_counts(df, "franja_horaria"),
        "daily_evolution": A.daily_evolution(df),
        "day_part_matrix": A.day_part_matrix(df),
        # device lists (ordered at the edge)
        "device_list": w.dim_list("dispositivo"),
    }
    if device is not None:
        # device tab: the unsliced frame of one model
        d = A.device_rows(base, device)
        out.update({
            "device_card": A.device_kpis(d),
            "device_center": A.centroid(d),
            "device_trail": L.device_trails(d),
            "device_endpoints": L.trail_endpoints(d),
            "device_timeline": L.device_timeline(d, device),
            "device_log": L.device_log(base, device),
        })
    return out
