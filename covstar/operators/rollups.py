"""Mergeable partial states of the three pre-aggregates (K8).

A state holds counts, exact decimal sums and sums of squares, extremes, and exact
distinct counts as bitmaps of the dense surrogate ids (32,768 ids a bitmap). The
states of disjoint sets of facts merge to the state of all of them, so an
aggregate over all history is the merge of one small state for each week.

A state is long: one row for each (group, kind, bucket). Rows of kind ``""`` carry
the measures, rows of another kind one bitmap of that id column. No row grows with
the facts, and a group that holds most facts is folded in each task first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

_CLASSES = C.SIGNAL_CLASSES + [(None, *C.SIGNAL_CLASS_LAST)]

#: aggregate -> (group columns, id columns counted distinct)
SPECS = {
    "mv_stats_diarias_operador": (["tiempo_id", "operador_id"], ["dispositivo_id"]),
    "mv_stats_zonas": (["zona_id"], ["operador_id", "dispositivo_id"]),
    "mv_top_dispositivos": (["dispositivo_id"], ["zona_id"]),
    "resumen": ([], ["dispositivo_id", "zona_id"]),
}

_SUM, _SQUARES = "decimal(30,2)", "decimal(38,4)"


def _measures() -> dict[str, Column]:
    signal = F.col("medida_senal")
    return {
        "n": F.count(F.lit(1)), "n_senal": F.count("medida_senal"),
        "suma": F.sum(signal).cast(_SUM), "cuadrados": F.sum((signal * signal).cast("decimal(24,4)")).cast(_SQUARES),
        "minimo": F.min(signal), "maximo": F.max(signal), "primera": F.min("timestamp"), "ultima": F.max("timestamp"),
        **{f"clase_{cid}": F.count_if(F.col("calidad_id") == cid) for _, _, cid in _CLASSES},
    }


_MERGE = {"suma": F.sum, "cuadrados": F.sum, "minimo": F.min, "maximo": F.max, "primera": F.min, "ultima": F.max}


def _merged(name: str, c: str) -> Column:
    out = _MERGE.get(name, F.sum)(c)
    return out.cast({"suma": _SUM, "cuadrados": _SQUARES}[name]) if name in ("suma", "cuadrados") else out


def partial_state(fact: DataFrame, name: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The state of ``fact`` for an aggregate, apart for each value of ``by``."""
    groups, ids = SPECS[name]
    keys = [*by, *groups]
    measures = _measures()
    head = fact.groupBy(*keys).agg(*[e.alias(m) for m, e in measures.items()])
    parts = [head.select(*keys, F.lit("").alias("kind"), F.lit(None).cast("long").alias("bucket"), *measures,
                         F.lit(None).cast("binary").alias("bits"))]
    for c in ids:
        own = fact.filter(F.col(c).isNotNull()).select(
            *keys, F.bitmap_bucket_number(F.col(c).cast("long")).alias("bucket"), F.bitmap_bit_position(F.col(c).cast("long")).alias("place"))
        maps = own.groupBy(*keys, "bucket").agg(F.bitmap_construct_agg("place").alias("bits"))
        empty = [F.lit(None).cast(head.schema[m].dataType).alias(m) for m in measures]
        parts.append(maps.select(*keys, F.lit(c).alias("kind"), "bucket", *empty, "bits"))
    return reduce(DataFrame.unionByName, parts)


def merge_states(states: DataFrame, name: str) -> DataFrame:
    """One state of many."""
    groups, _ = SPECS[name]
    return states.groupBy(*groups, "kind", "bucket").agg(
        *[_merged(m, m).alias(m) for m in _measures()], F.bitmap_or_agg("bits").alias("bits"))


def finished(states: DataFrame, name: str) -> DataFrame:
    """Group columns, measures and ``unicos_<id>`` of the merged states."""
    groups, ids = SPECS[name]
    distinct = [F.sum(F.when(F.col("kind") == c, F.bitmap_count("bits"))).alias(f"unicos_{c}") for c in ids]
    own = {m: F.max(F.when(F.col("kind") == "", F.col(m))).alias(m) for m in _measures()}
    out = merge_states(states, name).groupBy(*groups).agg(*own.values(), *distinct)
    mean = F.round((F.col("suma").cast("decimal(24,2)") / F.col("n_senal").cast("decimal(14,0)")), 2).cast("double")
    # sample deviation from exact sums: the numerator is exact, one division and one root follow
    spread = F.col("cuadrados").cast("double") - F.col("suma").cast("double") * F.col("suma").cast("double") / F.col("n_senal")
    deviation = F.when(F.col("n_senal") > 1, F.round(F.sqrt(F.greatest(spread, F.lit(0.0)) / (F.col("n_senal") - 1)), 2))
    return out.withColumns({"media": F.when(F.col("n_senal") > 0, mean), "desviacion": deviation,
                            **{f"unicos_{c}": F.coalesce(F.col(f"unicos_{c}"), F.lit(0)).cast("long") for c in ids}})


def aggregate(states: DataFrame, name: str, w) -> DataFrame:
    """An aggregate of the warehouse ``w`` from partial states, in the columns of
    its direct form (``Warehouse.daily_operator_stats`` and the like)."""
    f = finished(states, name)
    if name == "mv_stats_diarias_operador":
        f = w.join(f, "dim_tiempo", "tiempo_id", "inner", ["tiempo_id", "fecha", "anio", "mes", "nombre_dia"])
        f = w.join(f, "dim_operador", "operador_id", "inner", ["operador_id", "operador_nombre"])
        return f.select("fecha", "anio", "mes", "nombre_dia", "operador_nombre", F.col("n").alias("total_mediciones"),
                        F.col("media").alias("senal_promedio"), F.col("minimo").cast("double").alias("senal_minima"),
                        F.col("maximo").cast("double").alias("senal_maxima"),
                        *[F.col(f"clase_{cid}").alias(f"mediciones_{label.lower()}") for _, label, cid in _CLASSES],
                        F.col("unicos_dispositivo_id").alias("dispositivos_unicos"))
    if name == "mv_stats_zonas":
        f = w.join(f, "dim_zonas", "zona_id", "inner", ["zona_id", "zona_nombre", "grid_lat", "grid_lon", "centro_lat", "centro_lon"])
        return f.select("zona_id", "zona_nombre", "grid_lat", "grid_lon", "centro_lat", "centro_lon", F.col("n").alias("total_mediciones"),
                        F.col("media").alias("senal_promedio"), F.col("desviacion").alias("senal_desviacion"),
                        F.col("unicos_operador_id").alias("operadores_presentes"),
                        F.col("unicos_dispositivo_id").alias("dispositivos_unicos"), F.col("ultima").alias("ultima_medicion"))
    if name == "mv_top_dispositivos":
        f = w.join(f, "dim_dispositivo", "dispositivo_id", "inner", ["dispositivo_id", "device_id", "device_name"])
        return f.select("dispositivo_id", "device_id", "device_name", F.col("n").alias("total_mediciones"),
                        F.col("media").alias("senal_promedio"), F.col("unicos_zona_id").alias("zonas_visitadas"),
                        F.col("primera").alias("primera_medicion"), F.col("ultima").alias("ultima_medicion"))
    return f.select(F.col("n").alias("total_mediciones"), F.col("unicos_dispositivo_id").alias("dispositivos"),
                    F.col("unicos_zona_id").alias("zonas"), F.col("primera").alias("fecha_inicio"), F.col("ultima").alias("fecha_fin"),
                    F.col("media").alias("senal_promedio"))
