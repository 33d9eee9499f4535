"""Early facts (J7, P26): facts whose member is not known yet.

A fact that arrives before its dimension member carries the key 0. Member 0
("unknown") keeps such facts in inner joins, and the repair gives them their
member once it is there: the natural key comes from the feed by the fact's own
key (source_id, timestamp), for the zone from the fact's coordinates.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .dimensions import first_per_key
from .joins import resolve_key
from .warehouse import Warehouse, with_reason

UNKNOWN = "DESCONOCIDO"
#: dimension -> (id, default id, columns that carry the unknown name)
MEMBERS = {
    "dim_operador": ("operador_id", C.DEFAULT_OPERATOR_ID, ["operador_nombre"]),
    "dim_red": ("red_id", C.DEFAULT_NETWORK_ID, ["red_tipo"]),
    "dim_dispositivo": ("dispositivo_id", C.DEFAULT_DEVICE_ID, ["device_id", "device_name"]),
    "dim_zonas": ("zona_id", C.DEFAULT_ZONE_ID, ["zona_nombre"]),
}


def with_unknown_member(dim: DataFrame, name: str) -> DataFrame:
    """The dimension with its member 0; every other attribute of it is NULL."""
    id_col, default, named = MEMBERS[name]
    cells = [F.lit(default if f.name == id_col else UNKNOWN if f.name in named else None).cast(f.dataType).alias(f.name)
             for f in dim.schema.fields]
    one = dim.sparkSession.range(1).select(*cells)
    return dim.filter(F.col(id_col) != default).unionByName(one)


def with_unknown_members(w: Warehouse) -> Warehouse:
    """The warehouse with member 0 in four dimensions: facts with a key 0 stay in the analytic frame."""
    dims = w.dims | {n: with_unknown_member(w.dims[n], n) for n in MEMBERS}
    return replace(w, dims=dims, sizes={n: (s + 1 if n in MEMBERS and s is not None else s) for n, s in w.sizes.items()})


def is_early() -> Column:
    """A fact with a key 0."""
    some = F.lit(False)
    for id_col, default, _ in MEMBERS.values():
        some = some | (F.col(id_col) == default)
    return some


def repaired(fact: DataFrame, norm: DataFrame, dims: dict, sizes: dict) -> DataFrame:
    """``fact`` with its 0 keys resolved anew where the member has come. ``norm``
    is the normalised feed (or the part of it that covers the early facts); a
    key other than 0 is never changed. Only the early facts are joined; the
    others pass with their partitioning."""
    early, done = fact.filter(is_early()), fact.filter(~is_early())
    good = with_reason(norm).filter(F.col("motivo").isNull())
    good = first_per_key(good, ["source_id", "timestamp"], ["device_id", "signal"])
    feed = good.select(F.col("source_id").alias("_s"), F.col("timestamp").cast("timestamp_ntz").alias("_t"),
                       F.col("device_id").alias("_device"), F.col("operador_normalizado").alias("_operator"),
                       F.col("red_normalizada").alias("_network"), F.col("grid_lat").alias("_lat"), F.col("grid_lon").alias("_lon"))
    met = early.join(feed, F.col("source_id").eqNullSafe(F.col("_s")) & (F.col("timestamp") == F.col("_t")), "left")
    looks = [("dim_dispositivo", {"device_id": "_device"}), ("dim_operador", {"operador_nombre": "_operator"}),
             ("dim_red", {"red_tipo": "_network"}), ("dim_zonas", {"grid_lat": "_lat", "grid_lon": "_lon"})]
    for name, natural in looks:
        id_col, default, _ = MEMBERS[name]
        look = dims[name].filter(F.col(id_col) != default).select(id_col, *[F.col(c).alias(n) for c, n in natural.items()])
        met = resolve_key(met.withColumnRenamed(id_col, "_old"), look, list(natural.values()), id_col, default, sizes.get(name))
        met = met.withColumn(id_col, F.when(F.col("_old") != default, F.col("_old")).otherwise(F.col(id_col))).drop("_old")
    return done.unionByName(met.select(*fact.columns))
