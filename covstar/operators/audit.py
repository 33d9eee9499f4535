"""Data-quality audits and constraint checks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import dim_join


def device_pairs(df: DataFrame, ordered: bool = True) -> DataFrame:
    """D3: distinct (device_id, device_name) pairs with an id."""
    out = df.select("device_id", "device_name").filter(F.col("device_id").isNotNull()).distinct()
    return out.orderBy("device_id", F.col("device_name").asc_nulls_first()) if ordered else out


def multi_id_models(df: DataFrame, as_list: bool = False) -> DataFrame:
    """Models (non-NULL names) seen with more than one device id.

    Long form by default: one row per (model, id) with the model's id count -
    the count is an aggregate (partial per task) joined back to the distinct
    pairs, so a model with a huge number of ids never becomes one array in
    one task. ``as_list=True`` gives the compact one-row-per-model form
    (sorted id array) for bounded data."""
    pairs = device_pairs(df, ordered=False).filter(F.col("device_name").isNotNull())
    counts = pairs.groupBy("device_name").agg(F.count(F.lit(1)).alias("num_ids")).filter(F.col("num_ids") > 1)
    if as_list:
        lists = pairs.groupBy("device_name").agg(F.array_sort(F.collect_set("device_id")).alias("device_ids"))
        return lists.join(counts, "device_name")
    return pairs.join(counts, "device_name").select("device_name", "device_id", "num_ids")


def device_completeness(df: DataFrame) -> DataFrame:
    """Distinct names, distinct non-NULL ids, rows with an id, all rows."""
    return df.agg(F.count_distinct("device_name").alias("modelos_unicos"),
                  F.count_distinct("device_id").alias("device_ids_unicos"),
                  F.count("device_id").alias("registros_con_id"),
                  F.count(F.lit(1)).alias("registros"))


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows violating NOT NULL on any of ``cols``."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.filter(cond)


def check_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Key values occurring more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def check_fk(df: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None,
             dim_rows: int | None = None) -> DataFrame:
    """Rows whose (non-NULL) foreign key has no dimension member."""
    dk = dim.select(F.col(dim_key or key).alias(key)).distinct()
    return dim_join(df.filter(F.col(key).isNotNull()), dk, key, "left_anti", dim_rows)


# K11 over the whole warehouse: (table, rule) -> number of violations
FACT_NOT_NULL = ["timestamp", "tiempo_id", "hora_id", "dispositivo_id", "latitude", "longitude"]
FACT_FOREIGN_KEYS = [("tiempo_id", "dim_tiempo"), ("hora_id", "dim_hora"), ("dispositivo_id", "dim_dispositivo"),
                     ("operador_id", "dim_operador"), ("red_id", "dim_red"), ("calidad_id", "dim_calidad"),
                     ("zona_id", "dim_zonas")]
DIM_UNIQUE = [("dim_tiempo", ["tiempo_id"]), ("dim_tiempo", ["fecha"]), ("dim_hora", ["hora_id"]),
              ("dim_operador", ["operador_id"]), ("dim_operador", ["operador_nombre"]),
              ("dim_red", ["red_id"]), ("dim_red", ["red_tipo"]), ("dim_calidad", ["calidad_id"]),
              ("dim_dispositivo", ["dispositivo_id"]), ("dim_dispositivo", ["device_id"]),
              ("dim_zonas", ["zona_id"]), ("dim_zonas", ["grid_lat", "grid_lon"])]


def warehouse_checks(w) -> DataFrame:
    """K11 on every table of a warehouse, as one long-form frame
    ``(tabla, regla, violaciones)``: NOT NULL columns of the fact, unique
    fact key, every foreign key of the fact and the unique keys of each
    dimension. The NOT NULL and foreign-key rules share one pass over the
    fact: each dimension's distinct keys are left-joined (broadcast when
    their counted size allows) with a match flag, and one aggregate counts
    the NULLs and the unmatched keys. The fact-key rule is one grouped
    count; the dimension rules run on the small dimensions."""
    f = w.fact
    keys = [k for k, _ in FACT_FOREIGN_KEYS]
    g = f.select(*dict.fromkeys(FACT_NOT_NULL + keys))
    for key, dim in FACT_FOREIGN_KEYS:
        dk = w.dims[dim].select(F.col(key), F.lit(True).alias(f"_ok_{key}")).distinct()
        g = dim_join(g, dk, key, "left", w.sizes.get(dim))
    checks = [(f"not_null:{c}", F.count_if(F.col(c).isNull())) for c in FACT_NOT_NULL]
    checks += [(f"fk:{key}->{dim}", F.count_if(F.col(key).isNotNull() & F.col(f"_ok_{key}").isNull()))
               for key, dim in FACT_FOREIGN_KEYS]
    one_pass = g.agg(*[e.alias(f"_c{i}") for i, (_, e) in enumerate(checks)])
    fact_rules = one_pass.select(F.explode(F.array(*[
        F.struct(F.lit(name).alias("regla"), F.col(f"_c{i}").alias("violaciones"))
        for i, (name, _) in enumerate(checks)])).alias("r"))
    out = fact_rules.select(F.lit("fact_mediciones").alias("tabla"), "r.regla", "r.violaciones")

    def count_rule(table: str, name: str, violating: DataFrame) -> DataFrame:
        return (violating.agg(F.count(F.lit(1)).alias("violaciones"))
                .select(F.lit(table).alias("tabla"), F.lit(name).alias("regla"), "violaciones"))

    out = out.unionByName(count_rule("fact_mediciones", "unique:source_id,timestamp",
                                     check_unique(f, ["source_id", "timestamp"])))
    for dim, dkeys in DIM_UNIQUE:
        out = out.unionByName(count_rule(dim, "unique:" + ",".join(dkeys), check_unique(w.dims[dim], dkeys)))
    return out
