"""Dashboard analytics over the analytic frame.

Every function takes the (lazy) analytic frame and returns a lazy DataFrame;
slicers compose into the same plan, so Catalyst pushes them below the joins
and into the fact scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from .. import functions as X
from .dimensions import exact_avg

ALL = (None, "Todos", "Todas")   # "no filter" sentinels of the slicers


def slice(df: DataFrame, date_from=None, date_to=None, hour_from=None, hour_to=None,
          operador=None, red=None, calidad=None, franja=None) -> DataFrame:
    """Inclusive date range; inclusive hour range applied only when
    *both* bounds are given (``HH:00`` labels accepted, no midnight wrap: a
    reversed range is empty); equality slicers where not "all"."""
    out = df
    if date_from not in ALL:
        out = out.filter(F.col("fecha") >= F.lit(str(date_from)[:10]).cast("date"))
    if date_to not in ALL:
        out = out.filter(F.col("fecha") <= F.lit(str(date_to)[:10]).cast("date"))
    if hour_from not in ALL and hour_to not in ALL:
        h0 = int(str(hour_from).split(":")[0])
        h1 = int(str(hour_to).split(":")[0])
        out = out.filter(F.col("hora").between(h0, h1))
    for c, v in (("operador_normalizado", operador), ("red_normalizada", red),
                 ("calidad_senal", calidad), ("franja_horaria", franja)):
        if v not in ALL:
            out = out.filter(F.col(c) == v)
    return out


def device_rows(df: DataFrame, name: str) -> DataFrame:
    """rows of one device model (on the *unsliced* frame)."""
    return df.filter(F.col("device_name") == name)


def header_counts(df: DataFrame, dim_operador: DataFrame) -> DataFrame:
    """Rows, distinct devices, distinct models, operators in the dimension."""
    a = df.agg(F.count(F.lit(1)).alias("mediciones"),
               F.count_distinct("dispositivo_id").alias("dispositivos"),
               F.count_distinct("device_name").alias("modelos"),
               F.lit(None).cast("long").alias("operadores"))
    b = dim_operador.agg(F.lit(None).cast("long").alias("mediciones"),
                         F.lit(None).cast("long").alias("dispositivos"),
                         F.lit(None).cast("long").alias("modelos"),
                         F.count(F.lit(1)).alias("operadores"))
    return a.unionByName(b).agg(*[F.max(c).alias(c) for c in
                                  ("mediciones", "dispositivos", "modelos", "operadores")])


def kpis(df: DataFrame) -> DataFrame:
    """A10: mean signal, mean altitude, zones covered, filtered rows."""
    return df.agg(exact_avg("medida_senal", 2).alias("senal_promedio"),
                  exact_avg("medida_altitud", 2).alias("altitud_promedio"),
                  F.count_distinct("zona_id").alias("zonas_cubiertas"),
                  F.count(F.lit(1)).alias("registros_filtrados"))


def value_counts(df: DataFrame, c: str, ordered: bool = True) -> DataFrame:
    """Frequency table of a column, NULL excluded, most frequent first."""
    out = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("mediciones"))
    return out.orderBy(F.col("mediciones").desc(), F.col(c)) if ordered else out


def operator_share(df: DataFrame) -> DataFrame:
    """Operator counts and their share of the total (pie chart). The
    window runs over the operator aggregate (one row per operator), never
    over measurements."""
    counts = value_counts(df, "operador_normalizado", ordered=False)
    total = F.sum("mediciones").over(Window.partitionBy())
    # the window sees one row per operator (bounded by the operator
    # dimension); a scalar-subquery total would aggregate the input twice
    return counts.withColumn("porcentaje", F.round(F.col("mediciones") * 100.0 / total, 4))


def signal_by_operator(df: DataFrame) -> DataFrame:
    """Mean signal per operator (NULL signals skipped), the best first."""
    out = df.groupBy("operador_normalizado").agg(exact_avg("medida_senal", 2).alias("senal_promedio"))
    return out.orderBy(F.col("senal_promedio").desc_nulls_last(), "operador_normalizado")


def zone_layer(df: DataFrame, zonas: DataFrame, zonas_rows: int | None = None) -> DataFrame:
    """Per zone of the sliced points: mean and sample stddev of
    signal, count of *non-null* signals, mean altitude, distinct devices;
    joined to the zone geometry and coloured by mean signal."""
    from .joins import dim_join
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    agg = pts.groupBy("zona_id").agg(
        exact_avg("medida_senal", 2).alias("senal_promedio"),
        F.round(F.stddev_samp("medida_senal"), 2).alias("senal_desviacion"),
        F.count("medida_senal").alias("total_mediciones"),
        exact_avg("medida_altitud", 2).alias("altitud_promedio"),
        F.count_distinct("dispositivo_id").alias("dispositivos_unicos"),
    )
    geo = zonas.select("zona_id", "zona_nombre", "grid_latitud_inicio", "grid_latitud_fin",
                       "grid_longitud_inicio", "grid_longitud_fin")
    out = dim_join(agg, geo, "zona_id", "inner", zonas_rows)
    return out.withColumn("color", X.mean_signal_color("senal_promedio"))


def daily_evolution(df: DataFrame) -> DataFrame:
    """Mean signal and row count per day."""
    return df.groupBy("fecha").agg(exact_avg("medida_senal", 2).alias("senal_promedio"),
                                   F.count("medicion_id").alias("cantidad"))


def day_part_matrix(df: DataFrame) -> DataFrame:
    """Weekday x day-part counts, pivoted (absent pair -> NULL). The
    pivot values are the fixed day-part labels, so no extra job computes them."""
    return (df.groupBy("nombre_dia").pivot("franja_horaria", C.DAY_PART_ORDER)
              .agg(F.count(F.lit(1))))


def device_kpis(df: DataFrame) -> DataFrame:
    """Per device model: rows, mean signal, zones visited (all models at
    once; the dashboard card is one row of it)."""
    return df.groupBy("device_name").agg(F.count(F.lit(1)).alias("total_mediciones"),
                                         exact_avg("medida_senal", 2).alias("senal_promedio"),
                                         F.count_distinct("zona_id").alias("zonas_visitadas"))


def centroid(df: DataFrame, by: str | None = None) -> DataFrame:
    """Map centre (mean latitude / longitude), overall or per ``by``."""
    pts = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    aggs = [exact_avg("latitude", 6).alias("centro_lat"), exact_avg("longitude", 6).alias("centro_lon")]
    return pts.groupBy(by).agg(*aggs) if by else pts.agg(*aggs)


def filter_domains(df: DataFrame) -> DataFrame:
    """Slicer domains in long form ``(dominio, valor)``: date min/max and
    the distinct hours, operators, networks, classes, day parts and devices.
    One scan: the distinct combinations of the slicer columns are folded first
    (partial per task), then emit their (domain, value) pairs; a second small
    aggregate keeps the distinct pairs and, for the dates, the bounds. Long form
    keeps every domain distributed; sort with ``orderBy("dominio", "valor")``."""
    columns = ["operador_normalizado", "red_normalizada", "calidad_senal", "franja_horaria", "device_name"]
    tuples = df.select("fecha", "hora", *columns).distinct()
    pairs = [F.struct(F.lit(c).alias("dominio"), F.col(c).cast("string").alias("valor")) for c in ("fecha", *columns)]
    pairs.append(F.struct(F.lit("hora").alias("dominio"), X.hour_label("hora").alias("valor")))
    kv = tuples.select(F.inline(F.array(*pairs))).filter(F.col("valor").isNotNull())
    is_date = F.col("dominio") == "fecha"
    folded = (kv.groupBy("dominio", F.when(~is_date, F.col("valor")).alias("v"))
              .agg(F.min("valor").alias("low"), F.max("valor").alias("high")))
    ends = F.array(F.struct(F.lit("fecha_min").alias("dominio"), F.col("low").alias("valor")),
                   F.struct(F.lit("fecha_max").alias("dominio"), F.col("high").alias("valor")))
    return folded.select(F.inline(F.when(is_date, ends).otherwise(
        F.array(F.struct(F.col("dominio"), F.col("v").alias("valor"))))))
