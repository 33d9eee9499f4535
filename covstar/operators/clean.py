"""Validation and the normalising transform of the load."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .. import functions as X

_FLOAT_TYPES = (T.DoubleType, T.FloatType)


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN is not a missing value to Spark (NaN >= -70 is true), so every
    floating column gets NaN -> NULL before any rule sees it."""
    fixes = {f.name: F.when(F.isnan(f.name), F.lit(None).cast(f.dataType)).otherwise(F.col(f.name))
             for f in df.schema.fields if isinstance(f.dataType, _FLOAT_TYPES)}
    return df.withColumns(fixes) if fixes else df


def valid_points(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """keep rows with both coordinates."""
    return df.dropna(subset=[lat, lon])


def drop_null_members(df: DataFrame, c: str) -> DataFrame:
    """dimension members must not be NULL."""
    return df.filter(F.col(c).isNotNull())


def normalize(raw: DataFrame, grid_size: float = C.GRID_SIZE_ETL, grid_mode: str = "trunc") -> DataFrame:
    """The load transform: parse, validate, normalise, classify, grid, keys.

    One narrow projection after the scan (no shuffle): timestamp parsed with
    ``try_to_timestamp`` (bad text -> NULL -> row dropped by F1), NaN -> NULL,
    operator / network normalised, quality class, grid cell, altitude band,
    km/h, sector, date / hour / yyyymmdd keys and the natural device key.
    """
    df = nan_to_null(raw.withColumn("timestamp", X.parse_ts(raw, "timestamp")))
    # F1 after NaN -> NULL: a NULL test is enough
    df = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
                   & F.col("timestamp").isNotNull())
    df = df.withColumns({
        "operador_normalizado": X.normalize_operator("sim_operator"),
        "red_normalizada": X.normalize_network("network_type"),
        "calidad_senal": X.signal_class("signal"),
        "grid_lat": X.grid_cell("latitude", grid_size, grid_mode),
        "grid_lon": X.grid_cell("longitude", grid_size, grid_mode),
        "zona_altitud": X.altitude_band("altitude"),
        "speed_kmh": X.kmh("speed"),
        "sector_id": X.sector_id("latitude", "longitude"),
        "device_id": X.device_key("device_id", "device_name"),
    })
    return X.with_time_keys(df, "timestamp")


NORMALIZED_SQL = """
parsed AS (
  SELECT * FROM raw
  WHERE latitude IS NOT NULL AND NOT isnan(latitude)
    AND longitude IS NOT NULL AND NOT isnan(longitude)
    AND "timestamp" IS NOT NULL
),
norm AS (
  SELECT
    id, "timestamp", latitude, longitude, altitude, speed, signal, battery, sim_operator, network_type,
    CASE WHEN device_id IS NULL OR device_id = '' THEN 'UNKNOWN_' || device_name ELSE device_id END AS device_id,
    device_name,
    CASE
      WHEN contains(upper(sim_operator), 'ENTEL') THEN 'ENTEL'
      WHEN contains(upper(sim_operator), 'DISTANCIA') THEN 'ENTEL'
      WHEN contains(upper(sim_operator), 'MOVIL') THEN 'ENTEL'
      WHEN contains(upper(sim_operator), 'BOMOV') THEN 'ENTEL'
      WHEN contains(upper(sim_operator), 'VACUNATE') THEN 'ENTEL'
      WHEN contains(upper(sim_operator), 'TIGO') THEN 'TIGO'
      WHEN contains(upper(sim_operator), 'VIVA') THEN 'VIVA'
      WHEN contains(upper(sim_operator), 'T-MOBILE') THEN 'T-MOBILE'
      WHEN sim_operator IN ('Sin señal', 'None', 'Unknown', '') THEN 'SIN_SEÑAL'
      WHEN sim_operator IS NULL THEN 'SIN_SEÑAL'
      ELSE upper(sim_operator) END AS operador_normalizado,
    CASE
      WHEN upper(network_type) = 'WIFI' THEN 'WIFI'
      WHEN upper(network_type) = '4G' THEN '4G'
      WHEN upper(network_type) = '3G' THEN '3G'
      WHEN upper(network_type) = '2G' THEN '2G'
      WHEN upper(network_type) = 'MOBILE' THEN 'MOBILE'
      WHEN contains(upper(network_type), 'LTE') THEN '4G'
      WHEN network_type IN ('None', '') THEN 'SIN_RED'
      WHEN network_type IS NULL THEN 'SIN_RED'
      ELSE upper(network_type) END AS red_normalizada,
    CASE WHEN signal >= -70 THEN 'EXCELENTE' WHEN signal >= -85 THEN 'BUENA'
         WHEN signal >= -95 THEN 'REGULAR' WHEN signal >= -105 THEN 'MALA' ELSE 'CRITICA' END AS calidad_senal,
    CAST(trunc(latitude / 0.02::DOUBLE) AS INTEGER) AS grid_lat,
    CAST(trunc(longitude / 0.02::DOUBLE) AS INTEGER) AS grid_lon,
    CASE WHEN altitude < 2500 THEN 'BAJA' WHEN altitude < 3000 THEN 'MEDIA' ELSE 'ALTA' END AS zona_altitud,
    speed * 3.6::DOUBLE AS speed_kmh,
    CAST(CAST(trunc(latitude * 10000) AS INTEGER) AS VARCHAR) || '_' || CAST(CAST(trunc(longitude * 10000) AS INTEGER) AS VARCHAR) AS sector_id,
    CAST("timestamp" AS DATE) AS fecha,
    CAST(hour("timestamp") AS INTEGER) AS hora,
    CAST(year("timestamp") * 10000 + month("timestamp") * 100 + day("timestamp") AS INTEGER) AS tiempo_id
  FROM parsed
)"""
