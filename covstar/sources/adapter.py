"""Adapter: the shipped ``events`` table -> raw measurement schema.

``events(event_id, ts, user_id, event_type, value, props '{"k": n}')`` has no
coordinates, so every raw column is derived deterministically from the event
columns with integer arithmetic (then divided by a double), so that Spark and
any SQL engine compute the same values. The mapping is a narrow projection:
no shuffle, it streams with the scan. It brings what a real feed brings: all
spellings of operators and networks, rows of every month and of the fixed
partition weeks, repeated keys with other values, devices without a name, two
dense places, and devices whose battery no column holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .raw import RAW_COLUMNS

# FIXED VALUES of the adapter: raw operator by event_id % 14, network by
# (event_id div 9) % 9; None = NULL.
ADAPTER_OPERATORS = ["Entel", "LaDistanciaNosCuida", "Movil GSM", "TIGO", "Viva",
                     "Unknown", "", None, "otherco", "Bomov 4G", "Vacunate Ya", "T-Mobile US", "Sin señal", "None"]
ADAPTER_NETWORKS = ["4G", "LTE-A", "3G", "2G", "WiFi", "Mobile", "None", None, "5G"]


def _pick(index: Column, values: list) -> Column:
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v).cast("string")
        expr = F.when(index == i, lit) if expr is None else expr.when(index == i, lit)
    return expr


def events_to_raw(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    u = F.col("user_id")
    # parse the JSON once, in its own projection: the optimizer keeps a
    # non-trivial expression used many times below from being inlined
    events = events.select("event_id", "ts", "user_id",
                           F.get_json_object(F.col("props"), "$.k").try_cast("int").alias("_k"))
    k = F.col("_k")
    no_coords = (e % 89) == 0
    lat = ((F.lit(-17800) + (k * 7 - u) % 400) / F.lit(1000.0))
    lon = ((F.lit(-63100) + (k * 3 + u) % 300) / F.lit(1000.0))
    def days(n: Column) -> Column:
        return F.make_dt_interval(n.cast("int"))
    # every month of a year; the weeks of the fixed partitions and after
    ts = (F.when((e % 37) == 0, F.col("ts") + days(F.expr("event_id div 37") % 12 * 30))
           .when((e % 41) == 0, F.col("ts") + days(F.lit(683) + F.expr("event_id div 41") % 24))
           .otherwise(F.col("ts")))
    lat = F.when((e % 4) == 0, F.lit(-17.805)).when((e % 13) == 0, F.lit(-17.605)).otherwise(lat)
    lon = F.when((e % 4) == 0, F.lit(-63.155)).when((e % 13) == 0, F.lit(-63.015)).otherwise(lon)
    rows = events.select(
        e.cast("string").alias("id"),
        ts.alias("timestamp"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(lat).alias("latitude"),
        F.when(no_coords, F.lit(None).cast("double")).otherwise(lon).alias("longitude"),
        F.when((e % 83) == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(300) + (e * 37) % 3200).cast("double")).alias("altitude"),
        (k % 30).cast("double").alias("speed"),
        F.when((e % 97) == 0, F.lit(None).cast("double"))
         .otherwise((F.lit(-50) - k % 70).cast("double")).alias("signal"),
        F.when((u % 23) == 0, F.lit(5000.0)).otherwise((k % 101).cast("double")).alias("battery"),
        _pick(e % 14, ADAPTER_OPERATORS).alias("sim_operator"),
        _pick(F.expr("event_id div 9") % 9, ADAPTER_NETWORKS).alias("network_type"),
        F.when((u % 11) == 0, F.lit(None).cast("string"))
         .when((u % 13) == 0, F.lit(""))
         .otherwise(F.concat(F.lit("dev-"), u.cast("string"))).alias("device_id"),
        F.when((u % 19) != 0, F.concat(F.lit("MODEL "), (u % 17).cast("string"))).alias("device_name"),
        F.explode(F.when((e % 53) == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
    # a repeated key comes with a weaker signal
    return rows.withColumn("signal", F.col("signal") - 5 * F.col("_copy")).select(*RAW_COLUMNS)


def raw_from_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw measurements derived from ``<sf_dir>/events.parquet``."""
    return events_to_raw(spark.read.parquet(f"{sf_dir}/events.parquet"))


# The same mapping as DuckDB SQL, for the oracle.
RAW_SQL = """
raw AS (
  SELECT
    CAST(event_id AS VARCHAR) AS id,
    CASE WHEN event_id % 37 = 0 THEN ts + to_days(CAST(((event_id // 37) % 12) * 30 AS INTEGER))
         WHEN event_id % 41 = 0 THEN ts + to_days(CAST(683 + (event_id // 41) % 24 AS INTEGER)) ELSE ts END AS "timestamp",
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 4 = 0 THEN -17.805::DOUBLE WHEN event_id % 13 = 0 THEN -17.605::DOUBLE
         ELSE (-17800 + (CAST(json_extract_string(props, '$.k') AS INTEGER) * 7 - user_id) % 400) / 1000.0::DOUBLE END AS latitude,
    CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 4 = 0 THEN -63.155::DOUBLE WHEN event_id % 13 = 0 THEN -63.015::DOUBLE
         ELSE (-63100 + (CAST(json_extract_string(props, '$.k') AS INTEGER) * 3 + user_id) % 300) / 1000.0::DOUBLE END AS longitude,
    CASE WHEN event_id % 83 = 0 THEN NULL ELSE CAST(300 + (event_id * 37) % 3200 AS DOUBLE) END AS altitude,
    CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 30 AS DOUBLE) AS speed,
    CASE WHEN event_id % 97 = 0 THEN NULL
         ELSE CAST(-50 - CAST(json_extract_string(props, '$.k') AS INTEGER) % 70 AS DOUBLE) END - 5 * copy AS signal,
    CASE WHEN user_id % 23 = 0 THEN 5000.0::DOUBLE
         ELSE CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) % 101 AS DOUBLE) END AS battery,
    CASE event_id % 14 WHEN 0 THEN 'Entel' WHEN 1 THEN 'LaDistanciaNosCuida' WHEN 2 THEN 'Movil GSM'
         WHEN 3 THEN 'TIGO' WHEN 4 THEN 'Viva' WHEN 5 THEN 'Unknown' WHEN 6 THEN ''
         WHEN 7 THEN NULL WHEN 9 THEN 'Bomov 4G' WHEN 10 THEN 'Vacunate Ya' WHEN 11 THEN 'T-Mobile US'
         WHEN 12 THEN 'Sin señal' WHEN 13 THEN 'None' ELSE 'otherco' END AS sim_operator,
    CASE (event_id // 9) % 9 WHEN 0 THEN '4G' WHEN 1 THEN 'LTE-A' WHEN 2 THEN '3G' WHEN 3 THEN '2G'
         WHEN 4 THEN 'WiFi' WHEN 5 THEN 'Mobile' WHEN 6 THEN 'None' WHEN 7 THEN NULL ELSE '5G' END AS network_type,
    CASE WHEN user_id % 11 = 0 THEN NULL WHEN user_id % 13 = 0 THEN ''
         ELSE 'dev-' || CAST(user_id AS VARCHAR) END AS device_id,
    CASE WHEN user_id % 19 <> 0 THEN 'MODEL ' || CAST(user_id % 17 AS VARCHAR) END AS device_name
  FROM events CROSS JOIN (VALUES (0), (1)) c(copy)
  WHERE copy = 0 OR event_id % 53 = 0
)"""
