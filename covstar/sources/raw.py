"""Raw measurement sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from .pages import FORMAT, register_pages

# Declared once: no schema inference on the raw feed.
RAW_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("latitude", T.DoubleType()),
    T.StructField("longitude", T.DoubleType()),
    T.StructField("altitude", T.DoubleType()),
    T.StructField("speed", T.DoubleType()),
    T.StructField("signal", T.DoubleType()),
    T.StructField("battery", T.DoubleType()),
    T.StructField("sim_operator", T.StringType()),
    T.StructField("network_type", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("device_name", T.StringType()),
])

# text feeds carry the timestamp as ISO text; it is parsed by the cleaner
RAW_TEXT_SCHEMA = T.StructType([
    T.StructField(f.name, T.StringType() if f.name == "timestamp" else f.dataType)
    for f in RAW_SCHEMA.fields
])

RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]


def read_measurements(spark: SparkSession, path: str, fmt: str = "parquet",
                      options: dict | None = None) -> DataFrame:
    """Full scan of the raw feed. Parquet keeps its own types; json / csv
    use the declared text schema (no inference). ``fmt="measurement_pages"`` reads
    exported pages (see ``pages``) and skips those of other days. ``fmt="jdbc"`` takes the
    connection in ``options`` (url, dbtable, partitionColumn, bounds...) so the
    read is split across executors instead of paged through one client."""
    opts = dict(options or {})
    if fmt == "parquet":
        return spark.read.options(**opts).parquet(path).select(*RAW_COLUMNS)
    if fmt == "json":
        return spark.read.options(**opts).schema(RAW_TEXT_SCHEMA).json(path)
    if fmt == "csv":
        opts.setdefault("header", "true")
        return spark.read.options(**opts).schema(RAW_TEXT_SCHEMA).csv(path)
    if fmt == FORMAT:
        register_pages(spark)
        return spark.read.format(FORMAT).options(**opts).schema(RAW_TEXT_SCHEMA).load(path)
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**opts).load().select(*RAW_COLUMNS)
    return spark.read.format(fmt).options(**opts).load(path).select(*RAW_COLUMNS)


def stream_pages(spark: SparkSession, path: str) -> DataFrame:
    """The exported pages as a stream: a micro-batch takes the whole batches that are new."""
    register_pages(spark)
    return spark.readStream.format(FORMAT).schema(RAW_TEXT_SCHEMA).load(path)


def since(df: DataFrame, watermark, ts: str = "timestamp") -> DataFrame:
    """Incremental scan, strictly newer than the watermark. ``None`` or the
    epoch means no watermark. The filter is a plain comparison so it reaches
    the parquet reader as a pushed filter."""
    if watermark is None or str(watermark).startswith("1970-01-01"):
        return df
    from ..functions.timekeys import ts_literal
    return df.filter(F.col(ts) > ts_literal(watermark, df.schema[ts].dataType))


def high_watermark(fact: DataFrame, ts: str = "timestamp") -> DataFrame:
    """S3: one-row frame ``watermark`` = max timestamp, or the epoch."""
    dtype = fact.schema[ts].dataType
    return fact.agg(F.coalesce(F.max(ts), F.lit(C.EPOCH).cast(dtype)).alias("watermark"))


#: Steps of the radix selection: a step counts at most about a thousand places
#: (months of a feed; hours of a month; seconds of an hour; milliseconds; microseconds).
_STEPS = (("month", 7), ("hour", 13), ("second", 19), ("millisecond", 23), (None, None))


def extract(df: DataFrame, limit: int | None = None, ts: str = "timestamp") -> DataFrame:
    """Bounded extract, the rows up to the timestamp of the ``limit``-th
    oldest one. All rows of that last timestamp belong to it: the next load
    starts strictly after it. Rows without a timestamp never load and are left
    out. The cut is found by radix selection: each step counts the rows by a
    finer part of the time within the place of the step before (partial counts
    in each task, a bounded list to the driver). No window, no sort, and the
    extract itself is a filter, so no task holds ``limit`` rows."""
    if limit is None:
        return df
    kind = df.schema[ts].dataType
    dated = df.filter(F.col(ts).isNotNull())
    near, need, at = dated, int(limit), None
    for unit, length in _STEPS:
        if unit is None:
            place = F.col(ts)
        elif isinstance(kind, T.StringType):
            place = F.substring(ts, 1, length)                   # ISO text
        else:
            place = F.date_trunc(unit, ts).cast(kind)
        counts = near.groupBy(place.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(counts, key=lambda r: r["at"]):
            if r["n"] >= need:
                at = r["at"]
                break
            need -= r["n"]
        else:
            return dated                                         # fewer rows than the limit
        near = near.filter((F.col(ts) >= F.lit(at)) & (place == F.lit(at)))
    return dated.filter(F.col(ts) <= F.lit(at))


def device_columns(df: DataFrame) -> DataFrame:
    """Column-pruned scan of the device columns."""
    return df.select("device_id", "device_name")
