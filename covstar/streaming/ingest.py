"""Structured Streaming forms of the load (R1) and of the daily operator
statistics (R2).

R1 (exact, default): a file-source stream of raw rows; every micro-batch is
loaded by the batch load job (``foreachBatch``), whose key anti join makes
duplicates and replays harmless, whichever stream they come from. The optional bounded-state form drops duplicates inside an event-time
watermark first.

R2 (exact): a chain of three stateful aggregates in append mode. Rows the fact
cannot take go first; one row per key (source_id, timestamp) stays, the smallest,
as in the batch load; day x operator x device states count and sum; day x
operator sums them, where each device is one row, so the distinct count is exact.
A day is emitted once the watermark has passed it; rows later than ``delay`` are
dropped. The other exact form recomputes the touched days from the stored fact
after each micro-batch (``foreachBatch``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.clean import normalize
from ..operators.warehouse import MEASURE_TYPES, with_reason
from ..plans import etl, store
from ..sources.raw import RAW_SCHEMA


def raw_stream(spark: SparkSession, src: str, fmt: str = "parquet", max_files_per_trigger: int | None = None,
               schema=RAW_SCHEMA) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(src)


DAILY = "mv_stats_diarias_operador"


def _load_micro_batch(root: str, now=None, refresh_daily: bool = False):
    def fn(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        etl.load_batch(spark, batch, root, now=now, mode="stream", batch_id=batch_id)
        if refresh_daily:         # also on a replay whose load was already recorded
            days = [r[0] for r in normalize(batch).select("tiempo_id").distinct().collect()]  # bounded: days
            refresh_daily_days(spark, root, days)
    return fn


def refresh_daily_days(spark: SparkSession, root: str, days: list[int]) -> None:
    """R2 exact form: recompute the daily operator statistics of ``days``
    from the stored fact and splice them into a new snapshot of the
    aggregate (other days are kept as they are)."""
    fresh = refresh_touched_days(spark, root, days)
    old = store.read_table(spark, root, DAILY)
    if old is not None:
        keep = old.filter(~F.date_format("fecha", "yyyyMMdd").cast("int").isin(days))
        fresh = keep.unionByName(fresh.select(*old.columns))
    version = store.new_version()
    store.write_version(fresh, root, DAILY, version)
    store.record_versions(spark, root, {DAILY: version})


def stream_ingest(spark: SparkSession, src: str, root: str, checkpoint: str, fmt: str = "parquet",
                  dedupe_delay: str | None = None, now=None, available_now: bool = True,
                  max_files_per_trigger: int | None = None, refresh_daily: bool = False):
    """Stream the raw files under ``src`` into the warehouse at ``root``.
    Returns the started query (``availableNow`` stops when the backlog is
    loaded). ``refresh_daily`` keeps the daily operator aggregate exact and
    fresh: each micro-batch recomputes the days it touched (R2)."""
    s = raw_stream(spark, src, fmt, max_files_per_trigger)
    if dedupe_delay:
        # bounded-state option: event time must be a TIMESTAMP for watermarks
        s = (s.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
              .withWatermark("timestamp", dedupe_delay)
              .dropDuplicatesWithinWatermark(["id", "timestamp"])
              .withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")))
    w = (s.writeStream.foreachBatch(_load_micro_batch(root, now, refresh_daily))
          .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def daily_operator_stream(stream: DataFrame, delay: str = "1 day") -> DataFrame:
    """R2: the daily operator statistics of a raw stream, equal to the batch
    aggregate on every day that the watermark has passed. Append mode (three
    chained stateful operators). Event time is cast to TIMESTAMP (watermarks
    reject NTZ)."""
    n = with_reason(normalize(stream)).filter(F.col("motivo").isNull())
    n = n.withColumn("event_time", F.col("timestamp").cast("timestamp")).withWatermark("event_time", delay)
    # 1: one row per key, the smallest; the order of the fields is that of the batch dedupe
    first = n.groupBy("event_time", "source_id").agg(F.min(F.struct(
        "device_id", "signal", "operador_normalizado", "calidad_senal")).alias("f"))
    kept = first.select("event_time", F.col("f.device_id").alias("device_id"), F.col("f.operador_normalizado").alias("operador_nombre"),
                        F.col("f.signal").cast(MEASURE_TYPES["medida_senal"]).alias("senal"), F.col("f.calidad_senal").alias("calidad"))
    labels = [label for _, label, _ in C.SIGNAL_CLASSES + [(None, *C.SIGNAL_CLASS_LAST)]]
    # 2: a hot operator is spread over its devices
    device = kept.groupBy(F.window("event_time", "1 day").alias("dia"), "operador_nombre", "device_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("senal").alias("n_senal"), F.sum("senal").alias("suma"),
        F.min("senal").alias("minima"), F.max("senal").alias("maxima"),
        *[F.count_if(F.col("calidad") == label).alias(f"c_{label}") for label in labels])
    # 3: a device is one row here
    mean = F.round(F.sum("suma").cast("decimal(24,2)") / F.sum("n_senal").cast("decimal(14,0)"), 2).cast("double")
    daily = device.groupBy(F.window(F.window_time("dia"), "1 day").alias("dia"), "operador_nombre").agg(
        F.sum("n").alias("total_mediciones"), F.when(F.sum("n_senal") > 0, mean).alias("senal_promedio"),
        F.min("minima").cast("double").alias("senal_minima"), F.max("maxima").cast("double").alias("senal_maxima"),
        *[F.sum(f"c_{label}").alias(f"mediciones_{label.lower()}") for label in labels],
        F.count("device_id").alias("dispositivos_unicos"))
    return daily.select(F.to_date(F.col("dia.start")).alias("fecha"), "operador_nombre", "total_mediciones",
                        "senal_promedio", "senal_minima", "senal_maxima", *[f"mediciones_{label.lower()}" for label in labels],
                        "dispositivos_unicos")


def stream_daily_operator(spark: SparkSession, src: str, sink: str, checkpoint: str, fmt: str = "parquet",
                          delay: str = "1 day", available_now: bool = True):
    """R2: the daily statistics appended (after the watermark passes a day) to
    a parquet sink."""
    q = (daily_operator_stream(raw_stream(spark, src, fmt), delay)
         .writeStream.outputMode("append").format("parquet")
         .option("path", sink).option("checkpointLocation", checkpoint))
    q = q.trigger(availableNow=True) if available_now else q.trigger(processingTime="1 minute")
    return q.start()


def refresh_touched_days(spark: SparkSession, root: str, days: list[int]) -> DataFrame:
    """R2 exact form: the daily operator statistics of the given ``tiempo_id``
    days, recomputed from the stored fact: the weeks of those days prune the
    fact partitions, the day keys skip row groups inside them."""
    import datetime as dt

    from ..operators.warehouse import Warehouse
    weeks = set()
    for d in days:
        day = dt.datetime.strptime(str(d), "%Y%m%d").date()
        weeks.add((day - dt.timedelta(days=day.weekday())).isoformat())
    w = Warehouse.load(spark, root)
    w.fact = w.fact.filter(F.col("semana").isin(sorted(weeks)) & F.col("tiempo_id").isin(days))
    return w.daily_operator_stats()
