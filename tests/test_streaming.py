"""Streaming: the file-source ingest equals the batch load (R1), replays are
harmless, and the chained daily stream agrees with the batch aggregate (R2)."""

import tempfile

from pyspark.sql import functions as F

from covstar import Warehouse, raw_from_dir
from covstar.streaming.ingest import daily_operator_stream, raw_stream, stream_ingest

SF = "/root/testdata/sf0.001"
NOW = "2025-01-01 00:00:00"


def _write_feed(spark, src):
    """Three feed files, one per trigger: thirds of the raw rows, plus a copy
    of some rows of the first file inside the second (cross-file duplicates)
    and inside the third (within-file duplicates)."""
    raw = raw_from_dir(spark, SF)
    a = raw.filter(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp_ntz"))
    b = raw.filter((F.col("timestamp") >= F.lit("2024-01-10").cast("timestamp_ntz"))
                   & (F.col("timestamp") < F.lit("2024-01-20").cast("timestamp_ntz")))
    c = raw.filter(F.col("timestamp") >= F.lit("2024-01-20").cast("timestamp_ntz"))
    dup = a.filter(F.col("id").cast("long") % 7 == 0)
    for i, part in enumerate([a, b.unionByName(dup), c.unionByName(c.limit(20))]):
        part.coalesce(1).write.mode("overwrite").parquet(f"{src}/part{i}")
    return raw


def test_stream_ingest_equals_batch(spark):
    base = tempfile.mkdtemp(prefix="covstar-stream-")
    src, root, ck = f"{base}/feed", f"{base}/wh", f"{base}/ck"
    _write_feed(spark, src)
    q = stream_ingest(spark, f"{src}/*", root, ck, now=NOW, max_files_per_trigger=1)
    q.awaitTermination(600)
    assert q.exception() is None
    w = Warehouse.load(spark, root)
    ref = Warehouse.from_raw(raw_from_dir(spark, SF), now=NOW)
    got = sorted(tuple(r) for r in w.full_view(extra=("source_id",)).drop("medicion_id").collect())
    exp = sorted(tuple(r) for r in ref.full_view(extra=("source_id",)).drop("medicion_id").collect())
    assert got == exp
    # restarting the query on the same checkpoint replays nothing
    q2 = stream_ingest(spark, f"{src}/*", root, ck, now=NOW)
    q2.awaitTermination(600)
    assert Warehouse.load(spark, root).fact.count() == ref.fact.count()


def test_daily_operator_stream_matches_batch(spark):
    """Append mode: every column, on every day that the watermark passed, with
    repeated keys within and across files, rows the fact cannot take, rows later
    than their neighbours but within the delay, and rows beyond it."""
    base = tempfile.mkdtemp(prefix="covstar-stream-")
    raw = raw_from_dir(spark, SF)
    ts = lambda t: F.lit(t).cast("timestamp_ntz")
    raw = raw.filter(F.col("timestamp") < ts("2024-02-20"))
    odd = F.col("id").cast("long") % 5 == 0
    early, rest = F.col("timestamp") < ts("2024-01-12"), F.col("timestamp") >= ts("2024-01-12")
    late = early & odd & (F.col("timestamp") >= ts("2024-01-10"))           # within the delay
    files = [raw.filter(early & ~late), raw.filter(rest & (F.col("timestamp") < ts("2024-01-16"))).unionByName(raw.filter(late))
             .unionByName(raw.filter(late).limit(9)).unionByName(raw.filter(early & ~late & (F.col("timestamp") >= ts("2024-01-11"))).limit(9)),
             raw.filter(F.col("timestamp") >= ts("2024-01-16"))]
    # beyond the delay: dropped; the last rows close every day before them (a batch
    # works with the watermark of the batch before it)
    whole = raw.filter("latitude is not null and battery < 1000 and device_id like 'dev%'")
    files.append(whole.limit(1).withColumn("id", F.lit("too late")).withColumn("timestamp", ts("2024-01-01 03:00:00")))
    for day in ("2025-06-01", "2025-06-02"):
        files.append(whole.limit(1).withColumn("id", F.lit("last")).withColumn("timestamp", ts(day)))
    for i, part in enumerate(files):
        part.coalesce(1).write.parquet(f"{base}/feed/p{i}")
    s = daily_operator_stream(raw_stream(spark, f"{base}/feed/*", max_files_per_trigger=1), delay="7 days")
    q = (s.writeStream.outputMode("append").format("parquet").option("path", f"{base}/out")
          .trigger(availableNow=True).option("checkpointLocation", f"{base}/ck").start())
    q.awaitTermination(600)
    assert q.exception() is None
    ref = Warehouse.from_raw(raw, now=NOW).daily_operator_stats()
    got = spark.read.parquet(f"{base}/out")
    assert got.filter("total_mediciones > 1").count() > 20
    same = lambda df: sorted(tuple(r) for r in df.select(*got.columns).collect())
    assert same(got) == same(ref)


def test_stream_ingest_with_watermark_dedupe(spark):
    base = tempfile.mkdtemp(prefix="covstar-stream-")
    src, root, ck = f"{base}/feed", f"{base}/wh", f"{base}/ck"
    _write_feed(spark, src)
    q = stream_ingest(spark, f"{src}/*", root, ck, now=NOW, dedupe_delay="3650 days")
    q.awaitTermination(600)
    assert q.exception() is None
    ref = Warehouse.from_raw(raw_from_dir(spark, SF), now=NOW)
    assert Warehouse.load(spark, root).fact.count() == ref.fact.count()


def test_stream_keeps_daily_aggregate_exact(spark):
    from covstar.plans import store
    base = tempfile.mkdtemp(prefix="covstar-stream-")
    src, root, ck = f"{base}/feed", f"{base}/wh", f"{base}/ck"
    raw = _write_feed(spark, src)
    q = stream_ingest(spark, f"{src}/*", root, ck, now=NOW, max_files_per_trigger=1, refresh_daily=True)
    q.awaitTermination(600)
    assert q.exception() is None
    got = sorted(tuple(r) for r in store.read_table(spark, root, "mv_stats_diarias_operador").collect())
    exp = sorted(tuple(r) for r in Warehouse.from_raw(raw, now=NOW).daily_operator_stats().collect())
    assert got == exp


def test_two_streams_into_one_root_equal_the_batch_load(spark):
    base = tempfile.mkdtemp(prefix="covstar-stream-")
    root = f"{base}/wh"
    raw = raw_from_dir(spark, SF)
    odd = F.col("id").cast("long") % 2 == 1
    for name, part in (("a", raw.filter(odd)), ("b", raw.filter(~odd))):
        part.coalesce(1).write.parquet(f"{base}/{name}/p0")
        q = stream_ingest(spark, f"{base}/{name}/*", root, f"{base}/ck-{name}", now=NOW)
        q.awaitTermination(600)
        assert q.exception() is None
    assert Warehouse.load(spark, root).fact.count() == Warehouse.from_raw(raw, now=NOW).fact.count()


def test_a_replay_heals_an_aggregate_that_a_crash_left_behind(spark, monkeypatch):
    from covstar.plans import store
    from covstar.streaming import ingest
    root = tempfile.mkdtemp(prefix="covstar-stream-")
    raw = raw_from_dir(spark, SF)
    load = ingest._load_micro_batch(root, NOW, refresh_daily=True)
    real = ingest.refresh_daily_days

    def dies(*a):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "refresh_daily_days", dies)
    try:
        load(raw, 0)
    except RuntimeError:
        pass
    monkeypatch.setattr(ingest, "refresh_daily_days", real)
    load(raw, 0)
    got = sorted(tuple(r) for r in store.read_table(spark, root, "mv_stats_diarias_operador").collect())
    assert got == sorted(tuple(r) for r in Warehouse.from_raw(raw, now=NOW).daily_operator_stats().collect())
