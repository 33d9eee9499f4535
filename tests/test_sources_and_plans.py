"""Raw sources in every text format, the dashboard facade, and the exact
touched-day refresh of the daily statistics."""

import tempfile

from pyspark.sql import functions as F

from covstar import Warehouse, raw_from_dir
from covstar.operators.clean import normalize
from covstar.plans import etl
from covstar.plans.dashboard import dashboard
from covstar.sources.raw import extract, read_measurements, since
from covstar.streaming.ingest import refresh_touched_days

SF = "/root/testdata/sf0.001"
NOW = "2025-01-01 00:00:00"
COLS = ["id", "operador_normalizado", "red_normalizada", "calidad_senal", "grid_lat", "grid_lon",
        "fecha", "hora", "tiempo_id", "device_id"]


def test_json_and_csv_feeds_normalise_like_parquet(spark):
    base = tempfile.mkdtemp(prefix="covstar-src-")
    raw = raw_from_dir(spark, SF)
    text = raw.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    text.write.json(f"{base}/json")
    text.write.option("header", True).csv(f"{base}/csv")
    raw.write.parquet(f"{base}/parquet")
    exp = sorted(tuple(r) for r in normalize(read_measurements(spark, f"{base}/parquet")).select(*COLS).collect())
    for fmt in ("json", "csv"):
        got = sorted(tuple(r) for r in normalize(read_measurements(spark, f"{base}/{fmt}", fmt)).select(*COLS).collect())
        assert got == exp, fmt


def test_since_and_extract(spark):
    raw = raw_from_dir(spark, SF)
    wm = "2024-01-20 00:00:00"
    assert since(raw, None).count() == raw.count()
    assert since(raw, "1970-01-01").count() == raw.count()
    n = since(raw, wm).count()
    assert n == raw.filter(F.col("timestamp") > F.lit(wm).cast("timestamp_ntz")).count()
    assert extract(raw, 10).count() >= 10


def test_dashboard_facade(spark):
    w = Warehouse.from_raw(raw_from_dir(spark, SF), now=NOW)
    d = dashboard(w, date_from="2024-01-05", date_to="2024-01-20", hour_from="06:00", hour_to="18:00",
                  operador="ENTEL", device="MODEL 3")
    n = d["filtered_rows"].first()[0]
    assert d["kpis"].first()["registros_filtrados"] == n
    assert sum(r.mediciones for r in d["operator_share"].collect()) == n
    assert d["heat_layer"]().count() == min(n, 2000)
    assert d["device_log"].count() <= 100
    assert d["device_card"].first()["total_mediciones"] == \
        w.analytic_frame().filter(F.col("device_name") == "MODEL 3").count()


def test_touched_day_refresh_is_exact(spark):
    root = tempfile.mkdtemp(prefix="covstar-wh-")
    raw = raw_from_dir(spark, SF)
    etl.run(spark, raw, root, mode="initial", now=NOW)
    days = [20240103, 20240117]
    got = sorted(tuple(r) for r in refresh_touched_days(spark, root, days).collect())
    ref = Warehouse.from_raw(raw, now=NOW).daily_operator_stats()
    exp = sorted(tuple(r) for r in ref.filter(F.date_format("fecha", "yyyyMMdd").cast("int").isin(days)).collect())
    assert got == exp and len(got) > 0


def test_extract_takes_the_oldest_with_all_ties(spark):
    raw = raw_from_dir(spark, SF)
    ties = raw.withColumn("timestamp", F.date_trunc("minute", "timestamp").cast("timestamp_ntz"))
    for df in (raw, ties, ties.withColumn("timestamp", F.col("timestamp").cast("string"))):
        stamps = sorted(r.timestamp for r in df.select("timestamp").collect())
        for n in (1, 300, 999, 10 ** 6):
            got = extract(df, n)
            assert "TakeOrderedAndProject" not in got._jdf.queryExecution().executedPlan().toString()
            cut = stamps[min(n, len(stamps)) - 1]
            assert sorted(r.timestamp for r in got.collect()) == [t for t in stamps if t <= cut]


def test_command_line_jobs(spark, capsys):
    import json

    from covstar.__main__ import main
    base = tempfile.mkdtemp(prefix="covstar-cli-")
    assert main(["load-events", "--events", SF, "--root", f"{base}/wh", "--mode", "initial"]) == 0
    load = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert load["new_facts"] == Warehouse.load(spark, f"{base}/wh").fact.count() > 0
    assert main(["refresh", "--root", f"{base}/wh"]) == 0
    ref = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert [r[0] for r in ref["refreshed"]] == ["mv_stats_diarias_operador", "mv_stats_zonas", "mv_top_dispositivos"]
    raw_dir = f"{base}/raw"
    raw_from_dir(spark, SF).write.parquet(raw_dir)
    assert main(["zones", "--raw", raw_dir, "--out", f"{base}/zones"]) == 0
    zones = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert zones["top"][0]["zona_id"] == 1


def test_sql_views_answer_dashboard_and_audit_queries(spark):
    from covstar.functions.sql import register_sql_functions
    from covstar.operators import analytics as A
    w = Warehouse.from_raw(raw_from_dir(spark, SF), now=NOW)
    names = w.register_views()
    register_sql_functions(spark)
    assert "v_mediciones_completas" in names and "mv_stats_zonas" in names
    # values, not only counts: mean signal by operator and class, through the star
    got = {(r.o, r.k): (r.n, r.s) for r in spark.sql("""
        SELECT op.operador_nombre AS o, cal.calidad_categoria AS k, count(*) AS n,
               CAST(round(avg(CAST(m.medida_senal AS DECIMAL(28, 12))), 2) AS DOUBLE) AS s
        FROM fact_mediciones AS m, dim_operador AS op, dim_calidad AS cal
        WHERE op.operador_id = m.operador_id AND cal.calidad_id = m.calidad_id AND m.latitude IS NOT NULL
        GROUP BY ALL""").collect()}
    from covstar.operators.dimensions import exact_avg
    af = w.analytic_frame()
    want = {(r.operador_normalizado, r.calidad_senal): (r.n, r.s) for r in af.groupBy("operador_normalizado", "calidad_senal")
            .agg(F.count(F.lit(1)).alias("n"), exact_avg("medida_senal", 2).alias("s")).collect()}
    assert got == want and len(got) > 5
    recon = spark.sql("""
        WITH seen AS (SELECT DISTINCT dispositivo_id FROM fact_mediciones)
        SELECT count(d.dispositivo_id) AS total_dim, count(s.dispositivo_id) AS total_fact
        FROM dim_dispositivo d FULL JOIN seen s USING (dispositivo_id)""").first()
    q1 = w.device_reconciliation().first()
    assert (recon.total_dim, recon.total_fact) == (q1.total_dim, q1.total_fact)
    ids = spark.sql("SELECT get_calidad_id(CAST(medida_senal AS INT)) AS c, calidad_id FROM fact_mediciones "
                    "WHERE medida_senal IS NOT NULL").filter("c != calidad_id").count()
    assert ids == 0
    view_rows = spark.sql("SELECT COUNT(*) AS n FROM v_mediciones_completas").first().n
    assert view_rows == w.fact.count()
    kpi = spark.sql("SELECT COUNT(*) AS n FROM mv_stats_diarias_operador").first().n
    assert kpi == w.daily_operator_stats().count()
    assert A.kpis(af).first().registros_filtrados == sum(n for n, _ in want.values())


def test_watermark_cut_does_not_shift_with_time_zones(spark):
    import datetime as dt
    raw = raw_from_dir(spark, SF)
    wm = dt.datetime(2024, 1, 20, 0, 0, 0)
    expect = raw.filter(F.col("timestamp") > F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")).count()
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/La_Paz")   # differs from the Python process zone
    try:
        assert since(raw, wm).count() == expect
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
