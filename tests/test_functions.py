"""Scalar rules on hand-written boundary rows (FIXTURES §1) and on the
exported golden dimension rows (FIXTURES §2)."""

import datetime as dt
import math

from pyspark.sql import functions as F

from covstar import functions as X


def _one_col(spark, values, dtype, expr_fn):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(expr_fn("x")).collect()]


def test_signal_class_limits(spark):
    vals = [-69.99, -70.0, -70.01, -85.0, -85.01, -95.0, -95.01, -105.0, -105.01, None]
    got = _one_col(spark, vals, "double", X.signal_class)
    assert got == ["EXCELENTE", "EXCELENTE", "BUENA", "BUENA", "REGULAR", "REGULAR", "MALA", "MALA",
                   "CRITICA", "CRITICA"]
    ids = _one_col(spark, vals, "double", X.signal_class_id)
    assert ids == [1, 1, 2, 2, 3, 3, 4, 4, 5, None]


def test_nan_signal_is_missing_after_cleaning(spark):
    from covstar.operators.clean import nan_to_null
    df = spark.createDataFrame([(float("nan"),), (-60.0,)], "signal double")
    got = [r[0] for r in nan_to_null(df).select(X.signal_class("signal")).collect()]
    assert got == ["CRITICA", "EXCELENTE"]


def test_altitude_bands(spark):
    got = _one_col(spark, [2499.99, 2500.0, 2999.99, 3000.0, None], "double", X.altitude_band)
    assert got == ["BAJA", "MEDIA", "MEDIA", "ALTA", "ALTA"]


def test_day_parts(spark):
    got = _one_col(spark, [0, 5, 6, 11, 12, 18, 19, 23], "int", X.day_part)
    assert got == ["MADRUGADA", "MADRUGADA", "MAÑANA", "MAÑANA", "TARDE", "TARDE", "NOCHE", "NOCHE"]


def test_operator_normalisation(spark):
    vals = ["Entel S.A Bolivia", "LaDistanciaNosCuida", "Movil GSM", "BOMOV", "+18VACUNATE", "Tigo", "viva",
            "T-Mobile", "Sin señal", "sin señal", "None", "Unknown", "", None, "other"]
    got = _one_col(spark, vals, "string", X.normalize_operator)
    assert got == ["ENTEL", "ENTEL", "ENTEL", "ENTEL", "ENTEL", "TIGO", "VIVA", "T-MOBILE", "SIN_SEÑAL",
                   "SIN SEÑAL", "SIN_SEÑAL", "SIN_SEÑAL", "SIN_SEÑAL", "SIN_SEÑAL", "OTHER"]


def test_network_normalisation_and_generation(spark):
    vals = ["WiFi", "4G", "3g", "2G", "Mobile", "LTE-A", "5G", "None", "none", "", None]
    got = _one_col(spark, vals, "string", X.normalize_network)
    assert got == ["WIFI", "4G", "3G", "2G", "MOBILE", "4G", "5G", "SIN_RED", "NONE", "SIN_RED", "SIN_RED"]
    gen = _one_col(spark, ["4G", "LTE", "3G", "2G", "5G", "WIFI"], "string", X.network_generation)
    assert gen == ["4G", "4G", "3G", None, None, None]


def test_device_key(spark):
    df = spark.createDataFrame([(None, "A"), ("", "B"), (None, None), ("id1", "C")], "i string, n string")
    got = [r[0] for r in df.select(X.device_key("i", "n")).collect()]
    assert got == ["UNKNOWN_A", "UNKNOWN_B", None, "id1"]


def test_grid_trunc_and_floor(spark):
    df = spark.createDataFrame([(-17.801,), (0.019,), (-0.019,), (0.02,), (None,)], "x double")
    trunc = [r[0] for r in df.select(X.grid_cell("x", 0.02)).collect()]
    floor = [r[0] for r in df.select(X.grid_cell("x", 0.02, "floor")).collect()]
    assert trunc == [-890, 0, 0, 1, None]
    assert floor == [-891, 0, -1, 1, None]


def test_floor_boxes_contain_their_points(spark):
    from covstar.sources.adapter import raw_from_dir
    raw = raw_from_dir(spark, "/root/testdata/sf0.001").dropna(subset=["latitude"])
    g = raw.select("latitude", X.grid_cell("latitude", 0.02, "floor").alias("g"))
    lo, hi = X.cell_bounds("g", 0.02)
    bad = g.filter((F.col("latitude") < lo - 1e-9) | (F.col("latitude") > hi + 1e-9)).count()
    assert bad == 0


# golden rows of the exported time and hour dimensions
TIME_GOLDEN = [
    ("2025-11-14", 2025, 4, 11, 46, 14, 6, "VIERNES", "NO"),
    ("2025-11-15", 2025, 4, 11, 46, 15, 7, "SABADO", "SI"),
    ("2025-11-16", 2025, 4, 11, 46, 16, 1, "DOMINGO", "SI"),
    ("2025-11-17", 2025, 4, 11, 47, 17, 2, "LUNES", "NO"),
    ("2025-11-21", 2025, 4, 11, 47, 21, 6, "VIERNES", "NO"),
]


def test_calendar_matches_export(spark):
    df = spark.createDataFrame([(dt.date.fromisoformat(r[0]),) for r in TIME_GOLDEN], "fecha date")
    cols = X.calendar_columns("fecha")
    out = df.select("fecha", cols["anio"], cols["trimestre"], cols["mes"], cols["semana_anio"], cols["dia_mes"],
                    cols["dia_semana"], cols["nombre_dia"], X.weekend_flag(cols["dia_semana"]),
                    cols["tiempo_id"], cols["nombres_mes"]).orderBy("fecha").collect()
    for r, g in zip(out, TIME_GOLDEN):
        assert (r[0].isoformat(), *r[1:9]) == g
        assert r[9] == int(g[0].replace("-", ""))
        assert r[10] == "Noviembre"


def test_iso_week_at_year_edge(spark):
    df = spark.createDataFrame([(dt.date(2024, 12, 30),)], "fecha date")
    assert df.select(X.calendar_columns("fecha")["semana_anio"]).first()[0] == 1


def test_hour_labels_roundtrip(spark):
    df = spark.createDataFrame([(h,) for h in range(24)], "h int")
    rows = df.select(X.hour_label("h").alias("l")).select("l", X.parse_hour("l")).collect()
    assert rows[5][0] == "05:00" and all(r[1] == i for i, r in enumerate(rows))


def test_zone_names_and_bounds_from_export(spark):
    # (zona_id, total, grid_lat, grid_lon, lat0, lat1, lon0, lon1, expected name)
    golden = [(1, 17854, -890, -3155, -17.8, -17.78, -63.1, -63.08, "ZONA_1_ALTA"),
              (2, 14435, -888, -3159, -17.76, -17.740000000000002, -63.18, -63.160000000000004, "ZONA_2_ALTA")]
    df = spark.createDataFrame([g[:4] for g in golden], "r long, n long, gl int, go int")
    lat0, lat1 = X.cell_bounds("gl", 0.02)
    lon0, lon1 = X.cell_bounds("go", 0.02)
    rows = df.select(X.density_zone_name("r", "n"), lat0, lat1, lon0, lon1).collect()
    for r, g in zip(rows, golden):
        assert r[0] == g[8]
        assert all(math.isclose(a, b, abs_tol=1e-12) for a, b in zip(r[1:], g[4:8]))
    mid = spark.createDataFrame([(3, 500), (4, 499), (5, 2000)], "r long, n long")
    assert [x[0] for x in mid.select(X.density_zone_name("r", "n")).collect()] == \
        ["ZONA_3_MEDIA", "ZONA_4_BAJA", "ZONA_5_ALTA"]


def test_partition_labels(spark):
    df = spark.createDataFrame([(dt.datetime(2025, 11, 13, 23, 59),), (dt.datetime(2025, 11, 14, 0, 0),),
                                (dt.datetime(2025, 11, 20, 23, 59),), (dt.datetime(2025, 11, 21, 0, 0),),
                                (dt.datetime(2025, 12, 6, 23, 0),), (dt.datetime(2025, 12, 7, 0, 0),)],
                               "t timestamp_ntz")
    got = [r[0] for r in df.select(X.reference_partition("t")).collect()]
    assert got == ["default", "2025_11_w1", "2025_11_w1", "2025_11_w2", "2025_12_w1", "default"]
    weeks = [r[0] for r in df.select(X.week_partition("t")).collect()]
    assert weeks[1] == "2025-11-10" and weeks[3] == "2025-11-17"


def test_colours(spark):
    got = _one_col(spark, [-60.0, -80.0, -90.0, -100.0, -110.0, None], "double", X.mean_signal_color)
    assert got == ["#00ff00", "#99ff33", "#ffff00", "#ff9900", "#ff0000", "#ff0000"]
    got = _one_col(spark, ["EXCELENTE", "MALA", "X", None], "string", X.class_color)
    assert got == ["green", "orange", "gray", "gray"]


def test_parse_ts_bad_text_is_null(spark):
    df = spark.createDataFrame([("2025-11-14T10:00:00",), ("not a time",)], "timestamp string")
    got = [r[0] for r in df.select(X.parse_ts(df, "timestamp")).collect()]
    assert got[0] is not None and got[1] is None


def test_sql_functions_match_column_functions(spark):
    from covstar.functions.sql import register_sql_functions
    from covstar.sources.adapter import raw_from_dir
    register_sql_functions(spark)
    raw = raw_from_dir(spark, "/root/testdata/sf0.001")
    raw.createOrReplaceTempView("raw_fixture")
    sql = spark.sql("""SELECT id, get_calidad_id(CAST(signal AS INT)) AS cid, signal_class(signal) AS cls,
                              normalize_operator(sim_operator) AS op, normalize_network(network_type) AS net,
                              day_part(hour(timestamp)) AS dp, altitude_band(altitude) AS band FROM raw_fixture""")
    col = raw.select("id", X.signal_class_id(F.col("signal").cast("int")).alias("cid"),
                     X.signal_class("signal").alias("cls"), X.normalize_operator("sim_operator").alias("op"),
                     X.normalize_network("network_type").alias("net"), X.day_part(F.hour("timestamp")).alias("dp"),
                     X.altitude_band("altitude").alias("band"))
    assert sorted(map(tuple, sql.collect())) == sorted(map(tuple, col.collect()))
    plan = sql._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_parse_ts_iso_forms(spark):
    vals = ["2025-11-14T00:00:00Z", "2025-11-14T00:00:00+00:00", "2025-11-14 00:00:00.123456",
            "2025-11-14T04:00:00-04:00", "2025-11-14", "garbage"]
    df = spark.createDataFrame([(v,) for v in vals], "timestamp string")
    # wall clock in the session time zone (UTC), independent of the process time zone
    got = [r[0] for r in df.select(X.parse_ts(df, "timestamp").cast("timestamp_ntz")).collect()]
    assert got[0] == got[1] == got[4] == dt.datetime(2025, 11, 14)
    assert got[2] == dt.datetime(2025, 11, 14, 0, 0, 0, 123456)
    assert got[3] == dt.datetime(2025, 11, 14, 8, 0)
    assert got[5] is None
