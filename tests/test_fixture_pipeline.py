"""The whole pipeline on hand-written raw rows (FIXTURES §1 edge cases):
duplicate keys, devices with several names / ids, missing ids and names,
coordinates around zero and on cell edges, NULL / NaN values and text
timestamps, some unparsable."""

import math

import pytest
from pyspark.sql import functions as F

from covstar import Warehouse
from covstar.operators import audit as D
from covstar.operators.clean import normalize
from covstar.sources.raw import RAW_TEXT_SCHEMA

NAN = float("nan")
ROWS = [
    # id, timestamp, lat, lon, alt, speed, signal, battery, operator, network, device_id, device_name
    ("a1", "2025-11-14T00:00:00", -17.80, -63.10, 400.0, 1.0, -69.99, 50.0, "Entel S.A Bolivia", "4G", "d1", "PHONE A"),
    ("a1", "2025-11-14T00:00:00", -17.80, -63.10, 400.0, 1.0, -50.0, 50.0, "Tigo", "3g", "d1", "PHONE A"),  # dup key
    ("a1", "2025-11-14T00:05:00", -17.81, -63.11, 2500.0, 2.0, -70.0, 50.0, "viva", "LTE-A", "d1", "PHONE A2"),
    ("a2", "2025-11-20T23:59:59", 0.019, -0.019, 2999.99, None, -85.01, None, "BOMOV", "WiFi", "d2", "PHONE B"),
    ("a3", "2025-11-21T00:00:00", 0.02, 0.04, 3000.0, 0.0, None, 10.0, None, None, None, "PHONE B"),
    ("a4", "2025-12-06T12:00:00", -0.02, 17.0, None, 5.0, NAN, 20.0, "Sin señal", "None", "", "PHONE C"),
    ("a5", "2025-12-07T00:00:00", -17.79, -63.09, 100.0, 5.0, -105.01, 20.0, "other", "5G", None, None),
    ("a6", "not a time", -17.79, -63.09, 100.0, 5.0, -90.0, 20.0, "Tigo", "2G", "d3", "PHONE D"),
    ("a7", "2024-12-30T08:00:00", None, -63.09, 100.0, 5.0, -90.0, 20.0, "Tigo", "2G", "d3", "PHONE D"),
    ("a8", "2024-12-30T19:00:00", NAN, -63.09, 100.0, 5.0, -90.0, 20.0, "Tigo", "2G", "d3", "PHONE D"),
    ("a9", "2024-12-30T05:00:00", -17.795, -63.095, 100.0, 5.0, -95.0, 20.0, "+18VACUNATE", "Mobile", "d4", "PHONE B"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, RAW_TEXT_SCHEMA)


@pytest.fixture(scope="module")
def wh(raw):
    return Warehouse.from_raw(raw, now="2025-12-10 00:00:00")


def test_validation_drops_unparsable_and_missing_coordinates(raw):
    ids = sorted(r.id for r in normalize(raw).collect())
    assert ids == ["a1", "a1", "a1", "a2", "a3", "a4", "a5", "a9"]   # a6 bad time, a7 NULL lat, a8 NaN lat


def test_duplicate_key_keeps_one_deterministic_row(wh):
    f = wh.fact.filter(F.col("source_id") == "a1").orderBy("timestamp").collect()
    assert len(f) == 2
    # of the two rows with key (a1, 00:00), the smaller survives: signal -69.99 < -50
    assert float(f[0].medida_senal) == -69.99
    assert D.check_unique(wh.fact, ["source_id", "timestamp"]).count() == 0


def test_device_keys_and_names(wh):
    d = {r.device_id: r.device_name for r in wh.dims["dim_dispositivo"].collect()}
    assert d["d1"] == "PHONE A"                      # one id, two names: the smaller name
    assert d["UNKNOWN_PHONE B"] == "PHONE B"         # NULL id -> name-based key
    assert d["UNKNOWN_PHONE C"] == "PHONE C"         # '' id -> name-based key
    assert None not in d                             # no id and no name: no member ...
    assert wh.fact.filter(F.col("source_id") == "a5").count() == 0      # ... no fact row ...
    q = wh.quarantine.collect()                                          # ... but quarantined
    assert [(r.source_id, r.motivo) for r in q] == [("a5", "sin_dispositivo")]


def test_multi_id_models_on_raw(raw):
    got = {(r.device_name, r.device_id, r.num_ids) for r in D.multi_id_models(raw).collect()}
    assert got == {("PHONE B", "d2", 2), ("PHONE B", "d4", 2)}


def test_classes_bands_and_cells(wh):
    af = {r.source_id + "@" + str(r.timestamp): r for r in
          wh.full_view(extra=("source_id",)).collect()}
    by_id = {}
    for r in af.values():
        by_id.setdefault(r.source_id, []).append(r)
    a2, a3, a4 = by_id["a2"][0], by_id["a3"][0], by_id["a4"][0]
    assert a2.calidad_categoria == "REGULAR" and a2.zona_altitud == "MEDIA" and a2.operador_nombre == "ENTEL"
    assert a3.calidad_categoria == "CRITICA" and a3.zona_altitud == "ALTA"
    assert a3.operador_nombre == "SIN_SEÑAL" and a3.red_tipo == "SIN_RED"
    assert a4.calidad_categoria == "CRITICA"         # NaN signal is missing, not >= -70
    assert a4.zona_altitud == "ALTA" and a4.red_tipo == "SIN_RED"
    zones = {(r.grid_lat, r.grid_lon): r.total_mediciones for r in wh.dims["dim_zonas"].collect()}
    assert zones[(0, 0)] == 1                        # (0.019, -0.019): truncation merges both sides of 0
    assert zones[(1, 2)] == 1                        # exactly on the edge 0.02 / 0.04
    assert zones[(-1, 850)] == 1                     # (-0.02, 17.0)


def test_week_partitions_and_calendar(wh):
    f = {r.source_id: r for r in wh.fact.collect()}
    assert f["a2"].semana == "2025-11-17" and f["a3"].semana == "2025-11-17"
    assert f["a9"].semana == "2024-12-30"
    t = {r.tiempo_id: r for r in wh.dims["dim_tiempo"].collect()}
    assert t[20241230].semana_anio == 1 and t[20241230].nombre_dia == "LUNES"
    ref = {r.semana: r.registros for r in wh.partition_counts(reference_bounds=True).collect()}
    assert ref == {"2025_11_w1": 3, "2025_11_w2": 1, "2025_12_w1": 1, "default": 1}   # a5 quarantined


def test_day_parts_of_fixture(wh):
    h = {r.hora: r.franja_horaria for r in wh.dims["dim_hora"].collect()}
    assert h[0] == "MADRUGADA" and h[5] == "MADRUGADA" and h[23] == "NOCHE" and h[12] == "TARDE"


def test_zone_centre_is_exact_mean(wh):
    z = {(r.grid_lat, r.grid_lon): r for r in wh.dims["dim_zonas"].collect()}
    cell = z[(-890, -3155)]
    # (-17.80, -63.10) and (-17.81, -63.11) both truncate into this cell
    assert cell.total_mediciones == 2 and math.isclose(cell.centro_lat, -17.805)
    assert math.isclose(cell.centro_lon, -63.105)
