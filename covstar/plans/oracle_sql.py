"""The warehouse pipeline written once more as DuckDB SQL (the oracle).

The CTE chain mirrors the Spark plan step by step: adapter -> normalise ->
accepted rows -> dimensions with serial ids -> fact -> analytic frame. Rules
that differ between the engines are written out explicitly: DuckDB's
``dayofweek`` counts Sunday as 0, its integer cast rounds (so ``trunc``
first), and averages are rounded through a DECIMAL so that HALF_UP applies
to the decimal value, as in Spark.
"""

from __future__ import annotations

from ..operators.clean import NORMALIZED_SQL
from ..sources.adapter import RAW_SQL


def avg2(x: str, scale: int = 2) -> str:
    return f"CAST(round(CAST(avg(CAST({x} AS DECIMAL(28,12))) AS DECIMAL(20,10)), {scale}) AS DOUBLE)"


def round_dec(x: str, scale: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(20,10)), {scale}) AS DOUBLE)"


DAY_NAME_SQL = ("CASE dayofweek({d}) WHEN 0 THEN 'DOMINGO' WHEN 1 THEN 'LUNES' WHEN 2 THEN 'MARTES' "
                "WHEN 3 THEN 'MIERCOLES' WHEN 4 THEN 'JUEVES' WHEN 5 THEN 'VIERNES' ELSE 'SABADO' END")
MONTH_NAME_SQL = ("CASE month({d}) WHEN 1 THEN 'Enero' WHEN 2 THEN 'Febrero' WHEN 3 THEN 'Marzo' "
                  "WHEN 4 THEN 'Abril' WHEN 5 THEN 'Mayo' WHEN 6 THEN 'Junio' WHEN 7 THEN 'Julio' "
                  "WHEN 8 THEN 'Agosto' WHEN 9 THEN 'Septiembre' WHEN 10 THEN 'Octubre' "
                  "WHEN 11 THEN 'Noviembre' ELSE 'Diciembre' END")
DAY_PART_SQL = ("CASE WHEN {h} BETWEEN 6 AND 11 THEN 'MAÑANA' WHEN {h} BETWEEN 12 AND 18 THEN 'TARDE' "
                "WHEN {h} BETWEEN 19 AND 23 THEN 'NOCHE' ELSE 'MADRUGADA' END")
SIGNAL_CLASS_SQL = ("CASE WHEN {s} >= -70 THEN 'EXCELENTE' WHEN {s} >= -85 THEN 'BUENA' "
                    "WHEN {s} >= -95 THEN 'REGULAR' WHEN {s} >= -105 THEN 'MALA' ELSE 'CRITICA' END")
MEAN_COLOR_SQL = ("CASE WHEN {s} >= -70 THEN '#00ff00' WHEN {s} >= -85 THEN '#99ff33' "
                  "WHEN {s} >= -95 THEN '#ffff00' WHEN {s} >= -105 THEN '#ff9900' ELSE '#ff0000' END")
CLASS_COLOR_SQL = ("CASE {c} WHEN 'EXCELENTE' THEN 'green' WHEN 'BUENA' THEN 'lightgreen' "
                   "WHEN 'REGULAR' THEN 'yellow' WHEN 'MALA' THEN 'orange' WHEN 'CRITICA' THEN 'red' "
                   "ELSE 'gray' END")
WEEK_SQL = "strftime(CAST({t} AS DATE) - CAST((dayofweek({t}) + 6) % 7 AS INTEGER), '%Y-%m-%d')"


def calendar_select(d: str = "fecha") -> str:
    return f"""CAST(year({d}) * 10000 + month({d}) * 100 + day({d}) AS INTEGER) AS tiempo_id, {d} AS fecha,
    CAST(year({d}) AS INTEGER) AS anio, CAST(quarter({d}) AS INTEGER) AS trimestre,
    CAST(month({d}) AS INTEGER) AS mes, CAST(weekofyear({d}) AS INTEGER) AS semana_anio,
    CAST(day({d}) AS INTEGER) AS dia_mes, CAST(dayofweek({d}) + 1 AS INTEGER) AS dia_semana,
    {DAY_NAME_SQL.format(d=d)} AS nombre_dia, {MONTH_NAME_SQL.format(d=d)} AS nombres_mes"""


def zone_stats_sql(src: str, size: str = "0.02") -> str:
    return f"""SELECT CAST(trunc(latitude / {size}::DOUBLE) AS INTEGER) AS grid_lat,
         CAST(trunc(longitude / {size}::DOUBLE) AS INTEGER) AS grid_lon,
         count(*) AS total_mediciones,
         {avg2('latitude', 6)} AS centro_lat, {avg2('longitude', 6)} AS centro_lon,
         {avg2('altitude', 2)} AS altitud_promedio
  FROM {src} GROUP BY 1, 2"""


def dims_sql(src_norm: str = "norm", src_acc: str = "good", prefix: str = "") -> str:
    p = prefix
    return f"""
{p}d_tiempo AS (
  SELECT {calendar_select('fecha')} FROM (SELECT DISTINCT fecha FROM {src_norm} WHERE fecha IS NOT NULL)
),
{p}d_hora AS (
  SELECT hora AS hora_id, hora, {DAY_PART_SQL.format(h='hora')} AS franja_horaria
  FROM (SELECT DISTINCT hora FROM {src_norm} WHERE hora IS NOT NULL)
),
{p}d_operador AS (
  SELECT CAST(row_number() OVER (ORDER BY operador_nombre) AS INTEGER) AS operador_id, operador_nombre
  FROM (SELECT DISTINCT operador_normalizado AS operador_nombre FROM {src_norm} WHERE operador_normalizado IS NOT NULL)
),
{p}d_red AS (
  SELECT CAST(row_number() OVER (ORDER BY red_tipo) AS INTEGER) AS red_id, red_tipo,
         CASE WHEN red_tipo IN ('LTE', '4G') THEN '4G' WHEN red_tipo = '3G' THEN '3G' END AS generacion
  FROM (SELECT DISTINCT red_normalizada AS red_tipo FROM {src_norm} WHERE red_normalizada IS NOT NULL)
),
{p}d_dispositivo AS (
  SELECT CAST(row_number() OVER (ORDER BY device_id) AS INTEGER) AS dispositivo_id, device_id, device_name
  FROM (SELECT device_id, min(device_name) AS device_name FROM {src_norm} WHERE device_id IS NOT NULL GROUP BY device_id)
),
{p}zstats AS ({zone_stats_sql(src_acc)}),
{p}d_zonas AS (
  SELECT CAST(row_number() OVER (ORDER BY grid_lat, grid_lon) AS INTEGER) AS zona_id,
         'ZONA_' || CAST(grid_lat AS VARCHAR) || '_' || CAST(grid_lon AS VARCHAR) AS zona_nombre,
         grid_lat, grid_lon, centro_lat, centro_lon, total_mediciones, altitud_promedio,
         round(grid_lat * 0.02::DOUBLE, 6) AS grid_latitud_inicio, round((grid_lat + 1) * 0.02::DOUBLE, 6) AS grid_latitud_fin,
         round(grid_lon * 0.02::DOUBLE, 6) AS grid_longitud_inicio, round((grid_lon + 1) * 0.02::DOUBLE, 6) AS grid_longitud_fin
  FROM {p}zstats
)"""


def fact_sql(src_acc: str = "good", prefix: str = "") -> str:
    p = prefix
    return f"""
{p}fact AS (
  SELECT a."timestamp", a.tiempo_id, a.hora AS hora_id,
    COALESCE(dd.dispositivo_id, 0) AS dispositivo_id, COALESCE(o.operador_id, 0) AS operador_id,
    COALESCE(r.red_id, 0) AS red_id,
    CASE a.calidad_senal WHEN 'EXCELENTE' THEN 1 WHEN 'BUENA' THEN 2 WHEN 'REGULAR' THEN 3
         WHEN 'MALA' THEN 4 WHEN 'CRITICA' THEN 5 ELSE 3 END AS calidad_id,
    COALESCE(z.zona_id, 0) AS zona_id, a.zona_altitud,
    CAST(a.signal AS DECIMAL(10,2)) AS medida_senal, CAST(a.speed_kmh AS DECIMAL(10,2)) AS medida_velocidad,
    CAST(a.altitude AS DECIMAL(10,2)) AS medida_altitud, CAST(a.battery AS DECIMAL(5,2)) AS medida_bateria,
    CAST(a.latitude AS DECIMAL(10,6)) AS latitude, CAST(a.longitude AS DECIMAL(10,6)) AS longitude,
    a.source_id, {WEEK_SQL.format(t='a."timestamp"')} AS semana
  FROM {src_acc} a
  LEFT JOIN {p}d_dispositivo dd ON a.device_id = dd.device_id
  LEFT JOIN {p}d_operador o ON a.operador_normalizado = o.operador_nombre
  LEFT JOIN {p}d_red r ON a.red_normalizada = r.red_tipo
  LEFT JOIN {p}d_zonas z ON a.grid_lat = z.grid_lat AND a.grid_lon = z.grid_lon
)"""


ACC_SQL = """
acc AS (
  SELECT *, id AS source_id FROM norm
  WHERE device_id IS NOT NULL AND (battery IS NULL OR TRY_CAST(battery AS DECIMAL(5,2)) IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY id, "timestamp" ORDER BY device_id NULLS FIRST, signal NULLS FIRST) = 1
),
good AS (SELECT * FROM acc)"""

QUALITY_SQL = """
d_calidad AS (
  SELECT * FROM (VALUES
    (1, 'EXCELENTE', -70, 0, 'Señal excelente, cobertura óptima'),
    (2, 'BUENA', -85, -71, 'Señal buena, sin problemas de conectividad'),
    (3, 'REGULAR', -95, -86, 'Señal aceptable, posibles interrupciones'),
    (4, 'MALA', -105, -96, 'Señal débil, problemas frecuentes'),
    (5, 'CRITICA', -999, -106, 'Señal crítica, conectividad muy limitada')
  ) t(calidad_id, calidad_categoria, signal_min, signal_max, descripcion)
)"""

AF_SQL = """
af AS (
  SELECT f.source_id, f."timestamp", CAST(f.latitude AS DOUBLE) AS latitude, CAST(f.longitude AS DOUBLE) AS longitude,
    CAST(f.medida_senal AS DOUBLE) AS medida_senal, CAST(f.medida_altitud AS DOUBLE) AS medida_altitud,
    f.zona_id, f.zona_altitud, f.dispositivo_id, t.fecha, t.nombre_dia, t.mes, t.anio, h.hora, h.franja_horaria,
    o.operador_nombre AS operador_normalizado, r.red_tipo AS red_normalizada, c.calidad_categoria AS calidad_senal,
    d.device_name
  FROM fact f
  JOIN d_tiempo t ON f.tiempo_id = t.tiempo_id
  JOIN d_hora h ON f.hora_id = h.hora_id
  JOIN d_operador o ON f.operador_id = o.operador_id
  JOIN d_red r ON f.red_id = r.red_id
  JOIN d_calidad c ON f.calidad_id = c.calidad_id
  JOIN d_dispositivo d ON f.dispositivo_id = d.dispositivo_id
  WHERE f.latitude IS NOT NULL AND f.longitude IS NOT NULL
)"""


def with_pipeline(final: str, extra: str = "") -> str:
    """The full CTE chain followed by ``final``."""
    ctes = [RAW_SQL, NORMALIZED_SQL, ACC_SQL, dims_sql(), QUALITY_SQL, fact_sql(), AF_SQL]
    if extra:
        ctes.append(extra)
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + "\n" + final
