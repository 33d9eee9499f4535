"""Fixed values of the coverage warehouse.

FIXED VALUES — these must equal the behaviour being reproduced, so they are
written out plainly, in their natural order, in one place. Every rule module
reads them from here; nothing else in the package hard-codes a label.
"""

from __future__ import annotations

# --- FIXED VALUES: grid ------------------------------------------------------
GRID_SIZE_ETL = 0.02        # cell size (degrees) of the warehouse zones
GRID_SIZE_ZONES = 0.04      # cell size (degrees) of the density-ranked zone build

# --- FIXED VALUES: operator normalisation (first match wins) -----------------
# (substring looked for in upper(sim_operator), normalised operator)
OPERATOR_CONTAINS_RULES = [
    ("ENTEL", "ENTEL"),
    ("DISTANCIA", "ENTEL"),
    ("MOVIL", "ENTEL"),
    ("BOMOV", "ENTEL"),
    ("VACUNATE", "ENTEL"),
    ("TIGO", "TIGO"),
    ("VIVA", "VIVA"),
    ("T-MOBILE", "T-MOBILE"),
]
# exact (case-sensitive) raw values meaning "no operator"; NULL means the same
OPERATOR_NONE_VALUES = ["Sin señal", "None", "Unknown", ""]
OPERATOR_NONE_LABEL = "SIN_SEÑAL"

# --- FIXED VALUES: network normalisation (first match wins) ------------------
NETWORK_EXACT_VALUES = ["WIFI", "4G", "3G", "2G", "MOBILE"]   # equality on upper()
NETWORK_CONTAINS_RULES = [("LTE", "4G")]                      # substring of upper()
NETWORK_NONE_VALUES = ["None", ""]                            # exact; NULL too
NETWORK_NONE_LABEL = "SIN_RED"
# network generation of a normalised network: LTE/4G -> 4G, 3G -> 3G, else NULL
NETWORK_GENERATION = [(("LTE", "4G"), "4G"), (("3G",), "3G")]

# --- FIXED VALUES: signal quality classes ------------------------------------
# (lower bound in dBm, inclusive; class name; class id). Below the last bound,
# or a missing signal, is the last class.
SIGNAL_CLASSES = [
    (-70, "EXCELENTE", 1),
    (-85, "BUENA", 2),
    (-95, "REGULAR", 3),
    (-105, "MALA", 4),
]
SIGNAL_CLASS_LAST = ("CRITICA", 5)

# seeded rows of the quality dimension:
# (calidad_id, calidad_categoria, signal_min, signal_max, descripcion)
QUALITY_SEED = [
    (1, "EXCELENTE", -70, 0, "Señal excelente, cobertura óptima"),
    (2, "BUENA", -85, -71, "Señal buena, sin problemas de conectividad"),
    (3, "REGULAR", -95, -86, "Señal aceptable, posibles interrupciones"),
    (4, "MALA", -105, -96, "Señal débil, problemas frecuentes"),
    (5, "CRITICA", -999, -106, "Señal crítica, conectividad muy limitada"),
]

# --- FIXED VALUES: altitude bands (upper bound exclusive, label) -------------
ALTITUDE_BANDS = [(2500, "BAJA"), (3000, "MEDIA")]
ALTITUDE_BAND_LAST = "ALTA"

# --- FIXED VALUES: day parts (first hour, last hour inclusive, label) --------
DAY_PARTS = [(6, 11, "MAÑANA"), (12, 18, "TARDE"), (19, 23, "NOCHE")]
DAY_PART_OTHER = "MADRUGADA"
DAY_PART_ORDER = ["MADRUGADA", "MAÑANA", "NOCHE", "TARDE"]  # sorted labels (pivot columns)

# --- FIXED VALUES: calendar names --------------------------------------------
# index = Spark dayofweek (1 = Sunday ... 7 = Saturday)
DAY_NAMES = ["DOMINGO", "LUNES", "MARTES", "MIERCOLES", "JUEVES", "VIERNES", "SABADO"]
# index = month 1..12
MONTH_NAMES = ["Enero", "Febrero", "Marzo", "Abril", "Mayo", "Junio", "Julio",
               "Agosto", "Septiembre", "Octubre", "Noviembre", "Diciembre"]
WEEKEND_DAYS = [1, 7]       # dayofweek values flagged "SI"
WEEKEND_YES, WEEKEND_NO = "SI", "NO"

# --- FIXED VALUES: density-ranked zone names ---------------------------------
# (minimum measurement count, density label); below the last bound: BAJA
ZONE_DENSITY = [(2000, "ALTA"), (500, "MEDIA")]
ZONE_DENSITY_LAST = "BAJA"
ZONE_PREFIX = "ZONA_"

# --- FIXED VALUES: colours ----------------------------------------------------
# colour of a zone by its mean signal (same bounds as SIGNAL_CLASSES)
MEAN_SIGNAL_COLORS = ["#00ff00", "#99ff33", "#ffff00", "#ff9900"]
MEAN_SIGNAL_COLOR_LAST = "#ff0000"
# colour of a point by its quality class; unknown class -> gray
CLASS_POINT_COLORS = [
    ("EXCELENTE", "green"),
    ("BUENA", "lightgreen"),
    ("REGULAR", "yellow"),
    ("MALA", "orange"),
    ("CRITICA", "red"),
]
CLASS_POINT_COLOR_OTHER = "gray"

# --- FIXED VALUES: weekly fact partitions ------------------------------------
# half-open [start, end) ranges of the original partition layout; anything
# else falls in the default partition.
REFERENCE_WEEK_BOUNDS = [
    ("2025-11-14", "2025-11-21", "2025_11_w1"),
    ("2025-11-21", "2025-11-28", "2025_11_w2"),
    ("2025-11-28", "2025-12-05", "2025_11_w3"),
    ("2025-12-05", "2025-12-07", "2025_12_w1"),
]
DEFAULT_PARTITION = "default"

# --- FIXED VALUES: key defaults for unmatched lookups ------------------------
DEFAULT_DEVICE_ID = 0
DEFAULT_OPERATOR_ID = 0
DEFAULT_NETWORK_ID = 0
DEFAULT_ZONE_ID = 0
DEFAULT_QUALITY_ID = 3
DEVICE_KEY_PREFIX = "UNKNOWN_"

# --- FIXED VALUES: map layers and lists --------------------------------------
HEAT_DEFAULT_POINTS = 2000
DEVICE_LOG_ROWS = 100

EPOCH = "1970-01-01 00:00:00"
