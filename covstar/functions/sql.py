"""The scalar rules as SQL functions, for SQL users (U1f).

``register_sql_functions(spark)`` creates session-scoped SQL functions whose
bodies are CASE expressions generated from the same fixed values as the
Column functions. Spark inlines them into the query plan (they compile into
whole-stage code like any expression; no Python is involved).
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .. import constants as C


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _signal_id_sql() -> str:
    arms = " ".join(f"WHEN signal_dbm >= {b} THEN {cid}" for b, _, cid in C.SIGNAL_CLASSES)
    return f"CASE WHEN signal_dbm IS NULL THEN NULL {arms} ELSE {C.SIGNAL_CLASS_LAST[1]} END"


def _signal_class_sql() -> str:
    arms = " ".join(f"WHEN signal >= {b} THEN {_q(lab)}" for b, lab, _ in C.SIGNAL_CLASSES)
    return f"CASE {arms} ELSE {_q(C.SIGNAL_CLASS_LAST[0])} END"


def _operator_sql() -> str:
    arms = " ".join(f"WHEN contains(upper(x), {_q(f)}) THEN {_q(lab)}" for f, lab in C.OPERATOR_CONTAINS_RULES)
    none = ", ".join(_q(v) for v in C.OPERATOR_NONE_VALUES)
    lab = _q(C.OPERATOR_NONE_LABEL)
    return f"CASE {arms} WHEN x IN ({none}) THEN {lab} WHEN x IS NULL THEN {lab} ELSE upper(x) END"


def _network_sql() -> str:
    arms = " ".join(f"WHEN upper(x) = {_q(v)} THEN {_q(v)}" for v in C.NETWORK_EXACT_VALUES)
    arms += " " + " ".join(f"WHEN contains(upper(x), {_q(f)}) THEN {_q(lab)}" for f, lab in C.NETWORK_CONTAINS_RULES)
    none = ", ".join(_q(v) for v in C.NETWORK_NONE_VALUES)
    lab = _q(C.NETWORK_NONE_LABEL)
    return f"CASE {arms} WHEN x IN ({none}) THEN {lab} WHEN x IS NULL THEN {lab} ELSE upper(x) END"


def _day_part_sql() -> str:
    arms = " ".join(f"WHEN h BETWEEN {lo} AND {hi} THEN {_q(lab)}" for lo, hi, lab in C.DAY_PARTS)
    return f"CASE {arms} ELSE {_q(C.DAY_PART_OTHER)} END"


def _altitude_sql() -> str:
    arms = " ".join(f"WHEN alt < {b} THEN {_q(lab)}" for b, lab in C.ALTITUDE_BANDS)
    return f"CASE {arms} ELSE {_q(C.ALTITUDE_BAND_LAST)} END"


SQL_FUNCTIONS = {
    # name: (parameters, return type, body)
    "get_calidad_id": ("signal_dbm INT", "INT", _signal_id_sql),
    "signal_class": ("signal DOUBLE", "STRING", _signal_class_sql),
    "normalize_operator": ("x STRING", "STRING", _operator_sql),
    "normalize_network": ("x STRING", "STRING", _network_sql),
    "day_part": ("h INT", "STRING", _day_part_sql),
    "altitude_band": ("alt DOUBLE", "STRING", _altitude_sql),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions; returns their names."""
    for name, (params, ret, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body()}")
    return list(SQL_FUNCTIONS)
