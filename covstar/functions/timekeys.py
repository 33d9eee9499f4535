"""Time expressions: parsing, date/hour keys, calendar attributes, partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as C
from ._util import ColumnOrName, col


def parse_ts(df: DataFrame, name: str = "timestamp") -> Column:
    """Timestamp column of ``df``: text is parsed with ``try_to_timestamp``
    (unparsable -> NULL instead of failing under ANSI mode); a timestamp column
    (with or without time zone) is kept as it is."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.col(name)
    if isinstance(dtype, T.DateType):
        return F.col(name).cast("timestamp")
    return F.try_to_timestamp(F.col(name).cast("string"))


def ts_literal(value, dtype) -> Column:
    """A timestamp literal of ``dtype`` that means the same wall-clock time
    in every process: Python datetimes are written as ISO text first (a
    ``datetime`` literal would be read in the Python process's local time
    zone), then cast; text is cast as it is."""
    import datetime as _dt
    if isinstance(value, _dt.datetime):
        value = value.isoformat(sep=" ")
    elif isinstance(value, _dt.date):
        value = value.isoformat()
    return F.lit(value).cast(dtype)


def date_key(d: ColumnOrName) -> Column:
    """``yyyymmdd`` integer key of a date."""
    x = col(d)
    return F.year(x) * 10000 + F.month(x) * 100 + F.dayofmonth(x)


def with_time_keys(df: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Adds ``fecha`` (date), ``hora`` (0..23) and ``tiempo_id`` (yyyymmdd)."""
    return (df.withColumns({"fecha": F.to_date(F.col(ts)), "hora": F.hour(F.col(ts))})
              .withColumn("tiempo_id", date_key("fecha")))


def day_name(dow: ColumnOrName) -> Column:
    """Spark dayofweek (1 = Sunday) -> DOMINGO..SABADO."""
    return F.element_at(F.array(*[F.lit(n) for n in C.DAY_NAMES]), col(dow))


def month_name(month: ColumnOrName) -> Column:
    """Month 1..12 -> Enero..Diciembre."""
    return F.element_at(F.array(*[F.lit(n) for n in C.MONTH_NAMES]), col(month))


def calendar_columns(d: ColumnOrName = "fecha") -> dict[str, Column]:
    """Calendar attributes of a date: the time-dimension columns."""
    x = col(d)
    return {
        "tiempo_id": date_key(x),
        "anio": F.year(x),
        "trimestre": F.quarter(x),
        "mes": F.month(x),
        "semana_anio": F.weekofyear(x),
        "dia_mes": F.dayofmonth(x),
        "dia_semana": F.dayofweek(x),
        "nombre_dia": day_name(F.dayofweek(x)),
        "nombres_mes": month_name(F.month(x)),
    }


def hour_label(h: ColumnOrName) -> Column:
    """Hour -> ``HH:00`` slicer label."""
    return F.format_string("%02d:00", col(h))


def parse_hour(label: ColumnOrName) -> Column:
    """``HH:00`` -> hour (inverse of ``hour_label``); bad text -> NULL."""
    return F.split(col(label), ":").getItem(0).try_cast("int")


def week_partition(ts: ColumnOrName) -> Column:
    """General weekly partition label: the Monday starting the week of ``ts``,
    as ``yyyy-MM-dd``. Used as the fact table's physical partition column."""
    d = F.to_date(col(ts))
    # dayofweek: Sunday = 1 ... Saturday = 7 -> days back to the Monday
    return F.date_sub(d, (F.dayofweek(d) + 5) % 7).cast("string")


def reference_partition(ts: ColumnOrName, bounds=C.REFERENCE_WEEK_BOUNDS) -> Column:
    """Label of the fixed half-open weekly ranges, else ``default``."""
    # bounds fall on midnights, so comparing dates is the same half-open test
    # and works for timestamps with or without time zone
    x = F.to_date(col(ts))
    expr = None
    for start, end, label in bounds:
        cond = (x >= F.lit(start).cast("date")) & (x < F.lit(end).cast("date"))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.DEFAULT_PARTITION))

