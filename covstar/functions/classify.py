"""Classification rules: signal quality, altitude band, day part, colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from ._util import ColumnOrName, col


def signal_class(c: ColumnOrName) -> Column:
    """dBm -> EXCELENTE/BUENA/REGULAR/MALA/CRITICA. A NULL signal falls through
    every comparison and is CRITICA (the load rule)."""
    x = col(c)
    expr = None
    for bound, label, _ in C.SIGNAL_CLASSES:
        cond = x >= bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.SIGNAL_CLASS_LAST[0]))


def signal_class_id(c: ColumnOrName) -> Column:
    """dBm -> class id 1..5, NULL -> NULL (the SQL function of the schema).

    Same bounds as ``signal_class``; only the NULL case differs."""
    x = col(c)
    expr = F.when(x.isNull(), F.lit(None).cast("int"))
    for bound, _, cid in C.SIGNAL_CLASSES:
        expr = expr.when(x >= bound, F.lit(cid))
    return expr.otherwise(F.lit(C.SIGNAL_CLASS_LAST[1]))


def class_id_of(c: ColumnOrName) -> Column:
    """Quality class name -> id (lookup of the seeded dimension), unknown -> NULL."""
    x = col(c)
    expr = None
    for _, label, cid in C.SIGNAL_CLASSES + [(None, *C.SIGNAL_CLASS_LAST)]:
        cond = x == label
        expr = F.when(cond, F.lit(cid)) if expr is None else expr.when(cond, F.lit(cid))
    return expr


def altitude_band(c: ColumnOrName) -> Column:
    """Metres -> BAJA (<2500) / MEDIA (<3000) / ALTA (else, NULL included)."""
    x = col(c)
    expr = None
    for bound, label in C.ALTITUDE_BANDS:
        cond = x < bound
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.ALTITUDE_BAND_LAST))


def day_part(hour: ColumnOrName) -> Column:
    """Hour 0..23 -> MAÑANA 6-11, TARDE 12-18, NOCHE 19-23, else MADRUGADA."""
    h = col(hour)
    expr = None
    for lo, hi, label in C.DAY_PARTS:
        cond = h.between(lo, hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(C.DAY_PART_OTHER))


def weekend_flag(dow: ColumnOrName) -> Column:
    """Spark dayofweek (1 = Sunday) -> SI on Saturday/Sunday, else NO."""
    return (F.when(col(dow).isin(*C.WEEKEND_DAYS), F.lit(C.WEEKEND_YES))
             .otherwise(F.lit(C.WEEKEND_NO)))


def mean_signal_color(c: ColumnOrName) -> Column:
    """Zone colour from a mean signal, same bounds as the quality classes.
    A NULL mean (no signal in the zone) gets the last colour, as a failed
    comparison does."""
    x = col(c)
    expr = None
    for (bound, _, _), colour in zip(C.SIGNAL_CLASSES, C.MEAN_SIGNAL_COLORS):
        cond = x >= bound
        expr = F.when(cond, F.lit(colour)) if expr is None else expr.when(cond, F.lit(colour))
    return expr.otherwise(F.lit(C.MEAN_SIGNAL_COLOR_LAST))


def class_color(c: ColumnOrName) -> Column:
    """Point colour from a quality class name; unknown or NULL -> gray."""
    x = col(c)
    expr = None
    for label, colour in C.CLASS_POINT_COLORS:
        cond = x == label
        expr = F.when(cond, F.lit(colour)) if expr is None else expr.when(cond, F.lit(colour))
    return expr.otherwise(F.lit(C.CLASS_POINT_COLOR_OTHER))


def heat_weight(c: ColumnOrName) -> Column:
    """Heat-map weight of a point: |signal|."""
    return F.abs(col(c))
