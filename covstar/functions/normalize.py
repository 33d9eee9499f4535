"""Normalisation of raw text columns (operator, network, device key).

All rules are plain ``Column`` expressions: they stay inside whole-stage
codegen and never leave the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import constants as C
from ._util import ColumnOrName, col


def normalize_operator(c: ColumnOrName) -> Column:
    """SIM operator -> canonical carrier name (first matching rule wins).

    ``upper(x)`` containing one of the carrier fragments maps to that carrier;
    the exact "no operator" spellings and NULL map to ``SIN_SEÑAL``; anything
    else is returned upper-cased.
    """
    x = col(c)
    ux = F.upper(x)
    expr = None
    for fragment, label in C.OPERATOR_CONTAINS_RULES:
        cond = ux.contains(fragment)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return (expr.when(x.isin(*C.OPERATOR_NONE_VALUES), F.lit(C.OPERATOR_NONE_LABEL))
                .when(x.isNull(), F.lit(C.OPERATOR_NONE_LABEL))
                .otherwise(ux))


def normalize_network(c: ColumnOrName) -> Column:
    """Network type -> WIFI/4G/3G/2G/MOBILE; LTE* -> 4G; None/''/NULL -> SIN_RED;
    anything else upper-cased (so ``5G`` passes through)."""
    x = col(c)
    ux = F.upper(x)
    expr = None
    for value in C.NETWORK_EXACT_VALUES:
        cond = ux == value
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    for fragment, label in C.NETWORK_CONTAINS_RULES:
        expr = expr.when(ux.contains(fragment), F.lit(label))
    return (expr.when(x.isin(*C.NETWORK_NONE_VALUES), F.lit(C.NETWORK_NONE_LABEL))
                .when(x.isNull(), F.lit(C.NETWORK_NONE_LABEL))
                .otherwise(ux))


def network_generation(c: ColumnOrName) -> Column:
    """Generation of a *normalised* network: LTE/4G -> 4G, 3G -> 3G, else NULL."""
    x = col(c)
    expr = None
    for values, label in C.NETWORK_GENERATION:
        cond = x.isin(*values)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def device_key(device_id: ColumnOrName, device_name: ColumnOrName) -> Column:
    """Natural device key: the raw id, or ``UNKNOWN_<name>`` when the id is
    NULL or empty. ``concat`` (not ``concat_ws``) keeps NULL when the name is
    NULL too, so a row with neither id nor name has no key."""
    i, n = col(device_id), col(device_name)
    return (F.when(i.isNull() | (i == ""), F.concat(F.lit(C.DEVICE_KEY_PREFIX), n))
             .otherwise(i))
