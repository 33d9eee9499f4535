"""Dimension joins with a checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension is broadcast only when its counted rows times the most bytes one
# of its rows may take stay within this bound; beyond it the join is a shuffle
# join (and AQE may still convert it at run time from real shuffle statistics).
DEFAULT_BROADCAST_MAX_BYTES = 128 << 20
BROADCAST_CONF = "covstar.broadcast.maxBytes"
# Text columns of the schema hold at most this many bytes.
TEXT_BYTES = 255


def broadcast_limit(spark: SparkSession) -> int:
    v = spark.conf.get(BROADCAST_CONF, None)
    return int(v) if v else DEFAULT_BROADCAST_MAX_BYTES


def row_bytes(df: DataFrame) -> int:
    """The most bytes a row takes, by column type."""
    return sum(16 + TEXT_BYTES if isinstance(f.dataType, T.StringType) else 24 for f in df.schema.fields)


def broadcastable(df: DataFrame, rows: int | None) -> bool:
    return rows is not None and rows * row_bytes(df) <= broadcast_limit(df.sparkSession)


def dim_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
             dim_rows: int | None = None) -> DataFrame:
    """Join a fact frame to a dimension. ``dim_rows`` is the counted size of
    the dimension (``None`` = unknown): the broadcast hint is given only when
    the count and the column types prove that the dimension is small."""
    return fact.join(F.broadcast(dim) if broadcastable(dim, dim_rows) else dim, on, how)


def resolve_key(df: DataFrame, dim: DataFrame, natural: list[str], id_col: str, default: int,
                dim_rows: int | None = None, target: str | None = None) -> DataFrame:
    """Natural key -> surrogate id through a left join; unmatched rows
    get ``default``. Replaces a driver-side dictionary with a (broadcast) join."""
    look = dim.select(*natural, F.col(id_col).alias("_rid"))
    out = dim_join(df, look, natural, "left", dim_rows)
    return out.withColumn(target or id_col, F.coalesce(F.col("_rid"), F.lit(default))).drop("_rid")
