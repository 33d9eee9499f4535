"""Totals of groups given back to their rows, with hot groups spread over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covstar.llm.common import spread


def with_totals(rows: DataFrame, key: str, row: str, parts: dict[str, Column], totals: dict[str, Column]) -> DataFrame:
    """``rows`` with ``totals`` of all rows that share ``key`` (nulls are one group).

    A row goes to one of many salts by the hash of its number ``row``. ``parts``
    are aggregates of one (key, salt), with partial results in each task;
    ``totals`` combine the few parts of a key. The totals then return to every
    (key, salt), so no task ever reads a whole group.
    """
    salts = spread(rows.sparkSession)
    salted = rows.withColumn("gt_salt", F.pmod(F.xxhash64(row), F.lit(salts)).cast("int"))
    part = salted.groupBy(F.col(key).alias("gt_key"), F.col("gt_salt").alias("gt_part")).agg(*[c.alias(n) for n, c in parts.items()])
    own = Window.partitionBy("gt_key")
    total = part.select("gt_key", "gt_part", *[c.over(own).alias(f"gt_{n}") for n, c in totals.items()])
    joined = salted.join(total, F.col(key).eqNullSafe(F.col("gt_key")) & (F.col("gt_salt") == F.col("gt_part")))
    return joined.select(*rows.columns, *[F.col(f"gt_{n}").alias(n) for n in totals])
