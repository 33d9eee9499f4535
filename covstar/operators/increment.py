"""Constraint checks of an increment (K11): the rules of the whole warehouse on
the rows of one load alone.

A load can break a rule only in its own rows: NOT NULL and foreign keys are tested
there, and the unique key by the rows that share a key with them. The stored side
of that last test is cut to the weeks and the time range of the load, and to the
keys that may repeat: a Bloom filter over the load's keys goes before the exact
count, so the stored rows that reach the shuffle are the load's own and few others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .audit import FACT_FOREIGN_KEYS, FACT_NOT_NULL, check_unique
from .joins import dim_join

#: Bits a key, and most bytes of the broadcast filter (beyond it, it is folded: more rows pass, none is lost).
BITS_PER_KEY, FILTER_BYTES, BITMAP_BITS, BITMAP_BYTES = 16, 64 << 20, 32_768, 4_200


def _slot(n_slots: int) -> Column:
    return F.xxhash64("source_id", "timestamp").bitwiseAND(F.lit(n_slots - 1).cast("long")) + 1


def possible_keys(stored: DataFrame, new: DataFrame, n_new: int) -> DataFrame:
    """The rows of ``stored`` whose key may be one of ``new``: all that are, and few others."""
    most = 1 << ((FILTER_BYTES // BITMAP_BYTES) * BITMAP_BITS).bit_length() - 1
    n_slots = min(most, max(BITMAP_BITS, 1 << (BITS_PER_KEY * max(1, n_new) - 1).bit_length()))
    slots = new.select(_slot(n_slots).alias("_slot"))
    bits = slots.groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bits"))
    probed = stored.withColumn("_slot", _slot(n_slots)).join(F.broadcast(bits), F.bitmap_bucket_number("_slot") == F.col("_bucket"))
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return probed.filter(F.getbit(byte, F.pmod(place, F.lit(8)).cast("int")) == 1).select(*stored.columns)


def increment_checks(new: DataFrame, stored: DataFrame, dims: dict, sizes: dict, n_new: int) -> DataFrame:
    """(tabla, regla, violaciones) of the rows ``new`` of one load. ``stored``:
    all facts that its keys can meet, its own rows included."""
    g = new.select(*dict.fromkeys([*FACT_NOT_NULL, *[k for k, _ in FACT_FOREIGN_KEYS]]))
    for key, dim in FACT_FOREIGN_KEYS:
        look = dims[dim].select(F.col(key), F.lit(True).alias(f"_ok_{key}")).distinct()
        g = dim_join(g, look, key, "left", sizes.get(dim))
    rules = {f"not_null:{c}": F.count_if(F.col(c).isNull()) for c in FACT_NOT_NULL}
    rules |= {f"fk:{k}->{d}": F.count_if(F.col(k).isNotNull() & F.col(f"_ok_{k}").isNull()) for k, d in FACT_FOREIGN_KEYS}
    one = g.agg(*[e.alias(f"_r{i}") for i, e in enumerate(rules.values())])
    counted = one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("regla"), F.col(f"_r{i}").alias("violaciones"))
                                             for i, n in enumerate(rules)])).alias("r")).select("r.*")
    keys = ["source_id", "timestamp"]
    fresh = new.select(*keys).distinct()
    twice = check_unique(possible_keys(stored.select(*keys), new, n_new), keys)
    mine = twice.join(fresh.select(F.col("source_id").alias("_s"), F.col("timestamp").alias("_t")),
                      F.col("source_id").eqNullSafe(F.col("_s")) & F.col("timestamp").eqNullSafe(F.col("_t")), "left_semi")
    unique = mine.agg(F.count(F.lit(1)).alias("violaciones")).select(F.lit("unique:source_id,timestamp").alias("regla"), "violaciones")
    return counted.unionByName(unique).select(F.lit("fact_mediciones").alias("tabla"), "regla", "violaciones")
