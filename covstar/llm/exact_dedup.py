"""Exact dedup with two passes of a Bloom filter, in DataFrame operations only.

Pass one hashes every text to ``PROBES`` slots of a filter with ``SLOTS_PER_ROW``
slots a row and counts the slots (partial counts in each task; slot numbers
travel, texts do not). Slots hit twice or more become bitmaps. Pass two probes
them: a text all of whose slots were hit again is possibly repeated, and every
repeated text is. Only those rows shuffle, to be grouped by SHA-256; the rest
pass straight through with no exchange above their scan.

The bitmaps are broadcast and never exceed ``filter_bytes``: a larger filter is
folded (slots modulo a smaller power of two), which lets more single rows
through to the exact step and changes no result. Two probes of 16 slots a row
let about 1 in 70 single rows through before folding.

Rows of a group are salted and aggregated before they meet, so a text that a
third of the rows share is never read by one task.

Results for odd input: a null text counts as empty, and empty texts are equal;
of equal texts the row with the largest ``order`` stays, nulls being smallest; of
rows that repeat both, one stays; other columns are carried unchanged, but those
named like a result are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covstar.llm.common import stored
from covstar.llm.grouping import with_totals

SLOTS_PER_ROW, PROBES = 16, 2
#: Most bytes of the broadcast bitmaps; one bitmap has 32,768 slots.
FILTER_BYTES = 64 << 20
BITMAP_SLOTS, BITMAP_BYTES = 32_768, 4_200
RESULTS = ["keep_id", "group_size", "kept", "text_sha256"]


def _slots(text: Column, n_slots: int) -> list[Column]:
    """Slots 1 to ``n_slots`` (a power of two) of a text, one for each probe."""
    return [F.xxhash64(text, F.lit(i)).bitwiseAND(F.lit(n_slots - 1).cast("long")) + 1 for i in range(PROBES)]


def _bitmaps(slots: DataFrame, slot: Column) -> DataFrame:
    at = slots.select(slot.alias("xd_slot"))
    return (at.groupBy(F.bitmap_bucket_number("xd_slot").alias("xd_bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("xd_slot")).alias("xd_bits")))


def repeated_slots(docs: DataFrame, text: Column, filter_bytes: int = FILTER_BYTES) -> tuple[DataFrame, int]:
    """Pass one: bitmaps (bucket, bits) of the slots hit more than once, and the number of slots."""
    n_slots = max(BITMAP_SLOTS, 1 << (SLOTS_PER_ROW * docs.count() - 1).bit_length())
    hit = docs.select(F.explode(F.array(*_slots(text, n_slots))).alias("xd_slot"))
    again = hit.groupBy("xd_slot").agg(F.count(F.lit(1)).alias("xd_n")).filter("xd_n > 1")
    bitmaps = stored(_bitmaps(again, F.col("xd_slot")), "xd-filter")
    most = max(1, filter_bytes // BITMAP_BYTES)
    if n_slots // BITMAP_SLOTS > most and bitmaps.count() > most:
        small = BITMAP_SLOTS << (most.bit_length() - 1)
        folded = F.pmod(F.col("xd_bucket") - 1, F.lit(small // BITMAP_SLOTS)) + 1
        n_slots, bitmaps = small, bitmaps.groupBy(folded.alias("xd_bucket")).agg(F.bitmap_or_agg("xd_bits").alias("xd_bits"))
    return bitmaps, n_slots


def possibly_repeated(docs: DataFrame, text: Column, bitmaps: DataFrame, n_slots: int) -> DataFrame:
    """Pass two: ``docs`` with ``xd_again``, true for every repeated text and few others."""
    out, again = docs, F.lit(True)
    for i, slot in enumerate(_slots(text, n_slots)):
        own = bitmaps.select(F.col("xd_bucket").alias(f"xd_bucket{i}"), F.col("xd_bits").alias(f"xd_bits{i}"))
        out = out.withColumn(f"xd_slot{i}", slot).join(
            F.broadcast(own), F.bitmap_bucket_number(f"xd_slot{i}") == F.col(f"xd_bucket{i}"), "left")
        place = F.bitmap_bit_position(f"xd_slot{i}")
        byte = F.conv(F.hex(F.substring(F.col(f"xd_bits{i}"), (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        again = again & (F.getbit(F.coalesce(byte, F.lit(0)), F.pmod(place, F.lit(8)).cast("int")) == 1)
    return out.select(*docs.columns, again.alias("xd_again"))


def marked(docs: DataFrame, text: str = "text", order: str = "doc_id", carry: list[str] | None = None,
           normal: Callable[[Column], Column] = lambda c: c, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Every row of ``docs`` (columns ``carry``, all if None) with ``keep_id``
    (``order`` of the row that stays), ``group_size``, ``kept`` and
    ``text_sha256``, the hash of the text after ``normal``."""
    carry = docs.columns if carry is None else carry
    carry = [c for c in carry if c not in RESULTS]
    body = F.coalesce(normal(F.col(text)), F.lit("")).cast("string")
    bitmaps, n_slots = repeated_slots(docs, body, filter_bytes)
    probed = possibly_repeated(docs, body, bitmaps, n_slots)
    sha = F.sha2(body.cast("binary"), 256).alias("text_sha256")
    single = probed.filter(~F.col("xd_again")).select(
        *carry, F.col(order).alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), sha)
    again = stored(probed.filter("xd_again").select(
        *carry, F.col(order).alias("xd_order"), sha, F.monotonically_increasing_id().alias("xd_row")), "xd-again")
    grouped = with_totals(again, "text_sha256", "xd_row",
                          {"best": F.max(F.struct("xd_order", "xd_row")), "n": F.count(F.lit(1))},
                          {"xd_best": F.max("best"), "xd_n": F.sum("n")})
    return single.unionByName(grouped.select(
        *carry, F.col("xd_best.xd_order").alias("keep_id"), F.col("xd_n").alias("group_size"),
        (F.col("xd_row") == F.col("xd_best.xd_row")).alias("kept"), "text_sha256"))


def distinct(docs: DataFrame, text: str = "text", order: str = "doc_id", **options) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns."""
    own = docs.withColumns({f"xd_own_{c}": F.col(c) for c in docs.columns if c in RESULTS})
    got = marked(own, text, order, **options).filter("kept")
    return got.select(*[F.col(f"xd_own_{c}").alias(c) if c in RESULTS else F.col(c) for c in docs.columns])
