"""URL filter: a blocked Bloom filter of listed canonical URLs passes possible
hits to an exact hash join, which removes false positives.

A canonical URL is ``host + path`` (scheme, query and fragment removed, host in
lower case). A listed URL fits a page whose host is the listed host or a
subdomain of it and whose path starts with the listed path. A page therefore
has one candidate key for each (number of host labels, path length) that occurs
in the list; the candidates probe the filter, the hits join the list.

Results for odd input: a null URL or one without ``://`` has an empty host and
path and meets no rule; repeated rows are all returned; a null ``page_id`` is
kept; an empty list judges every page by ``default``; of equally long fitting
rules the one with the longer host wins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Bits of the filter for each listed key; a block has 8 words of 64 bits.
BITS_PER_KEY = 16
#: The filter and the list are broadcast only up to this many bytes; beyond, they are joined by a shuffle.
BROADCAST_BYTES = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    authority = F.coalesce(F.regexp_extract(rest, r"^[^/?#]*", 0), F.lit(""))
    after = rest.substr(F.length(authority) + 1, F.length(url))
    path = F.coalesce(F.regexp_extract(after, r"^[^?#]*", 0), F.lit(""))
    return F.translate(authority, UPPER, LOWER), path


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks).cast("long"))


def _masks(key: Column) -> list[Column]:
    """One bit in each of the eight words of the key's block."""
    h = F.xxhash64(F.lit(1), key)
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63).cast("long")).cast("int"))
            for i in range(8)]


def build_filter(keys: DataFrame, key: str, n_keys: int) -> tuple[DataFrame, int]:
    """(block, w0..w7) of the filter; only blocks that hold a key have a row."""
    n_blocks = max(1, -(-n_keys * BITS_PER_KEY // 512))
    words = keys.select(_block(F.col(key), n_blocks).alias("bf_block"),
                        *[m.alias(f"bf_w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return words.groupBy("bf_block").agg(*[F.bit_or(f"bf_w{i}").alias(f"bf_w{i}") for i in range(8)]), n_blocks


def probe(candidates: DataFrame, key: str, bloom: DataFrame, n_blocks: int) -> DataFrame:
    """The candidates whose eight bits are all set: every listed key, and few others."""
    small = n_blocks * 72 <= BROADCAST_BYTES
    joined = candidates.withColumn("bf_block", _block(F.col(key), n_blocks)).join(
        F.broadcast(bloom) if small else bloom, "bf_block")
    hit = F.lit(True)
    for i, m in enumerate(_masks(F.col(key))):
        hit = hit & (F.col(f"bf_w{i}").bitwiseAND(m) != 0)
    return joined.filter(hit).select(*candidates.columns)


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``pages`` (page_id, url) with host, path, rule and verdict. ``rules``:
    (host, path, verdict), of any size; a rule listed twice counts once, with
    the smaller verdict."""
    host, path = host_and_path(F.col("url"))
    base = pages.select("page_id", host.alias("host"), path.alias("path"))
    rules = (rules.filter(F.col("host").isNotNull() & F.col("path").isNotNull())
             .select(F.translate("host", UPPER, LOWER).alias("r_host"), F.col("path").alias("r_path"), F.col("verdict").alias("r_verdict"))
             .groupBy("r_host", "r_path").agg(F.min("r_verdict").alias("r_verdict"))
             .withColumn("r_key", F.concat("r_host", F.lit("|"), "r_path")))
    # the shapes of the list: few, whatever its length
    stats = rules.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("r_key") + 40), F.lit(0)).alias("bytes"),
                      F.collect_set(F.struct((F.length("r_host") - F.length(F.replace("r_host", F.lit("."), F.lit(""))) + 1).alias("labels"),
                                             F.length("r_path").alias("chars"))).alias("shapes")).first()
    shapes = sorted((s["labels"], s["chars"]) for s in stats["shapes"])
    if not shapes:
        return base.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    labels = F.length("host") - F.length(F.replace("host", F.lit("."), F.lit(""))) + 1
    keys = F.array_compact(F.array(*[
        F.when((labels >= n) & (F.length("path") >= c),
               F.concat(F.substring_index("host", ".", -n), F.lit("|"), F.substring("path", 1, c)))
        for n, c in shapes]))
    candidates = base.select("page_id", "host", "path", F.explode(F.array_distinct(keys)).alias("c_key"))
    bloom, n_blocks = build_filter(rules, "r_key", stats["n"])
    hits = probe(candidates, "c_key", bloom, n_blocks)
    listed = F.broadcast(rules) if stats["bytes"] <= BROADCAST_BYTES else rules
    best = (hits.join(listed, hits.c_key == F.col("r_key"))
            .groupBy("page_id", "host", "path")
            .agg(F.max(F.struct((F.length("r_host") + F.length("r_path")).alias("n"), F.length("r_host").alias("h"),
                                F.concat("r_host", "r_path").alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
            .select(F.col("page_id").alias("b_page"), F.col("host").alias("b_host"), F.col("path").alias("b_path"), "best"))
    out = base.join(best, base.page_id.eqNullSafe(F.col("b_page")) & (base.host == F.col("b_host"))
                    & (base.path == F.col("b_path")), "left")
    return out.select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                      F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
