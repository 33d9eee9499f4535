"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from covstar.session import checkpoint_dir

REPO = str(Path(__file__).resolve().parents[2])


def on_workers(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it
    (local runs and shared installs; a cluster ships it with ``--py-files``)."""
    env = spark.sparkContext.environment
    if REPO not in env.get("PYTHONPATH", ""):
        env["PYTHONPATH"] = ":".join(x for x in (REPO, env.get("PYTHONPATH", "")) if x)


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a folder of the
    session's warehouse where that setting is unset (tests, local runs only)."""
    d = checkpoint_dir(spark)
    if d is None:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
        d = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm_checkpoints"
        spark.sparkContext.setCheckpointDir(d)
        d = spark.sparkContext.getCheckpointDir()
    return d.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the
    lineage, survives lost executors and gives the planner real sizes."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_workers(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(spark: SparkSession, per_core: int = 2) -> int:
    """Partitions for a shuffle whose tasks run Python work: the session's
    shuffle partitions, and at least ``per_core`` for each core."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")),
               per_core * spark.sparkContext.defaultParallelism)


def with_text_ids(docs: DataFrame) -> DataFrame:
    """doc_id (as text: whole numbers with nulls are no numbers in pandas) and text."""
    return docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")


def with_long_ids(rows: DataFrame) -> DataFrame:
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def sample_ids(rows: DataFrame, group: str, size: int) -> dict:
    """id -> group of the ``size`` rows of each group with the smallest hashes of
    their ``doc_id``. The rows are counted by group and hash range (4,096 of
    them), and only those up to the range where ``size`` is reached are read:
    no task sees a whole group. ``rows`` must have few groups."""
    part = F.shiftrightunsigned(F.xxhash64("doc_id"), 52)
    counts = rows.groupBy(F.col(group).alias("g"), part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    upto, last = {}, {}
    for r in sorted(counts, key=lambda r: r["part"]):
        if upto.get(r["g"], 0) < size:
            upto[r["g"]] = upto.get(r["g"], 0) + r["n"]
            last[r["g"]] = r["part"]
    bounds = rows.sparkSession.createDataFrame(
        [(g, int(p)) for g, p in last.items()], T.StructType([T.StructField("si_group", rows.schema[group].dataType), T.StructField("si_part", T.LongType())]))
    near = rows.join(F.broadcast(bounds), (F.col(group) == F.col("si_group")) & (part <= F.col("si_part")), "left_semi")
    found = near.select(F.col(group).alias("g"), "doc_id", F.xxhash64("doc_id").bitwiseXOR(F.lit(-1 << 63)).alias("h")).distinct().collect()
    taken: dict = {}
    out = {}
    for r in sorted(found, key=lambda r: (r["h"], r["doc_id"])):
        if taken.get(r["g"], 0) < size:
            taken[r["g"]] = taken.get(r["g"], 0) + 1
            out[r["doc_id"]] = r["g"]
    return out


def crc_mod(col: str, mod: int):
    """``crc32`` of the id written as text, modulo ``mod`` (a null id gives null)."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(mod)
