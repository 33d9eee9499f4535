"""Session helpers: a local session for tests/bench, and the shared
checkpoint folder read from the session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "covstar", checkpoint_dir: str | None = None,
                  shuffle_partitions: int | None = None, event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the benchmark: UI off, AQE on, UTC."""
    b = (SparkSession.builder.master(f"local[{cores}]").appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.driver.memory", os.environ.get("COVSTAR_DRIVER_MEMORY", "8g"))
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8)))
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    compiled_stages(spark)
    if checkpoint_dir and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_dir)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def session_key(spark: SparkSession) -> str:
    """A key identifying the running application (for per-session caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or str(id(spark))


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints (``spark.checkpoint.dir``
    or a directory already set on the context), else ``None``."""
    sc = _context(spark)
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if d and sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir()
    return d or None


#: HotSpot compiles no method above this size of bytecode; Spark's own limit lets such methods through.
HUGE_METHOD_CONF, HUGE_METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def compiled_stages(spark: SparkSession) -> None:
    """Plans whose generated method the JVM would only interpret run as single
    operators (whose code Spark splits). A limit the session names is kept."""
    if spark.conf.get(HUGE_METHOD_CONF) == "65535":
        spark.conf.set(HUGE_METHOD_CONF, HUGE_METHOD_BYTES)


def cut_lineage(df):
    """Reliable checkpoint into the shared checkpoint folder (survives
    executor loss). Without a configured folder the plan is returned as is:
    no machine-local fallback is ever used."""
    if checkpoint_dir(df.sparkSession) is None:
        return df
    return df.checkpoint(eager=True)


def cluster_conf(executors: int = 1000, cores_per_executor: int = 8) -> dict[str, str]:
    """Session settings for a large cluster (pass to ``spark-submit --conf``
    or ``SparkSession.builder.config``). Shuffle partitions start high and AQE
    coalesces them to ~256 MB each; file splits are 256 MB; skewed join
    partitions are split; only counted, small dimensions are broadcast by
    the library, and Spark's own threshold stays moderate."""
    slots = executors * cores_per_executor
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.shuffle.partitions": str(max(2000, 4 * slots)),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.session.timeZone": "UTC",
        "covstar.broadcast.maxBytes": str(128 * 1024 * 1024),
        HUGE_METHOD_CONF: HUGE_METHOD_BYTES,
    }
