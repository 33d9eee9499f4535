"""Warehouse storage on plain parquet (S6, K7, K8 snapshots, K10 control).

Layout under a warehouse ``root`` (a shared filesystem / object store path):

    <root>/_control/commits/       which of the directories below count (``plans.commits``)
    <root>/_control/etl_control/   append-only run log (K10)
    <root>/<dimension>/v=<n>/      one immutable snapshot per version
    <root>/dim_zonas_mas/run_id=<id>/   zone increments of one load (K2)
    <root>/<aggregate>/v=<n>/      materialised aggregates (K8)
    <root>/_partials/<aggregate>/refresh=<n>/   mergeable states of the weeks that a refresh read (K8)
    <root>/_quarantine/run_id=<id>/     rows that the fact cannot take
    <root>/fact_mediciones/run_id=<id>/semana=<yyyy-mm-dd>/   weekly partitions of one load

A load writes new directories only: a snapshot per changed table, its facts, its
quarantined rows and its zone increments under its own run id. One commit then
makes all of it current together. Readers take the directories that the commits
name, so a load that fails at any point before leaves the warehouse as it was,
and an overwrite is a commit that the runs before it no longer count.
"""

from __future__ import annotations

import json
import random
import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import commits

FACT = "fact_mediciones"

FACT_SCHEMA = T.StructType([
    T.StructField("medicion_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("tiempo_id", T.IntegerType()),
    T.StructField("hora_id", T.IntegerType()),
    T.StructField("dispositivo_id", T.IntegerType()),
    T.StructField("operador_id", T.IntegerType()),
    T.StructField("red_id", T.IntegerType()),
    T.StructField("calidad_id", T.IntegerType()),
    T.StructField("zona_id", T.IntegerType()),
    T.StructField("zona_altitud", T.StringType()),
    T.StructField("medida_senal", T.DecimalType(10, 2)),
    T.StructField("medida_velocidad", T.DecimalType(10, 2)),
    T.StructField("medida_altitud", T.DecimalType(10, 2)),
    T.StructField("medida_bateria", T.DecimalType(5, 2)),
    T.StructField("latitude", T.DecimalType(10, 6)),
    T.StructField("longitude", T.DecimalType(10, 6)),
    T.StructField("etl_loaded_at", T.TimestampType()),
    T.StructField("source_id", T.StringType()),
    T.StructField("semana", T.StringType()),
])

FACT_READ_SCHEMA = T.StructType([*FACT_SCHEMA.fields, T.StructField("run_id", T.StringType())])

ZONES_MORE = "dim_zonas_mas"
CONTROL_SCHEMA = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("run_id", T.StringType()),
    T.StructField("mode", T.StringType()),
    T.StructField("batch_id", T.LongType()),
    T.StructField("last_extracted_at", T.TimestampNTZType()),
    T.StructField("last_loaded_at", T.TimestampType()),
    T.StructField("records_processed", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("error_message", T.StringType()),
    T.StructField("updated_at", T.TimestampType()),
])


def _path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _try_read(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The table at ``path``, ``None`` where nothing is stored there yet."""
    try:
        r = spark.read
        return (r if schema is None else r.schema(schema)).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def current_version(spark: SparkSession, root: str, table: str) -> int | None:
    return current_versions(spark, root).get(table)


def current_versions(spark: SparkSession, root: str) -> dict[str, int]:
    """Current version of every table."""
    return dict(commits.state(spark, root).tables)


def table_path(root: str, table: str, version: int) -> str:
    return _path(root, table, f"v={version:06d}")


def new_version() -> int:
    """A version number that grows with time and that no other writer draws: two
    loads racing from one state never write into one directory."""
    return time.time_ns() // 1000 * 1000 + random.randrange(1000)


def read_version(spark: SparkSession, root: str, table: str, version: int) -> DataFrame:
    return spark.read.parquet(table_path(root, table, version))


ROWS_PER_FILE = 1_000_000


def files_for(rows: int | None) -> int | None:
    """Output files for a table of ``rows`` rows: one per million rows, so a
    small dimension is one file and a large one is written by many tasks."""
    if rows is None:
        return None
    return max(1, -(-int(rows) // ROWS_PER_FILE))


def write_version(df: DataFrame, root: str, table: str, version: int, coalesce: int | None = None) -> None:
    """Write a snapshot directory that is not current until recorded."""
    out = df.coalesce(coalesce) if coalesce else df
    out.write.mode("overwrite").parquet(table_path(root, table, version))


def record_versions(spark: SparkSession, root: str, written: dict[str, int]) -> None:
    """Make written snapshots current, all in one commit."""
    if written:
        commits.commit(spark, root, commits.state(spark, root), {"kind": "tables", "tables": written})


def fact_paths(root: str, live: dict[str, list[str]], weeks: list[str] | None = None) -> list[str]:
    """The directories that hold the facts, of some weeks only if named."""
    return [_path(root, FACT, f"run_id={r}", f"semana={w}") for w in sorted(live) if weeks is None or w in weeks
            for r in live[w]]


def read_facts(spark: SparkSession, root: str, st: commits.State, weeks: list[str] | None = None) -> DataFrame | None:
    """The facts of a state; only the named directories are listed."""
    if st.facts is None:
        return None
    paths = fact_paths(root, st.facts, weeks)
    if not paths:
        return spark.createDataFrame([], FACT_SCHEMA)
    return (spark.read.schema(FACT_READ_SCHEMA).option("basePath", _path(root, FACT)).parquet(*paths).drop("run_id"))


def read_zones(spark: SparkSession, root: str, st: commits.State) -> DataFrame | None:
    """The zone dimension: its snapshot and the increments of the loads since
    (new cells whole, known cells as counts to add), folded by zone."""
    v = st.tables.get("dim_zonas")
    if v is None:
        return None
    base = read_version(spark, root, "dim_zonas", v)
    if not st.zone_runs:
        return base
    more = spark.read.schema(base.schema).parquet(*[_path(root, ZONES_MORE, f"run_id={r}") for r in st.zone_runs])
    rest = [c for c in base.columns if c not in ("zona_id", "total_mediciones")]
    return (base.unionByName(more).groupBy("zona_id")
            .agg(F.sum("total_mediciones").alias("total_mediciones"), *[F.max(c).alias(c) for c in rest])
            .select(*base.columns))


def write_zone_increment(df: DataFrame, root: str, run_id: str) -> None:
    df.coalesce(1).write.mode("overwrite").parquet(_path(root, ZONES_MORE, f"run_id={run_id}"))


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Current form of a table, the fact table included; ``None`` if absent."""
    st = commits.state(spark, root)
    if table == FACT:
        return read_facts(spark, root, st)
    if table == "dim_zonas":
        return read_zones(spark, root, st)
    v = st.tables.get(table)
    return None if v is None else read_version(spark, root, table, v)


def append_facts(df: DataFrame, root: str, run_id: str) -> None:
    """K3 sink: the facts of one load in weekly partitions under its run id;
    they count once the load is recorded. Rows are range-partitioned on time: a
    week holding most of the rows is split across many writer tasks instead of
    one, each task writes few weeks, and every file is sorted by time, so
    parquet row-group min/max statistics prune time ranges like a block-range
    index."""
    out = df.repartitionByRange("semana", "timestamp").sortWithinPartitions("semana", "timestamp")
    # a folder of its own for each run: writers that race share no staging folder
    out.write.mode("append").partitionBy("semana").parquet(_path(root, FACT, f"run_id={run_id}"))


def write_quarantine(df: DataFrame, root: str, run_id: str) -> None:
    """Rows the fact cannot take, kept with their reason; they count once their run is committed."""
    df.write.mode("overwrite").parquet(_path(root, "_quarantine", f"run_id={run_id}"))


def read_quarantine(spark: SparkSession, root: str, st: commits.State | None = None) -> DataFrame | None:
    st = commits.state(spark, root) if st is None else st
    if not st.quarantine:
        return None
    return spark.read.parquet(*[_path(root, "_quarantine", f"run_id={r}") for r in st.quarantine])


CONTROL = ("_control", "etl_control")


def _control_read(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.schema(CONTROL_SCHEMA).json(_path(root, *CONTROL))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def control_log(spark: SparkSession, root: str) -> DataFrame | None:
    log = _control_read(spark, root)
    return None if log is None else log.distinct()      # rows that a fold left twice count once


def record_run(spark: SparkSession, root: str, row: dict) -> None:
    """Append one row to the control log, a small JSON file of its own."""
    vals = {f.name: v.isoformat() if hasattr(v, "isoformat") else v
            for f in CONTROL_SCHEMA.fields if (v := row.get(f.name)) is not None}
    commits.create_if_absent(spark, _path(root, *CONTROL, f"{uuid.uuid4().hex}.json"), json.dumps(vals))


def control_state(spark: SparkSession, root: str) -> DataFrame | None:
    """The last control row of each table: IDLE before the first run, RUNNING
    while one loads (or after one was killed), then OK or ERROR."""
    log = control_log(spark, root)
    if log is None:
        return None
    rest = [F.col(c) for c in log.columns if c not in ("table_name", "updated_at")]
    last = log.groupBy("table_name").agg(F.max(F.struct("updated_at", *rest)).alias("last"))
    return last.select("table_name", *[F.col(f"last.{c}").alias(c) for c in log.columns if c != "table_name"])


def fold_control_log(spark: SparkSession, root: str) -> int:
    """One file in place of the many small ones of the control log. A crash after
    the write leaves rows twice, which readers count once."""
    log = _control_read(spark, root)
    files = [] if log is None else log.inputFiles()
    if len(files) < 2:
        return 0
    spark.read.schema(CONTROL_SCHEMA).json(files).distinct().coalesce(1).write.mode("append").json(_path(root, *CONTROL))
    for f in files:
        fs, p = commits._fs(spark, f)
        fs.delete(p, False)
    return len(files)


def export_csv(df: DataFrame, path: str, single_file: bool = False, rows: int | None = None) -> None:
    """K7: CSV with header, no index. ``single_file`` only for small tables
    (a dimension): one file per million rows, counted here where the caller has
    no count; facts are written as a directory of parts."""
    out = df.coalesce(files_for(df.count() if rows is None else rows)) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def read_dim_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """Read an exported dimension CSV with a declared schema."""
    return spark.read.option("header", True).schema(schema).csv(path)
