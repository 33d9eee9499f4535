"""Repair of stored early facts (J7, P26): the weeks that hold facts with a key 0
are rewritten with the members that have come since, in one commit."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..operators.clean import normalize
from ..operators.early import is_early, repaired
from ..operators.warehouse import Warehouse
from . import commits, store


def repair_early_facts(spark: SparkSession, root: str, raw: DataFrame, grid_size: float = C.GRID_SIZE_ETL,
                       grid_mode: str = "trunc") -> dict:
    """Resolve the 0 keys of the stored facts against the current dimensions.
    Reads and rewrites only the weeks that hold such facts."""
    st = commits.state(spark, root)
    facts = store.read_facts(spark, root, st)
    early = facts.filter(is_early()).groupBy("semana").agg(F.count(F.lit(1)).alias("n"), F.min("timestamp").alias("a"),
                                                          F.max("timestamp").alias("b")).collect()      # one row per week
    if not early:
        return {"weeks": 0, "early": 0}
    weeks = sorted(r["semana"] for r in early)
    w = Warehouse.load(spark, root)
    norm = normalize(raw, grid_size, grid_mode)
    kind = norm.schema["timestamp"].dataType
    norm = norm.filter(F.col("timestamp").between(F.lit(min(r["a"] for r in early)).cast(kind), F.lit(max(r["b"] for r in early)).cast(kind)))
    run_id = "r" + uuid.uuid4().hex[:11]
    store.append_facts(repaired(store.read_facts(spark, root, st, weeks), norm, w.dims, w.sizes), root, run_id)
    commits.commit(spark, root, st, {"kind": "repair", "run": run_id, "weeks": weeks})
    return {"weeks": len(weeks), "early": sum(r["n"] for r in early)}
