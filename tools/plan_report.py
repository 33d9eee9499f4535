"""Write PLANS.md: the physical-plan shape of the main workloads.

    python tools/plan_report.py [sf_dir]

For each workload it records the exchanges (shuffles), join strategies,
aggregates and the scans with their partition filters, pushed filters and
read schema, taken from ``explain("formatted")`` of the lazy DataFrame.
"""

from __future__ import annotations

import re
import sys
import tempfile
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

KEEP = re.compile(r"^\(\d+\) (Scan|Exchange|BroadcastExchange|BroadcastHashJoin|SortMergeJoin|"
                  r"ShuffledHashJoin|BroadcastNestedLoopJoin|HashAggregate|SortAggregate|ObjectHashAggregate|"
                  r"TakeOrderedAndProject|Window|Sort |Generate|InMemoryTableScan)")
DETAIL = re.compile(r"^(PartitionFilters|PushedFilters|ReadSchema|Arguments|Join type|Keys|Functions):")


def summarize(df) -> list[str]:
    import io
    from contextlib import redirect_stdout
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n")[0].splitlines()                  # the operator tree
    out = ["```", *[h for h in head if h.strip()], "```", ""]
    keep = False
    for line in text.splitlines():
        if line.startswith("("):
            keep = bool(KEEP.match(line))
            if keep:
                out.append(f"- **{line.strip()}**")
        elif keep and DETAIL.match(line):
            val = line.split(":", 1)[1].strip()
            if val and val != "[]":
                out.append(f"  - {line.split(':', 1)[0]}: `{val[:220]}`")
    return out


def main(argv) -> None:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import functions as F

    from covstar import Warehouse, raw_from_dir
    from covstar import functions as X
    from covstar.operators import analytics as A
    from covstar.operators import layers as L
    from covstar.operators.clean import normalize
    from covstar.operators.maintenance import new_facts
    from covstar.operators.warehouse import accepted_rows, to_fact_rows
    from covstar.plans import etl, store
    from covstar.session import local_session

    scratch = tempfile.mkdtemp(prefix="covstar-plans-")
    spark = local_session(8, checkpoint_dir=f"{scratch}/ck")
    raw = raw_from_dir(spark, sf_dir)
    root = f"{scratch}/wh"
    first = raw.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp_ntz"))
    etl.run(spark, first, root, mode="initial")
    w = Warehouse.load(spark, root)

    # the incremental load's fact path, as the load job builds it
    wm = w.fact.agg(F.max("timestamp")).first()[0]
    batch = normalize(raw.filter(F.col("timestamp") > F.lit(wm)))
    stats = batch.agg(F.min("timestamp"), F.max("timestamp")).first()
    rows = batch.withColumn("source_id", F.col("id").cast("string")).withColumn("semana", X.week_partition("timestamp"))
    touched = [r[0] for r in batch.select(X.week_partition("timestamp")).distinct().collect()]
    unseen = new_facts(w.fact, rows, touched=touched, ts_range=(stats[0], stats[1]), existing_rows=0)
    load_rows = (to_fact_rows(accepted_rows(unseen), w.dims, w.sizes).repartitionByRange("semana", "timestamp")
                 .sortWithinPartitions("semana", "timestamp"))

    af = w.analytic_frame(date_from="2024-01-05", date_to="2024-01-09")
    cases = [
        ("Incremental load: anti join + dedupe + key resolution + weekly write", load_rows),
        ("Sliced KPI card on the stored warehouse (date, hour and operator slicers)",
         A.kpis(A.slice(af, date_from="2024-01-05", date_to="2024-01-09", hour_from="06:00",
                        hour_to="18:00", operador="ENTEL"))),
        ("Daily x operator statistics (aggregate on ids, names joined after)", w.daily_operator_stats()),
        ("Zone layer of a slice (aggregate, zone geometry broadcast)",
         A.zone_layer(A.slice(w.analytic_frame(), red="4G"), w.dims["dim_zonas"], w.sizes["dim_zonas"])),
        ("Device trails (global sort, range partitions split a hot device)", L.device_trails(w.analytic_frame())),
        ("Heat sample (exact hash cutoff, then top-n)", L.heat_layer(w.analytic_frame(), 2000)),
        ("Slicer domains (one scan, exploded pairs, distinct)", A.filter_domains(w.analytic_frame())),
    ]
    lines = ["# Physical plans of the main workloads", "",
             f"Generated by `tools/plan_report.py` on `{Path(sf_dir).name}` (local[8], AQE on). Each section",
             "shows the operator tree of `explain(\"formatted\")` and, for scans, joins, exchanges and",
             "aggregates, the filters and schemas that reach them. Exchanges are the shuffles.", ""]
    for title, df in cases:
        lines += [f"## {title}", ""] + summarize(df) + [""]
    (ROOT / "PLANS.md").write_text("\n".join(lines))
    print(f"wrote {ROOT / 'PLANS.md'}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
