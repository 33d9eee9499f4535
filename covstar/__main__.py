"""Command line for the jobs:

    python -m covstar load    --raw PATH [--format parquet|json|csv] --root ROOT [--mode initial|incremental]
                              [--overwrite] [--limit N] [--lookback-hours H]
    python -m covstar refresh --root ROOT
    python -m covstar zones   --raw PATH [--format ...] --out CSV_DIR
    python -m covstar load-events --events SF_DIR --root ROOT [...]   (shipped test tables)

The session comes from ``spark-submit`` / the environment (master, memory,
``spark.checkpoint.dir``); nothing is hard-coded here.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _raw(spark, args):
    if getattr(args, "events", None):
        from .sources.adapter import raw_from_dir
        return raw_from_dir(spark, args.events)
    from .sources.raw import read_measurements
    return read_measurements(spark, args.raw, args.format)


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="covstar")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("load", "load-events"):
        s = sub.add_parser(name)
        if name == "load":
            s.add_argument("--raw", required=True)
            s.add_argument("--format", default="parquet")
        else:
            s.add_argument("--events", required=True)
        s.add_argument("--root", required=True)
        s.add_argument("--mode", default="incremental", choices=["initial", "incremental"])
        s.add_argument("--overwrite", action="store_true")
        s.add_argument("--limit", type=int)
        s.add_argument("--lookback-hours", type=float)
    r = sub.add_parser("refresh")
    r.add_argument("--root", required=True)
    z = sub.add_parser("zones")
    z.add_argument("--raw", required=True)
    z.add_argument("--format", default="parquet")
    z.add_argument("--out", required=True)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"covstar-{args.cmd}").getOrCreate()
    if args.cmd in ("load", "load-events"):
        from .plans import etl
        lb = dt.timedelta(hours=args.lookback_hours) if args.lookback_hours else None
        out = etl.run(spark, _raw(spark, args), args.root, mode=args.mode, limit=args.limit,
                      overwrite=args.overwrite, lookback=lb)
    elif args.cmd == "refresh":
        from .plans import refresh
        out = refresh.refresh_all(spark, args.root)
    else:
        from .plans.zone_build import run_zone_build
        out = run_zone_build(_raw(spark, args), args.out)
    print(json.dumps(out, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
