"""Command line: ``python -m tripforge <command>`` (spark-submit friendly).

    run      --landing ROOT --out ROOT (--month M | --start M --end M) [--fail-fast]
             [--min-trip-duration-min X --max-trip-duration-min X --max-trip-speed-mph X
              --min-fare-amount X --min-passenger-count X]
    ingest   --landing ROOT --manifest PATH (--month M | --start M --end M) [--force]
    profile  --input PATH [--out PATH]

Arguments only; every command is one of the library's Spark jobs.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from tripforge.config import Thresholds


def _months(args) -> tuple[str, str]:
    if args.month:
        return args.month, args.month
    if not (args.start and args.end):
        raise SystemExit("give --month or both --start and --end")
    return args.start, args.end


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="tripforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("run", "ingest"):
        s = sub.add_parser(name)
        s.add_argument("--landing", required=True)
        s.add_argument("--month")
        s.add_argument("--start")
        s.add_argument("--end")
        s.add_argument("--taxi-type", default="yellow")
        if name == "run":
            s.add_argument("--out", required=True)
            s.add_argument("--fail-fast", action="store_true")
            s.add_argument("--versioned", action="store_true", help="publish as a snapshot (sources/snapshots.py)")
            # outlier thresholds (the reference reads these from its settings)
            d = Thresholds()
            s.add_argument("--min-trip-duration-min", type=float, default=d.min_trip_duration_min)
            s.add_argument("--max-trip-duration-min", type=float, default=d.max_trip_duration_min)
            s.add_argument("--max-trip-speed-mph", type=float, default=d.max_trip_speed_mph)
            s.add_argument("--min-fare-amount", type=float, default=d.min_fare_amount)
            s.add_argument("--min-passenger-count", type=float, default=d.min_passenger_count)
        else:
            s.add_argument("--manifest", required=True)
            s.add_argument("--force", action="store_true")
    pr = sub.add_parser("profile")
    pr.add_argument("--input", required=True)
    pr.add_argument("--out")
    args = p.parse_args(argv)

    from tripforge.session import build_session
    spark = build_session()
    if args.cmd == "run":
        from tripforge.operators.reports import month_overview
        from tripforge.plans.pipeline import run_range
        start, end = _months(args)
        thresholds = Thresholds(args.min_trip_duration_min, args.max_trip_duration_min,
                                args.max_trip_speed_mph, args.min_fare_amount,
                                args.min_passenger_count)
        res = run_range(spark, args.landing, args.out, start, end, thresholds=thresholds,
                        fail_fast=args.fail_fast, versioned=args.versioned, taxi_type=args.taxi_type)
        if res is None:
            print("no months processed", file=sys.stderr)
            return 1
        month_overview(res.months).orderBy("file_month").show(truncate=False)
    elif args.cmd == "ingest":
        from tripforge.sources import landing as L
        start, end = _months(args)
        req = L.month_range(spark, start, end).withColumn("taxi_type", F.lit(args.taxi_type))
        plan = L.ingest(spark, args.landing, args.manifest, req, force=args.force)
        L.ingest_totals(plan).show(truncate=False)
    else:
        from tripforge.operators.profile import profile
        from tripforge.sources.sinks import write_report
        prof = profile(spark.read.parquet(args.input))
        if args.out:
            write_report(prof, args.out)
        prof.orderBy("ordinal").show(200, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
