"""Command line: the clean / load / aggregate jobs, the chained run, landing plan.

    python -m tripmart clean  --bronze-path RAW --lake LAKE [--incremental-col C]
    python -m tripmart load   --lake LAKE --zones-csv ZONES.csv [--progress latest-two]
    python -m tripmart agg    --lake LAKE
    python -m tripmart run    --bronze-path RAW --lake LAKE --zones-csv ZONES.csv
    python -m tripmart stream --bronze-path RAW --lake LAKE --zones-csv ZONES.csv
    python -m tripmart plan   --raw-root RAW [--year 2024] [--report-path OUT]
    python -m tripmart sql    --lake LAKE "SELECT ... FROM gold ..." [--output PATH]
    python -m tripmart compact --lake LAKE [--table silver --table gold ...]

Tables live under ``--lake`` or at explicit locations (``--silver-path``,
``--gold-path``, ``--agg-path``; the original jobs' names ``--silver_full_ref``,
``--gold_full_ref``, ``--agg_full_ref`` and ``--s3_taxi_zone_csv`` are accepted
as aliases, taking paths).  Paths may be any Hadoop-compatible URI.  Session
settings (master, shuffle partitions, checkpoint dir) come from spark-submit.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
from dataclasses import asdict

from .functions.quality import PICKUP
from .plans.pipeline import Lakehouse, refresh_agg, refresh_gold, refresh_silver, run_pipeline
from .plans.sql_surface import register_views
from .session import build_session
from .sources.bronze import raw_glob
from .sources.landing import (
    landed_months,
    landing_report,
    landing_status,
    month_plan,
    months_of_years,
    previous_month,
    write_landing_report,
)
from .sources.zones import read_zones_csv
from .streaming import ingest_available

TABLE_JOBS = ("clean", "load", "agg", "run", "stream", "sql", "compact")


def parse_args(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tripmart", description="Taxi trip lakehouse jobs")
    sub = parser.add_subparsers(dest="job", required=True)
    helps = {
        "clean": "bronze → silver: clean new raw trips (watermark; full load when empty)",
        "load": "silver → gold: enrich unseen silver commits and MERGE them on trip_id",
        "agg": "gold → monthly borough aggregate for the months gold rewrote",
        "run": "clean, load and agg in order (one scheduled run)",
        "stream": "ingest every not-yet-seen landed file (file stream, availableNow)",
        "sql": "run SQL over the views silver, gold and agg",
        "compact": "rewrite tables' live versions as single replace commits",
    }
    for job in TABLE_JOBS:
        p = sub.add_parser(job, help=helps[job])
        p.add_argument("--lake", help="root folder of the silver/gold/agg tables")
        p.add_argument("--silver-path", "--silver_full_ref", dest="silver_path")
        p.add_argument("--gold-path", "--gold_full_ref", dest="gold_path")
        p.add_argument("--agg-path", "--agg_full_ref", dest="agg_path")
        p.add_argument("--silver-grain", choices=["month", "day"], default="month")
        if job in ("clean", "run", "stream"):
            p.add_argument("--bronze-path", required=True, help="raw landing root (year=*/ files)")
        if job in ("load", "run", "stream"):
            p.add_argument(
                "--zones-csv", "--s3_taxi_zone_csv", dest="zones_csv", required=True,
                help="taxi zone lookup CSV (with header)",
            )
        if job in ("clean", "run"):
            p.add_argument("--incremental-col", default=PICKUP)
            p.add_argument("--lookback-days", type=int, help="also load late trips of so many days below the watermark")
        if job in ("load", "run"):
            p.add_argument("--on-duplicate", choices=["error", "insert", "dedupe"], default="error",
                           help="several new trips of one key: fail, insert the unmatched as a MERGE does, or keep the latest")
            p.add_argument("--single-precision", action="store_true", help="round distances and amounts to FLOAT")
            p.add_argument("--sync-deletes", action="store_true", help="after a full re-read, drop trips that silver no longer has")
        if job == "load":
            p.add_argument("--progress", choices=["consumer", "latest-two"], default="consumer")
        if job == "compact":
            p.add_argument("--table", action="append", choices=["silver", "gold", "agg"],
                           help="table(s) to compact (default: all with a location)")
        if job == "sql":
            p.add_argument("statement", help="SQL over the views silver, gold and agg")
            p.add_argument("--output", help="write the full result here as parquet")
            p.add_argument("--show", type=int, default=20, help="rows to print (a preview, not the result)")
    p = sub.add_parser("plan", help="months to land, which are already landed, run report")
    p.add_argument("--raw-root", required=True, help="raw landing root (year=*/ files)")
    p.add_argument("--year", type=int, help="plan all 12 months of this year (default: previous month)")
    p.add_argument("--prefix", default="raw/taxi", help="object key prefix of landed files")
    p.add_argument("--run-date", type=dt.date.fromisoformat, default=dt.date.today())
    p.add_argument("--report-path", help="write per-month statuses as JSON here (outside the raw root)")
    return parser.parse_args(argv)


def _lake(spark, args) -> Lakehouse:
    return Lakehouse.at(
        spark,
        args.lake,
        incremental_col=getattr(args, "incremental_col", PICKUP),
        silver_grain=args.silver_grain,
        silver_path=args.silver_path,
        gold_path=args.gold_path,
        agg_path=args.agg_path,
    )


def _gold_options(args) -> dict:
    return {"on_duplicate": args.on_duplicate, "single_precision": args.single_precision, "sync_deletes": args.sync_deletes}


def _plan(spark, args) -> list[dict]:
    if args.year is None:
        months = previous_month(spark, args.run_date)
    else:
        months = months_of_years(spark.createDataFrame([(args.year,)], "data_year int"))
    plan = month_plan(months, args.run_date, args.prefix)
    try:
        landed = landed_months(spark, raw_glob(args.raw_root))
    except Exception as exc:  # noqa: BLE001 - nothing landed yet
        if "PATH_NOT_FOUND" not in str(exc) and "does not exist" not in str(exc):
            raise
        landed = spark.createDataFrame([], "data_year int, data_month int")
    status = landing_status(plan, landed)
    if args.report_path:
        write_landing_report(status, args.report_path)
    return [r.asDict() for r in landing_report(status).collect()]


def main(argv=None, spark=None) -> None:
    """Run one job; a session passed in is used and left running."""
    args = parse_args(argv)
    own_session = spark is None
    if own_session:
        spark = build_session(app_name=f"tripmart-{args.job}")
    try:
        if args.job == "plan":
            results = _plan(spark, args)
        elif args.job == "compact":
            lake = _lake(spark, args)
            names = args.table or [n for n in ("silver", "gold", "agg") if getattr(lake, n) is not None]
            results = [{"table": n, "commit_id": getattr(lake, n).compact()} for n in names]
        elif args.job == "sql":
            lake = _lake(spark, args)
            register_views(lake)
            result = spark.sql(args.statement)
            if args.output:
                result.write.mode("overwrite").parquet(args.output)
            results = [r.asDict() for r in result.take(args.show)]
        elif args.job == "clean":
            results = [refresh_silver(spark, args.bronze_path, _lake(spark, args).silver, lookback_days=args.lookback_days)]
        elif args.job == "load":
            zones = read_zones_csv(spark, args.zones_csv)
            results = [refresh_gold(spark, _lake(spark, args), zones, progress=args.progress, **_gold_options(args))]
        elif args.job == "agg":
            results = [refresh_agg(spark, _lake(spark, args))]
        elif args.job == "run":
            zones = read_zones_csv(spark, args.zones_csv)
            options = {"lookback_days": args.lookback_days, **_gold_options(args)}
            results = run_pipeline(spark, args.bronze_path, _lake(spark, args), zones, **options)
        else:
            if not args.lake:
                raise SystemExit("stream needs --lake (its checkpoint lives there)")
            n = ingest_available(spark, args.bronze_path, args.lake, read_zones_csv(spark, args.zones_csv))
            results = [{"step": "stream", "batches": n}]
        for r in results:
            print(json.dumps(r if isinstance(r, dict) else asdict(r), default=str))
    finally:
        if own_session:
            spark.stop()


if __name__ == "__main__":
    main()
