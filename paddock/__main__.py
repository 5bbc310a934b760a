"""Command line: ``python -m paddock --lake PATH [options]`` (or through spark-submit).

Stages: optional archive import, silver refresh of the selected sessions,
gold refresh.  ``--incremental`` processes only bronze files that arrived since
the previous run instead of a selection.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from paddock.plans import medallion
from paddock.session import build_session


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="paddock", description="session analytics on Spark")
    p.add_argument("--lake", required=True, help="root folder of bronze/silver/gold (shared file system)")
    p.add_argument("--import-archive", help="folder of <kind>_checkpoint_<year>_r<round>[_<R|Q>].parquet files")
    p.add_argument("--seasons", type=int, nargs="*", help="seasons to refresh (default: all found)")
    p.add_argument("--resume-year", type=int, help="only seasons from this one on")
    p.add_argument("--rounds", type=int, nargs="*", help="rounds to refresh")
    p.add_argument("--sessions", nargs="*", choices=["R", "Q"], help="session types to refresh")
    p.add_argument("--strict", action="store_true", help="fail if a requested season has no bronze files")
    p.add_argument("--on-duplicate", choices=["dedup", "fail"], default="dedup")
    p.add_argument("--gold", choices=["upsert", "rebuild", "skip"], default="upsert")
    p.add_argument("--as-of", type=dt.date.fromisoformat, help="leave out events dated later in the calendar (YYYY-MM-DD)")
    p.add_argument("--calendar", help="Parquet table of events: year, round, event_date (for --as-of)")
    p.add_argument("--gate", action="store_true", help="publish the run as an epoch only if the contract's metrics hold")
    p.add_argument("--incremental", action="store_true", help="only files new since the last run")
    p.add_argument("--event-log", help="folder for Spark's event log (stage and task timings)")
    args = p.parse_args(argv)
    if (args.as_of is None) != (args.calendar is None):
        p.error("--as-of and --calendar go together")
    return args


def main(argv=None, spark=None) -> int:
    """Run the stages; a given ``spark`` session is used and left running."""
    args = parse_args(argv)
    own_session = spark is None
    spark = spark or build_session(event_log_dir=args.event_log)
    lake = medallion.Layout(args.lake.rstrip("/"))
    report: dict = {}
    if args.import_archive:
        report["import"] = medallion.import_archive(spark, args.import_archive, lake)
    from paddock.session import size_for_input
    from paddock.sources import bronze, tables

    if tables.path_exists(spark, lake.bronze):
        report["shuffle_partitions"] = size_for_input(spark, bronze.total_bytes(spark, lake.bronze))
    if args.incremental:
        from paddock.streaming.incremental import run_incremental
        run_incremental(spark, lake, with_gold=args.gold != "skip", on_duplicate=args.on_duplicate)
        report["incremental"] = "done"
    else:
        sessions = medallion.select_sessions(spark, lake, args.seasons, args.rounds, args.sessions,
                                             strict=args.strict, resume_year=args.resume_year, as_of=args.as_of,
                                             calendar=spark.read.parquet(args.calendar) if args.calendar else None)
        report["sessions"] = len(sessions)
        if sessions:
            report["silver"] = medallion.run_silver(spark, lake, sessions, on_duplicate=args.on_duplicate)
        if args.gold != "skip":
            report["gold_versions"] = medallion.run_gold(spark, lake, mode=args.gold)
            report["epoch"] = medallion.publish_epoch(spark, lake, gate=args.gate)
    if args.gold != "skip":
        report["quality"] = medallion.contract_metrics(spark, lake)
    print(json.dumps(report, default=str))
    if own_session:
        spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
