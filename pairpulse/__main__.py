"""Command line for the jobs: ``python -m pairpulse <command> --landing <path> ...``"""

from __future__ import annotations

import argparse
import datetime as dt

from pairpulse.config import HISTORY_START, EngineConfig, outage_days
from pairpulse.functions.dates import Days
from pairpulse.plans.backfill import run_backfill, run_daily, run_refresh
from pairpulse.session import build_session
from pairpulse.sinks.extract import export_index_csv
from pairpulse.sinks.tables import Lake
from pairpulse.sources.landing import landing_strays
from pairpulse.streaming.incremental import load_landed

_DAY = dt.date.fromisoformat


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pairpulse")
    parser.add_argument("--prefix", default="", help="prefix of the database names")
    parser.add_argument("--wide-counts", action="store_true", help="publish counts as bigint")
    commands = parser.add_subparsers(dest="command", required=True)
    create = commands.add_parser("create", help="create databases and tables")
    daily = commands.add_parser("daily", help="load one day; yesterday by default")
    daily.add_argument("--day", type=_DAY)
    backfill = commands.add_parser("backfill", help="load a range of days in one go")
    backfill.add_argument("--start", type=_DAY, default=HISTORY_START)
    backfill.add_argument("--end", type=_DAY, help="first day not loaded; yesterday by default")
    stream = commands.add_parser("stream", help="load whatever has landed since the last call")
    stream.add_argument("--checkpoint", required=True)
    for command in (daily, backfill, stream):
        command.add_argument("--landing", required=True,
                             help="folder or glob; {day} in it stands for yyyyMMdd")
        command.add_argument("--archives", action="store_true", help="read zip files")
    refresh = commands.add_parser("refresh", help="recount months touched by late files")
    refresh.add_argument("--start", type=_DAY, required=True)
    refresh.add_argument("--end", type=_DAY, required=True)
    export = commands.add_parser("export", help="write the CSV extract")
    export.add_argument("--folder", required=True)
    strays = commands.add_parser("strays", help="count landed files that no load reads")
    strays.add_argument("--landing", required=True)
    for command in (create, daily, backfill, stream, refresh, export):
        command.add_argument("--root", help="folder of the tables, for a catalog that does not "
                                            "last: what earlier processes published there is found again")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session()
    cfg = EngineConfig(measure_type="bigint" if args.wide_counts else "int")
    lake = Lake(args.prefix, cfg)
    today = dt.date.today()
    if args.command == "create":
        lake.create(spark, args.root)
        return
    if getattr(args, "root", None):
        lake.attach(spark, args.root)
    if args.command == "strays":
        print("files without a date in their name:", landing_strays(spark, args.landing).count())
    elif args.command == "daily":
        print("months built:", run_daily(spark, lake, args.landing, args.day, args.archives))
    elif args.command == "backfill":
        end = args.end or today - dt.timedelta(days=1)
        print("months built:", run_backfill(spark, lake, args.landing, args.start, end,
                                            outage_days(), args.archives))
    elif args.command == "stream":
        load_landed(spark, lake, args.landing, args.checkpoint, args.archives).awaitTermination()
    elif args.command == "refresh":
        print("months built:", run_refresh(spark, lake, Days(args.start, args.end)))
    else:
        print(export_index_csv(lake.gold.read(spark), args.folder, today))


if __name__ == "__main__":
    main()
