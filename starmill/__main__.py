"""Run a job from the command line: ``python -m starmill JOB ...`` or through spark-submit.

    lake         --songs DIR --log DIR --out DIR
    warehouse    --songs DIR --log DIR --out DIR [--database NAME]
    scheduled    --songs DIR --log DIR --out DIR [--database NAME] [--fact-mode MODE]
                 [--context NAME=VALUE ...]   fills {NAME} in the paths
    increment    --songs DIR --log DIR --out DIR
    history      --exports DIR --out DIR
    immigration  --records DIR --demographics FILE --temperatures FILE --airports FILE
                 --codes FILE --out DIR --reports DIR [--format NAME] [--month-file NAME]
                 [--option NAME=VALUE ...] [--strict] [--nation NAME]
    explore      the same inputs as immigration and --out DIR, which gets a folder of JSON lines
                 for every profile and check
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from starmill.plans import exploration, immigration, listening, music
from starmill.session import use_utc
from starmill.sources import stage_raw

SIDE_FILES = ("demographics", "temperatures", "airports", "codes")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(
        "starmill", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    jobs = parser.add_subparsers(dest="job", required=True)
    for name in ("lake", "warehouse", "scheduled", "increment"):
        job = jobs.add_parser(name)
        for option in ("--songs", "--log", "--out"):
            job.add_argument(option, required=True)
        job.add_argument("--allowance", type=int, default=0, help="bad records to put up with")
        if name in ("warehouse", "scheduled"):
            job.add_argument("--database", default="default")
        if name == "scheduled":
            job.add_argument("--fact-mode", default="append", choices=["append", "insert_ignore", "once"])
            job.add_argument("--context", nargs="*", default=[], metavar="NAME=VALUE")
    job = jobs.add_parser("history")
    for option in ("--exports", "--out"):
        job.add_argument(option, required=True)
    job.add_argument("--allowance", type=int, default=0, help="bad records to put up with")
    for name, outputs in (("immigration", ["out", "reports"]), ("explore", ["out"])):
        job = jobs.add_parser(name)
        for option in ("records", *SIDE_FILES, *outputs):
            job.add_argument(f"--{option}", required=True)
        job.add_argument("--format", default="parquet")
        job.add_argument("--option", nargs="*", default=[], metavar="NAME=VALUE")
        job.add_argument("--month-file", help="read this file of the folder only, not all months")
        job.add_argument("--strict", action="store_true")
        if name == "immigration":
            job.add_argument("--nation", default="ICELAND", help="of the third report")
    return parser


def _pairs(texts: Sequence[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def _inputs(spark: SparkSession, args: argparse.Namespace) -> immigration.Inputs:
    records = immigration.read_immigration(
        spark, args.records, args.format, args.month_file, _pairs(args.option)
    )
    if args.format not in ("parquet", "orc"):
        records = stage_raw(records, "immigration")  # parsed once for all tables
    paths = {name: getattr(args, name) for name in SIDE_FILES}
    return immigration.read_inputs(spark, records, paths, args.strict)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.job == "lake":
        music.build_lake(spark, args.songs, args.log, args.out, allowance=args.allowance)
    elif args.job == "warehouse":
        music.load_warehouse(
            spark, args.songs, args.log, args.out, args.database, allowance=args.allowance
        )
    elif args.job == "scheduled":
        report = music.run_scheduled(
            spark,
            args.songs,
            args.log,
            args.out,
            args.database,
            fact_mode=args.fact_mode,
            allowance=args.allowance,
            **_pairs(args.context),
        )
        for row in report.collect():  # one row per check
            print(*row)
    elif args.job == "increment":
        music.run_increment(spark, args.songs, args.log, args.out, allowance=args.allowance)
    elif args.job == "history":
        listening.build_history(spark, args.exports, args.out, args.allowance)
    elif args.job == "immigration":
        tables = immigration.build_immigration(spark, _inputs(spark, args), args.out, args.strict)
        immigration.save_reports(tables, args.reports, nation=args.nation)
    else:
        raw = _inputs(spark, args)
        frames = exploration.explore(
            raw.demographics, raw.airports, raw.temperatures, raw.immigration
        )
        for title, frame in frames.items():
            frame.write.mode("overwrite").json(f"{args.out}/{title.replace(' ', '_')}")


def main(argv: Sequence[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    run(use_utc(SparkSession.builder.appName(f"starmill {args.job}").getOrCreate()), args)


if __name__ == "__main__":
    main(sys.argv[1:])
