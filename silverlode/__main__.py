"""Command line: ``spark-submit ... -m silverlode`` or ``python -m silverlode <step>``."""

from __future__ import annotations

import argparse
import datetime as dt

from silverlode.config import Settings
from silverlode.plans import checks, warehouse
from silverlode.session import get_session
from silverlode.sources import bronze
from silverlode.streaming.ingest import ingest_streams


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="silverlode")
    parser.add_argument("--root", required=True, help="warehouse folder")
    parser.add_argument("--as-of", type=dt.date.fromisoformat, help="date that ages and recency refer to (default: today)")
    steps = parser.add_subparsers(dest="step", required=True)
    ingest = steps.add_parser("ingest", help="load deliveries into bronze")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--system", choices=["crm", "erp"])
    ingest.add_argument("--mode", choices=["append", "overwrite", "stream"], default="append")
    build = steps.add_parser("build", help="build gold tables and marts")
    build.add_argument("--full", action="store_true", help="rebuild the fact instead of its lookback window")
    steps.add_parser("check", help="run all checks; fails on an error")
    steps.add_parser("freshness", help="age of every extract's newest load")
    compact = steps.add_parser("compact", help="copy bronze into fewer files")
    compact.add_argument("--target", required=True)
    args = parser.parse_args(argv)

    spark = get_session()
    settings = Settings(root=args.root, **({"as_of": args.as_of} if args.as_of else {}))
    lake = settings.layer("bronze")
    raw = warehouse.BronzeExtracts(spark, settings)
    if args.step == "ingest":
        if args.mode == "stream":
            loads = ingest_streams(spark, args.landing, lake, settings.layer("checkpoints"), args.system)
        else:
            loads = bronze.ingest_all(spark, args.landing, lake, args.system, args.mode)
        for load in loads:
            print(f"{load.table:<20} rows={load.row_count} rescued={load.rescued_row_count} files={load.file_count}")
        bronze.assert_loaded(loads)
    elif args.step == "build":
        for name in warehouse.build(spark, raw, settings, args.full):
            print(name)
    elif args.step == "check":
        stored = warehouse.open_gold(spark, settings)
        for r in warehouse.check(raw, stored, settings):
            print(f"{r['status']:<5} {r['table_name']}.{r['check_name']} {r['failures']}")
    elif args.step == "freshness":
        ages = checks.source_freshness(raw, settings)
        found = {name: df.first()["status"] if df else "error" for name, df in ages.items()}
        print(*(f"{status:<5} {name}" for name, status in found.items()), sep="\n")
        if "error" in found.values():
            raise SystemExit(1)
    elif args.step == "compact":
        print(*bronze.compact_bronze(spark, lake, args.target), sep="\n")


if __name__ == "__main__":
    main()
