"""Command line: run report slots, check that a slot's report exists, list
stale reports, clean up after runs that broke off.

    python -m gatewatch run A --date 2024-01-12 --tables parquet:/data/toll --store /data/reports --list ASIA
    python -m gatewatch run --from 2024-01-08 --to 2024-01-12 --tables ... --store /data/reports --list ASIA
    python -m gatewatch run --from 2024-01-08 --to 2024-01-12 --only-open ...
    python -m gatewatch stale --from 2024-01-08 --to 2024-01-12 --store /data/reports --list ASIA
    python -m gatewatch clean --store /data/reports --list ASIA --older-than-hours 24
    python -m gatewatch check A --date 2024-01-12 --store /data/reports --list ASIA [--rerun --tables ...]

Slots are given by code (A, B, C, D) or name (DAY, NIGHT, DAY-1, AFTERNOON).
``--tables`` is ``parquet:ROOT`` (one folder per logical table), a database
URL (``jdbc:...``, with ``--jdbc-options FILE.json``: table names, user, number
of parallel queries) or ``fixture:SF_DIR`` (the fixture views over the driver
tables). ``run --from --to`` runs all slots of the dates in dependency order,
with a slot only that one, with ``--only-open`` only what is missing or stale.
``check`` exits with status 1 while the report is missing, ``stale`` while any is
stale.
"""

from __future__ import annotations

import argparse
import sys
from datetime import date, timedelta

from pyspark.sql import SparkSession

from gatewatch.plans.backfill import reports_between, rerun, run_reports, stale_nodes
from gatewatch.plans.reports import build_report
from gatewatch.plans.slots import object_name, slot
from gatewatch.session import RECOMMENDED_CONF, ensure_checkpoint_dir
from gatewatch.sources.fixtures import fixture_tables
from gatewatch.sources.jdbc import tables_from_jdbc_file
from gatewatch.sources.report_store import ReportStore
from gatewatch.sources.tables import TollTables, tables_from_parquet


def _tables(spark: SparkSession, spec: str, day_column: str | None, jdbc_options: str | None = None) -> TollTables:
    kind, _, where = spec.partition(":")
    if kind == "jdbc":
        return tables_from_jdbc_file(spark, spec, jdbc_options)
    if kind == "parquet":
        return tables_from_parquet(spark, where, day_column)
    if kind == "fixture":
        return fixture_tables(spark, where)
    raise SystemExit(f"unknown --tables {spec!r}: use parquet:ROOT, jdbc:URL or fixture:SF_DIR")


def _session() -> SparkSession:
    # A batch job needs no web UI (and should open no port of its own).
    builder = SparkSession.builder.appName("gatewatch").config("spark.ui.enabled", "false")
    for key, value in RECOMMENDED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="gatewatch")
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "check", "stale", "clean"):
        c = sub.add_parser(name)
        c.add_argument("--store", required=True)
        c.add_argument("--list", dest="list_name", required=True)
        if name == "clean":
            c.add_argument("--older-than-hours", type=float, default=24)
            continue
        if name in ("run", "stale"):
            c.add_argument("--from", dest="first", type=date.fromisoformat)
            c.add_argument("--to", dest="last", type=date.fromisoformat)
        if name == "stale":
            continue
        c.add_argument("slot", nargs="?" if name == "run" else None)
        c.add_argument("--date", type=date.fromisoformat, default=date.today())
        c.add_argument("--tables")
        c.add_argument("--day-column")
        c.add_argument("--jdbc-options", help="JSON file: table_names, properties, num_partitions, time_column, split_columns, hash_sql")
        c.add_argument("--url-prefix", default="")
        if name == "check":
            c.add_argument("--rerun", action="store_true", help="run the slot once if its report is missing")
        else:
            c.add_argument("--only-open", action="store_true", help="run only what is missing or stale in the date range")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = _parser()
    args = parser.parse_args(argv)
    ranged = getattr(args, "first", None) is not None
    if args.command in ("run", "stale") and ranged != (args.last is not None):
        parser.error("--from and --to go together")
    if args.command == "stale" and not ranged:
        parser.error("stale needs --from and --to")
    if args.command == "run" and not ranged and (args.slot is None or args.only_open):
        parser.error("run needs a slot, or --from and --to")
    spark = spark or _session()
    store = ReportStore(spark, args.store)

    if args.command == "clean":
        for path in store.clean(timedelta(hours=args.older_than_hours)):
            print(f"deleted: {path}")
        return 0
    if args.command == "stale":
        found = stale_nodes(store, args.list_name, args.first, args.last)
        for day, name in found:
            print(f"stale: {day} {name}")
        return 1 if found else 0

    def tables() -> TollTables:
        if not args.tables:
            raise SystemExit("--tables is required to run a slot")
        return _tables(spark, args.tables, args.day_column, args.jdbc_options)

    if ranged:
        if args.only_open:
            done = rerun(tables(), store, args.first, args.last, args.list_name, args.url_prefix)
        else:
            name = slot(args.slot).name if args.slot else None
            nodes = [n for n in reports_between(args.first, args.last) if name in (None, n[1])]
            done = run_reports(tables(), store, nodes, args.list_name, args.url_prefix)
        for (day, name), n in done.items():
            print(f"{name} {day}: {n} rows")
        return 0

    s = slot(args.slot)

    def run() -> None:
        n = build_report(tables(), store, s.name, args.date, args.list_name, args.url_prefix)
        print(f"{s.name} {args.date}: {n} rows")

    if args.command == "run":
        run()
        return 0
    there = store.has_run(args.list_name, args.date, s.name)
    if not there and args.rerun:
        run()
        there = store.has_run(args.list_name, args.date, s.name)
    if not there:
        print(f"missing: {args.date} {s.name} {object_name(s.name, args.date, args.list_name)}")
    return 0 if there else 1


if __name__ == "__main__":
    sys.exit(main())
