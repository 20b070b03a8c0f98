"""Command line, for spark-submit: load, ingest, stream, report, backup, restore, compact, index."""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame

from starload.plans.ingest import ingest_requests
from starload.plans.load import load_history
from starload.plans.reports import above_mean_groups, quarterly_counts
from starload.plans.snapshot import backup, restore
from starload.session import build_session
from starload.sources.requests import read_requests
from starload.spec import DEPARTMENTS, HIRED_EMPLOYEES, JOBS, STAR
from starload.streaming.ingest_stream import ingest_stream
from starload.warehouse import Warehouse

TABLES = [spec.name for spec in STAR]


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="starload", description=__doc__)
    top.add_argument("--root", required=True, help="folder of the tables")
    top.add_argument("--wide", action="store_true", help="64-bit keys")
    commands = top.add_subparsers(dest="command", required=True)

    load = commands.add_parser("load", help="load history files")
    for name in TABLES:
        load.add_argument(f"--{name}", nargs="+", metavar="PATH")

    ingest = commands.add_parser("ingest", help="take in files of JSON requests, one per line")
    ingest.add_argument("path")
    ingest.add_argument("--table", choices=TABLES, default=HIRED_EMPLOYEES.name)
    ingest.add_argument("--batch", help="batch id; the same id is stored once")

    stream = commands.add_parser("stream", help="take in such files as they arrive in a folder")
    stream.add_argument("path")
    stream.add_argument("checkpoint", help="folder for the progress of the stream")
    stream.add_argument("--table", choices=TABLES, default=HIRED_EMPLOYEES.name)
    stream.add_argument("--every", metavar="INTERVAL", help='go on, for instance every "1 minute"; else stop at the end')

    report = commands.add_parser("report", help="write a yearly report")
    report.add_argument("kind", choices=["quarterly", "above-mean"])
    report.add_argument("year", type=int)
    report.add_argument("out", help="folder for CSV with a header")

    save = commands.add_parser("backup", help="back tables up to Avro")
    save.add_argument("folder")
    save.add_argument("--table", choices=TABLES, nargs="+", default=TABLES)

    back = commands.add_parser("restore", help="replace a table by a backup")
    back.add_argument("table", choices=TABLES)
    back.add_argument("path")
    back.add_argument("--check-fk", action="store_true")
    back.add_argument("--expected-rows", type=int, help="rows of a backup without a row count of its own")
    back.add_argument("--trust-unverified", action="store_true", help="take what can be read of such a backup")

    join = commands.add_parser("compact", help="rewrite a table of many small batches as one")
    join.add_argument("table", choices=TABLES)

    index = commands.add_parser("index", help="keep key filters, and report counts, of folders that came in since")
    index.add_argument("table", choices=TABLES)
    return top


def run(warehouse: Warehouse, args: argparse.Namespace) -> None:
    warehouse.create()
    if args.command == "load":
        paths = {name: getattr(args, name) for name in TABLES if getattr(args, name)}
        for row in load_history(warehouse, paths).counts:
            print(row["table"], row["reason_code"] or "stored", row["rows"])
    elif args.command == "ingest":
        result = ingest_requests(warehouse, args.table, read_requests(warehouse.spark, args.path), args.batch)
        print(result.batch_id, "inserted", result.accepted.count(), "rejected", result.rejected.count())
    elif args.command == "stream":
        trigger = {"processingTime": args.every} if args.every else None
        ingest_stream(warehouse, args.table, args.path, args.checkpoint, trigger=trigger).awaitTermination()
    elif args.command == "report":
        _report(warehouse, args.kind, args.year).write.option("header", True).csv(args.out)
    elif args.command == "backup":
        for name in args.table:
            print(name, backup(warehouse, name, args.folder))
    elif args.command == "compact":
        warehouse.compact(args.table)
    elif args.command == "index":
        counted = warehouse.keep_counts(args.table) if warehouse.specs[args.table].year_of else 0
        print(args.table, "indexed", warehouse.keep_keys(args.table), "counted", counted)
    else:
        print(restore(warehouse, args.table, args.path, args.check_fk, args.expected_rows, args.trust_unverified))


def _report(warehouse: Warehouse, kind: str, year: int) -> DataFrame:
    fact, departments = warehouse.read(HIRED_EMPLOYEES.name, year), warehouse.read(DEPARTMENTS.name)
    if kind == "quarterly":
        return quarterly_counts(fact, departments, warehouse.read(JOBS.name), year)
    return above_mean_groups(fact, departments, year)


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    specs = [spec.widened() for spec in STAR] if args.wide else STAR
    run(Warehouse(build_session(), args.root, specs), args)


if __name__ == "__main__":
    main()
