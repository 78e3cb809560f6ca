"""Command line for spark-submit: clean, load, delete, snapshot and report."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from orderloom.plans import jobs, reports
from orderloom.schemas import TABLES
from orderloom.session import configure
from orderloom.sources.store import TableStore

SHOWN_ROWS = 50


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="orderloom")
    commands = root.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("clean", help="raw CSV files to cleaned CSV folders")
    clean.add_argument("source")
    clean.add_argument("target")
    clean.add_argument(
        "--multiline", action="store_true", help="line breaks may stand inside quoted order cells"
    )
    load = commands.add_parser("load", help="cleaned CSV folders into the published tables")
    load.add_argument("source")
    load.add_argument("root")
    load.add_argument("--on-reject", choices=("fail", "quarantine"), default="fail")
    load.add_argument("--run", help="a name; a broken load of that name is taken up again")
    delete = commands.add_parser("delete", help="published rows by key, and what they own")
    delete.add_argument("root")
    delete.add_argument("table", choices=tuple(TABLES))
    delete.add_argument("keys", help="CSV with a header and the table's key columns")
    snapshot = commands.add_parser("snapshot", help="one document per published order")
    snapshot.add_argument("root")
    snapshot.add_argument("--full", action="store_true", help="build unchanged orders again, too")
    layout = commands.add_parser("layout", help="second layouts: the log by month, listings by category")
    layout.add_argument("root")
    report = commands.add_parser("report", help="a question about published data")
    report.add_argument("root")
    report.add_argument("name", choices=tuple(reports.REPORTS))
    report.add_argument("argument", nargs="*", help="top X, a stretch of time, category, order, customer, status, or SQL")
    report.add_argument("--out", help="write JSON lines here instead of showing the first rows")
    return root


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = configure(SparkSession.builder.appName(f"orderloom {args.command}").getOrCreate())
    if args.command == "clean":
        report = jobs.clean_feeds(spark, args.source, args.target, multiline=args.multiline)
        for name, counts in report.items():
            print(f"cleaned {name}:", ", ".join(f"{what} {n}" for what, n in counts.items() if n))
    elif args.command == "load":
        print(jobs.load_tables(spark, args.source, args.root, args.on_reject, args.run))
    elif args.command == "delete":
        table = TABLES[args.table]
        types = {f.name: f.type for f in table.fields}
        keys = spark.read.csv(args.keys, header=True).select(
            *(F.col(c).cast(types[c]) for c in table.key)
        )
        print("deleted:", jobs.delete_rows(spark, args.root, args.table, keys))
    elif args.command == "snapshot":
        print(jobs.snapshot_orders(spark, args.root, args.full))
    elif args.command == "layout":
        print("laid out version", jobs.lay_out(spark, args.root))
    else:
        result = reports.REPORTS[args.name](TableStore(spark, args.root), *args.argument)
        if args.out:
            result.write.mode("overwrite").json(args.out)
        else:
            result.show(SHOWN_ROWS, truncate=False)
            if more := result.offset(SHOWN_ROWS).count():
                print(f"{more} more rows; --out writes all")


if __name__ == "__main__":
    main()
