"""Command line: run the ingest stream, compact its table, print the reports.

    python -m brooklet ingest --landing ... --table ... --checkpoint ...
"""

from __future__ import annotations

import argparse
import logging
import os
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from brooklet.operators import analytics, partials, quality
from brooklet.operators.cluster import cluster
from brooklet.operators.layout import compact
from brooklet.sources import read_events_stream, read_events_table, read_stored
from brooklet.streaming import Ingest, JdbcSink, TableSink, run, stream_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="brooklet")
    jobs = parser.add_subparsers(dest="job", required=True)

    ingest = jobs.add_parser("ingest", help="stream landing files into the event table")
    ingest.add_argument("--landing", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--table", help="folder of the event table")
    ingest.add_argument("--quarantine", help="folder for rejected rows")
    ingest.add_argument("--discard", action="store_true", help="drop rejected rows instead")
    ingest.add_argument("--raw", action="store_true", help="keep unreadable lines whole in the quarantine")
    ingest.add_argument("--commits", help="folder for one record per batch that all sinks hold")
    ingest.add_argument("--partials", action="store_true", help="leave partial aggregates beside each batch")
    ingest.add_argument("--metrics", help="folder for one report row per batch")
    ingest.add_argument("--archive", help="folder consumed files are moved to")
    ingest.add_argument("--max-files", type=int, default=5)
    ingest.add_argument("--max-bytes", type=int, help="bound a batch by bytes, not files")
    ingest.add_argument("--interval", default="10 seconds")
    ingest.add_argument("--once", action="store_true", help="take what is there and stop")
    ingest.add_argument("--stop-file", help="stop between batches once this file or folder exists")
    ingest.add_argument("--strict", action="store_true", help="stop on a row the table forbids")
    ingest.add_argument("--time-zone", help="zone of the event times, if not the session's")
    ingest.add_argument(
        "--unique",
        choices=("table", "day", "state"),
        default="state",
        help="check keys against the table, its days in question, or the stream's state",
    )
    ingest.add_argument("--roll-up-every", type=int, default=100, help="batches between roll-ups; 0: never")
    ingest.add_argument("--jdbc-url", help="also append to this database; user and password "
                        "come from JDBC_USER and JDBC_PASSWORD")  # fmt: skip
    ingest.add_argument("--jdbc-table", default="user_events")
    ingest.add_argument("--jdbc-merge", action="store_true", help="stage each batch, then insert what is new at once")
    ingest.add_argument("--jdbc-writers", type=int, default=2, help="connections that insert")
    ingest.add_argument("--jdbc-readers", type=int, default=4, help="connections that look keys up")

    pack = jobs.add_parser("compact", help="rewrite the table by day, for reading")
    pack.add_argument("--table", required=True)
    pack.add_argument("--out", required=True)
    pack.add_argument("--since-batch", type=int)
    pack.add_argument("--stream", help="the stream whose batches --since-batch counts")

    ordered = jobs.add_parser("cluster", help="copy the table for lookups by user, category and day")
    ordered.add_argument("--table", required=True)
    ordered.add_argument("--out", required=True)

    report = jobs.add_parser("report", help="print the reports of a table")
    report.add_argument("--table", required=True)
    report.add_argument("--partials", action="store_true", help="from its partial aggregates, without reading events")
    return parser


def _sinks(args: argparse.Namespace) -> list:
    sinks: list = []
    if args.table:
        unique = "none" if args.unique == "state" else args.unique
        sinks.append(TableSink(args.table, unique, args.roll_up_every, partials=args.partials))
    if args.jdbc_url:
        login = {"user": os.environ.get("JDBC_USER"), "password": os.environ.get("JDBC_PASSWORD")}
        options = {name: value for name, value in login.items() if value}
        sinks.append(
            JdbcSink(
                args.jdbc_url,
                args.jdbc_table,
                writers=args.jdbc_writers,
                readers=args.jdbc_readers,
                options=options,
                merge=args.jdbc_merge,
            )
        )
    return sinks


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.unique == "state":
        spark = stream_session(spark)
    source = read_events_stream(spark, args.landing, args.max_files, args.max_bytes, args.archive, raw=args.raw)
    job = Ingest(
        _sinks(args),
        args.quarantine,
        args.strict,
        "state" if args.unique == "state" else "sink",
        args.time_zone,
        args.metrics,
        args.discard,
        commits=args.commits,
    )
    run(job.start(source, args.checkpoint, None if args.once else args.interval), job, args.stop_file)


def print_all(rows: DataFrame) -> None:
    """Every row, a line each, fetched a partition at a time."""
    print("\t".join(rows.columns))
    for row in rows.toLocalIterator():
        print("\t".join(map(str, row)))


def print_reports(reports: dict[str, DataFrame]) -> None:
    for title, rows in reports.items():
        print(f"== {title}")
        print_all(rows)


def report_partials(spark: SparkSession, args: argparse.Namespace) -> None:
    parts = partials.read_partials(spark, args.table)
    print_reports({
        "events": partials.total_events(parts),
        "by type": partials.event_type_share(parts),
        "revenue": partials.category_revenue_purchases(parts),
        "per minute": partials.events_per_minute(parts),
        "per day": partials.running_total(parts),
        "latency": partials.latency_stats(parts),
        "kpi": partials.kpi_report(parts),
    })


def report(spark: SparkSession, args: argparse.Namespace) -> None:
    events = read_events_table(spark, args.table)
    days = read_events_table(spark, args.table, with_day=True)
    print_reports({
        "events": analytics.total_events(events),
        "by type": analytics.event_type_share(events),
        "revenue": analytics.category_revenue_purchases(events),
        "per minute": analytics.newest_minutes(days),
        "latest": analytics.latest_stored(events),
        "latency": quality.latency_stats(events),
        "kpi": quality.kpi_report(events),
    })


def main(argv: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    logging.basicConfig(level=logging.INFO, format="[{levelname[0]}] {asctime} {name}: {message}", style="{")
    parser = _parser()
    args = parser.parse_args(argv)
    if args.job == "ingest":
        if not (args.table or args.jdbc_url):
            parser.error("ingest needs --table or --jdbc-url to store rows in")
        if not (args.quarantine or args.discard):
            parser.error("ingest needs --quarantine, or --discard to drop rejected rows")
    spark = spark or SparkSession.builder.appName(f"brooklet-{args.job}").getOrCreate()
    if args.job == "ingest":
        ingest(spark, args)
    elif args.job == "compact":
        compact(read_stored(spark, args.table), args.out, args.since_batch, args.stream)
    elif args.job == "cluster":
        cluster(read_stored(spark, args.table), args.out)
    elif args.partials:
        report_partials(spark, args)
    else:
        report(spark, args)


if __name__ == "__main__":
    main()
