"""Batch queries by name; each takes (spark, sf_dir)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.functions import parse_event_time, round_money
from brooklet.operators import analytics, clean, contract, dedupe, layout, quality
from brooklet.plans.inputs import (
    cleaned,
    damaged_events,
    ingest_boundary,
    products,
    scratch,
    slim_events,
    table,
    user_events,
)
from brooklet.operators.enrich import enrich_all
from brooklet.schema import KEY, MONEY_COLUMNS, SOURCE_DDL, to_target
from brooklet.sources import landing_files, read_events_csv, read_events_table, read_stored, write_landing
from brooklet.streaming.sinks import TableSink

Query = Callable[[SparkSession, str], DataFrame]

# Landing files of the registered queries hold this many rows; the reports by
# file number use the 20-row sessions instead.
LANDING_ROWS = 100_000


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "landing")
    write_landing(user_events(spark, sf_dir), path, LANDING_ROWS)
    return read_events_csv(spark, path)


def parsed_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_events(spark, sf_dir).select(
        KEY, parse_event_time(F.col("timestamp")).alias("event_timestamp")
    )


def filter_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_events(spark, sf_dir).filter(clean.has_required_fields()).select(KEY)


def filter_event_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_events(spark, sf_dir).filter(clean.has_known_type()).select(KEY)


def filter_positive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return damaged_events(spark, sf_dir).filter(clean.has_positive_money()).select(KEY)


def rounded_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    kept = F.lit(1) - F.col("l_discount").cast("decimal(4,2)")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", round_money(price * kept).cast("double").alias("net_price")
    )


def clean_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).drop("ingested_at")


def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.sample_columns(
        cleaned(spark, sf_dir), KEY, "event_timestamp", "price", "total_amount", "event_type"
    )


def _narrowed(events: DataFrame) -> DataFrame:
    """Amounts as stored, shown as doubles."""
    return to_target(events).select(KEY, *(F.col(name).cast("double").alias(name) for name in MONEY_COLUMNS))


def narrow_money(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _narrowed(cleaned(spark, sf_dir))


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.duplicate_keys(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


def dedupe_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events delivered twice, kept once."""
    rows = cleaned(spark, sf_dir).select(KEY, "event_timestamp")
    return dedupe.first_per_key(rows.unionByName(rows), KEY, ["event_timestamp"])


def first_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First event of each user and type, whose groups hold many rows each."""
    rows = cleaned(spark, sf_dir).select("user_id", "event_type", "event_timestamp", KEY)
    rows = rows.withColumn("holder", F.concat_ws("/", "user_id", "event_type"))
    return dedupe.first_per_key(rows, "holder", ["event_timestamp"])


def keyed_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases first, then all rows twice over, then the second batch once more."""
    path, once = scratch(spark, "table"), scratch(spark, "cleaned")
    sink = TableSink(path, writer="events")
    cleaned(spark, sf_dir).write.parquet(once)  # the appends read it several times
    rows = spark.read.parquet(once)
    sink(rows.filter(F.col("event_type") == "purchase"), 0)
    later = rows.withColumn("ingested_at", ingest_boundary() + F.expr("INTERVAL 1 HOUR"))
    for _ in range(2):
        sink(later.unionByName(later), 1)
    return read_stored(spark, path).select(KEY, "batch_id", "ingested_at")


ROLLED_BATCHES = 6


def rolled_up_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches that each bring the rows of the one before again, rolled up every other time."""
    path, once = scratch(spark, "table"), scratch(spark, "cleaned")
    sink = TableSink(path, roll_up_every=2, writer="batches")
    cleaned(spark, sf_dir).write.parquet(once)
    rows = spark.read.parquet(once)
    number = F.col(KEY).cast("bigint") % ROLLED_BATCHES
    for batch in range(ROLLED_BATCHES):
        later = F.col("ingested_at") + F.make_dt_interval(hours=F.lit(batch))
        sink(rows.filter((number == batch) | (number == batch - 1)).withColumn("ingested_at", later), batch)
    amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
    return read_stored(spark, path).withColumns(amounts).drop("stream", "event_date")


def compact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events per day and type, read from the compacted layout."""
    path, packed = scratch(spark, "table"), scratch(spark, "packed")
    TableSink(path, unique="batch", writer="events")(cleaned(spark, sf_dir), 0)
    layout.compact(read_stored(spark, path), packed)
    rows = read_events_table(spark, packed)
    return rows.groupBy(F.to_date("event_timestamp").alias("event_date"), "event_type").agg(
        F.count("*").alias("n")
    )


def stored_events(spark: SparkSession, sf_dir: str, with_day: bool = False) -> DataFrame:
    """The clean events written to a table and read back, money as double."""
    path = scratch(spark, "table")
    TableSink(path, unique="none", writer="events")(cleaned(spark, sf_dir), 0)
    amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
    return read_events_table(spark, path, with_day=with_day).withColumns(amounts)


def newest_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.newest_minutes(stored_events(spark, sf_dir, with_day=True))


def latest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.latest_stored(stored_events(spark, sf_dir))


def latest_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.latest_events(cleaned(spark, sf_dir))


def _by_file(events: DataFrame) -> DataFrame:
    """Session number as the number of the file that carried the session."""
    return events.withColumn("file_id", F.col("session_id").cast("bigint"))


def file_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.file_type_counts(_by_file(user_events(spark, sf_dir)))


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.running_total(_by_file(user_events(spark, sf_dir)))


def _landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events read back from landing folders of some 500, with the folder's name."""
    path = scratch(spark, "landing")
    folder = (F.floor(F.col(KEY).cast("bigint") / 500) * 7).alias("part")
    rows = user_events(spark, sf_dir).select("*", folder).repartition("part")
    rows.write.partitionBy("part").option("header", True).csv(path)
    return landing_files(spark.read.schema(SOURCE_DDL).option("header", True).csv(path), folder=True)


def landing_file_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.file_type_counts(_landed(spark, sf_dir))


def landing_running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analytics.running_total(_landed(spark, sf_dir))


def unmatched_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Why events are set aside whose product the catalogue lacks (a tenth of it is taken out)."""
    known = products(spark, sf_dir).filter("product_id % 10 <> 3")
    rows = enrich_all(slim_events(spark, sf_dir), known, units=F.col("units"))
    return contract.violations(contract.check(rows))


def accepted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the contract leaves of the damaged events."""
    return contract.accepted(contract.check(damaged_events(spark, sf_dir), ingest_boundary()))


def on_accepted(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(accepted_events(spark, sf_dir))


def damaged_kpi_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """KPIs of damaged events that the filters pass, purchases delivered twice."""
    rows = clean.clean(damaged_events(spark, sf_dir), ingest_boundary())
    return quality.kpi_report(rows.unionByName(rows.filter("event_type = 'purchase'")))


def schema_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns of a written table as its files have them."""
    path = scratch(spark, "table")
    TableSink(path, unique="none", writer="events")(cleaned(spark, sf_dir), 0)
    return quality.schema_report(spark.read.parquet(path).drop("stream", "batch_id", "event_date"))


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_summary(damaged_events(spark, sf_dir))


def contract_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract.violations(contract.check(damaged_events(spark, sf_dir)))


def duplicate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that share their user's minute with another one."""
    events = cleaned(spark, sf_dir).withColumn(
        "slot", F.concat_ws("/", "user_id", F.date_format("event_timestamp", "yyyy-MM-dd HH:mm"))
    )
    return quality.duplicate_rows(events, "slot")


def on_cleaned(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: report(cleaned(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "csv_scan": csv_scan,
    "parse_event_time": parsed_times,
    "filter_not_null": filter_not_null,
    "filter_event_type": filter_event_type,
    "filter_positive": filter_positive,
    "round_money": rounded_lines,
    "narrow_money": narrow_money,
    "clean_events": clean_events,
    "enrich_events": user_events,
    "select_columns": select_columns,
    "total_events": on_cleaned(analytics.total_events),
    "events_by_type": on_cleaned(analytics.events_by_type),
    "revenue_by_category": on_cleaned(analytics.revenue_by_category),
    "category_revenue_purchases": on_cleaned(analytics.category_revenue_purchases),
    "category_coverage": on_cleaned(analytics.category_coverage),
    "events_per_minute": on_cleaned(analytics.events_per_minute),
    "duplicate_keys": repeated_lines,
    "duplicate_rows": duplicate_rows,
    "dedupe_events": dedupe_events,
    "first_events": first_events,
    "keyed_append": keyed_append,
    "compact_events": compact_events,
    "latest_events": latest_events,
    "latest_stored": latest_stored,
    "newest_minutes": newest_minutes,
    "file_type_counts": file_type_counts,
    "running_total": running_total,
    "event_type_share": on_cleaned(analytics.event_type_share),
    "latency_stats": on_cleaned(quality.latency_stats),
    "quality_summary": quality_summary,
    "contract_violations": contract_violations,
    "kpi_report": on_cleaned(quality.kpi_report),
    "schema_report": schema_report,
    "rolled_up_append": rolled_up_append,
    "landing_file_counts": landing_file_counts,
    "landing_running_total": landing_running_total,
    "unmatched_quarantine": unmatched_quarantine,
    "accepted_events": on_accepted(lambda events: events.drop("ingested_at")),
    "accepted_narrow_money": on_accepted(_narrowed),
    "accepted_revenue_by_category": on_accepted(analytics.revenue_by_category),
    "accepted_category_revenue_purchases": on_accepted(analytics.category_revenue_purchases),
    "accepted_category_coverage": on_accepted(analytics.category_coverage),
    "damaged_kpi_report": damaged_kpi_report,
}
