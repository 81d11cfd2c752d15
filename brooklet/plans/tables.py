"""Queries over stored tables: partial aggregates, lookups, batches through the key index."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brooklet.operators import cluster, partials
from brooklet.plans.batch import Query
from brooklet.plans.inputs import cleaned, scratch
from brooklet.schema import KEY, MONEY_COLUMNS
from brooklet.sources import read_stored
from brooklet.sources.scratch import rewritten
from brooklet.streaming.sinks import TableSink

# Batches of the tables written here, each with a part of the events.
BATCHES = 4


def _cleaned_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean events, written: every batch reads them, and would send the products to all tasks again."""
    return rewritten(cleaned(spark, sf_dir), "cleaned")


def _in_batches(spark: SparkSession, sf_dir: str, sink: TableSink) -> None:
    """The clean events in batches; the third is written twice, first without its purchases."""
    rows = _cleaned_once(spark, sf_dir)
    number = F.col(KEY).cast("bigint") % BATCHES
    for batch in range(BATCHES):
        if batch == 2:
            sink(rows.filter((number == batch) & (F.col("event_type") == "view")), batch)
        sink(rows.filter(number == batch), batch)


def on_partials(report: Callable[[DataFrame], DataFrame]) -> Query:
    """A report from the partial aggregates of a table whose batches were replayed and rolled up."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = scratch(spark, "table")
        _in_batches(spark, sf_dir, TableSink(path, "batch", roll_up_every=2, writer="batches", partials=True))
        return report(partials.read_partials(spark, path))

    return query


def small_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nine batches by the day of the event, each of which brings the events of another day as well."""
    path = scratch(spark, "table")
    sink = TableSink(path, roll_up_every=3, writer="batches")
    rows = _cleaned_once(spark, sf_dir)
    day = F.datediff("event_timestamp", F.lit("2024-01-01")) % 9
    for batch in range(9):
        sink(rows.filter((day == batch) | (day == (batch + 4) % 9)), batch)
    return read_stored(spark, path).select(KEY, "batch_id")


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, packed = scratch(spark, "table"), scratch(spark, "clustered")
    TableSink(path, unique="batch", writer="events")(cleaned(spark, sf_dir), 0)
    cluster.cluster(read_stored(spark, path), packed)
    amounts = {name: F.col(name).cast("double") for name in MONEY_COLUMNS}
    return cluster.read_clustered(spark, packed).withColumns(amounts)


def user_events_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events of the user with the most events, the smallest number of those."""
    events = _clustered(spark, sf_dir)
    busiest = events.groupBy("user_id").count().orderBy(F.desc("count"), "user_id").limit(1)
    return cluster.events_of(events, "user_id", busiest.select("user_id"))


def category_events_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the best-selling category, the first by name of those."""
    events = _clustered(spark, sf_dir)
    bought = events.filter(F.col("event_type") == "purchase")
    best = bought.groupBy("category").count().orderBy(F.desc("count"), "category").limit(1)
    return cluster.events_of(bought, "category", best.select("category"))


QUERIES: dict[str, Query] = {
    "small_batches": small_batches,
    "user_events_lookup": user_events_lookup,
    "category_events_lookup": category_events_lookup,
    "partials_event_type_share": on_partials(partials.event_type_share),
    "partials_category_revenue_purchases": on_partials(partials.category_revenue_purchases),
    "partials_events_per_minute": on_partials(partials.events_per_minute),
    "partials_running_total": on_partials(partials.running_total),
    "partials_latency_stats": on_partials(partials.latency_stats),
    "partials_kpi_report": on_partials(partials.kpi_report),
}
