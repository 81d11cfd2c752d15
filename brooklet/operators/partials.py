"""Partial aggregates of stored batches, and the reports made of them without reading the events.

A row holds what the reports need of the events of one minute, type and category: counts,
exact sums in two parts, least and greatest values. All of these merge, so a batch's
partials are written beside the batch, replaced with it on a replay, and merged when its
rows are rolled up. Reports read a row for each minute, type and category, and equal those
over the events.

Duplicate keys cannot be told from sums. A table whose sink checks its keys has none, and
a report that names them takes their number from the caller.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from brooklet.functions import as_money, cents, event_minute, high, joined, latency_micros, low
from brooklet.operators.contract import violates
from brooklet.operators.layout import Layer
from brooklet.operators.quality import KPIS, Kpi, kpis_of
from brooklet.sources.table import read_layered

DIMENSIONS = ("event_minute", "event_type", "category")
SUMS = ("n", "bad", "money_high", "money_low", "delay_high", "delay_low")
LEAST, GREATEST = ("least_delay", "first"), ("greatest_delay", "last")
PARTIAL_DDL = (
    "event_minute timestamp, event_type string, category string, "
    + ", ".join(f"{name} bigint" for name in SUMS)
    + ", least_delay bigint, first timestamp, greatest_delay bigint, last timestamp, stream string, batch_id bigint"
)


def partials(events: DataFrame) -> DataFrame:
    """One row per minute, type and category of stored events."""
    amount = cents(events, "total_amount")
    delay = latency_micros(F.col("event_timestamp"), F.col("ingested_at"))
    measured = events.select(
        event_minute(F.col("event_timestamp")).alias("event_minute"),
        "event_type",
        "category",
        F.lit(1).cast("long").alias("n"),
        F.when(violates(), 1).otherwise(0).cast("long").alias("bad"),
        high(amount).alias("money_high"),
        low(amount).alias("money_low"),
        high(delay).alias("delay_high"),
        low(delay).alias("delay_low"),
        delay.alias("least_delay"),
        F.col("event_timestamp").alias("first"),
        delay.alias("greatest_delay"),
        F.col("ingested_at").alias("last"),
    )
    return merged(measured)


def merged(rows: DataFrame, *by: str) -> DataFrame:
    """Partials added up by some of their dimensions; by all of them unless given."""
    return rows.groupBy(*(by or DIMENSIONS)).agg(*_totals())


def _totals() -> list[Column]:
    return [
        *(F.sum(name).alias(name) for name in SUMS),
        *(F.min(name).alias(name) for name in LEAST),
        *(F.max(name).alias(name) for name in GREATEST),
    ]


def _merge(rows: DataFrame, level: int) -> DataFrame:
    """Of a segment: its batches are added up, so it names none."""
    whole = merged(rows).withColumns({"stream": F.lit(""), "batch_id": F.lit(-1).cast("long")})
    return whole.repartitionByRange("event_minute").sortWithinPartitions(*DIMENSIONS)


PARTIALS = Layer(PARTIAL_DDL, (), _merge)


def partials_path(table: str) -> str:
    return f"{table}/_partials"


def read_partials(spark: SparkSession, table: str) -> DataFrame:
    """The partials of an ingest table, one to three rows of which may share their dimensions."""
    rows = read_layered(spark, partials_path(table), PARTIAL_DDL)
    return spark.createDataFrame([], PARTIAL_DDL) if rows is None else rows


def _money() -> Column:
    return as_money(joined(F.sum("money_high"), F.sum("money_low")))


def total_events(parts: DataFrame) -> DataFrame:
    return parts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


def events_by_type(parts: DataFrame) -> DataFrame:
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"))


def event_type_share(parts: DataFrame) -> DataFrame:
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return events_by_type(parts).select("event_type", "n", F.round(100.0 * share.cast("double"), 1).alias("pct"))


def revenue_by_category(parts: DataFrame) -> DataFrame:
    return category_revenue_purchases(parts).select("category", F.col("total_revenue").alias("revenue"))


def category_revenue_purchases(parts: DataFrame) -> DataFrame:
    bought = parts.filter(F.col("event_type") == "purchase").groupBy("category")
    found = bought.agg(_money().alias("total_revenue"), F.sum("n").alias("purchases"))
    return found.orderBy(F.desc("total_revenue"), "category")


def category_coverage(parts: DataFrame) -> DataFrame:
    return revenue_by_category(parts).agg(F.count("*").alias("categories"), F.min("revenue").alias("min_revenue"))


def events_per_minute(parts: DataFrame, last: int | None = 10) -> DataFrame:
    """Of the newest ``last`` minutes that have events; all with ``None``."""
    minutes = parts.groupBy("event_minute").agg(F.sum("n").alias("n")).orderBy(F.desc("event_minute"))
    return minutes if last is None else minutes.limit(last)


def running_total(parts: DataFrame, unit: str = "day") -> DataFrame:
    """Events per day (or another unit of time) and the total up to and including it."""
    spans = parts.groupBy(F.date_trunc(unit, "event_minute").alias(unit)).agg(F.sum("n").alias("n"))
    so_far = Window.orderBy(unit).rowsBetween(Window.unboundedPreceding, 0)
    return spans.select(unit, "n", F.sum("n").over(so_far).alias("total"))


def latency_stats(parts: DataFrame) -> DataFrame:
    micros = joined(F.sum("delay_high"), F.sum("delay_low")).cast("double") / F.lit(1e6)
    return parts.agg(
        F.try_divide(micros, F.sum("n")).alias("avg_s"),
        (F.min("least_delay").cast("double") / F.lit(1e6)).alias("min_s"),
        (F.max("greatest_delay").cast("double") / F.lit(1e6)).alias("max_s"),
    )


def kpi_report(parts: DataFrame, duplicates: int = 0, kpis: tuple[Kpi, ...] = KPIS) -> DataFrame:
    totals = parts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
        joined(F.sum("delay_high"), F.sum("delay_low")).alias("us"),
        F.max("greatest_delay").alias("max_us"),
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )
    return kpis_of(totals.withColumn("duplicates", F.lit(duplicates)), kpis)
