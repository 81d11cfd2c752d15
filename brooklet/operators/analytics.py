"""Reports over the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from brooklet.functions import event_minute, total_money
from brooklet.schema import KEY
from brooklet.sources.scratch import rewritten


def total_events(events: DataFrame) -> DataFrame:
    return events.agg(F.count("*").alias("n"))


def events_by_type(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("n"))


def _purchases(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase")


def _revenue(events: DataFrame) -> Column:
    return total_money(events, "total_amount")


def revenue_by_category(events: DataFrame) -> DataFrame:
    grouped = _purchases(events).groupBy("category").agg(_revenue(events).alias("revenue"))
    return grouped.orderBy(F.desc("revenue"), "category")


def category_revenue_purchases(events: DataFrame) -> DataFrame:
    grouped = _purchases(events).groupBy("category").agg(
        _revenue(events).alias("total_revenue"), F.count("*").alias("purchases")
    )
    return grouped.orderBy(F.desc("total_revenue"), "category")


def category_coverage(events: DataFrame) -> DataFrame:
    """How many categories sold, and the smallest category revenue."""
    return revenue_by_category(events).agg(
        F.count("*").alias("categories"), F.min("revenue").alias("min_revenue")
    )


def events_per_minute(events: DataFrame, last: int | None = 10) -> DataFrame:
    """Events in the newest ``last`` minutes that have any; all with ``None``."""
    minutes = events.groupBy(event_minute(F.col("event_timestamp")).alias("event_minute")).agg(
        F.count("*").alias("n")
    )
    newest = minutes.orderBy(F.desc("event_minute"))
    return newest if last is None else newest.limit(last)


def newest_minutes(events: DataFrame, last: int = 10) -> DataFrame:
    """``events_per_minute`` of a stored table with its ``event_date``.

    Every day that has events has a minute that does, so the newest ``last`` such
    days hold all the minutes asked for, and the other partitions are skipped.
    One day more is read, in case writers cut their days in different zones.
    """
    days = events.select("event_date").distinct().orderBy(F.desc("event_date")).limit(last)
    bound = days.agg(F.date_sub(F.min("event_date"), 1)).scalar()
    return events_per_minute(events.filter(F.col("event_date") >= bound), last)


def latest_events(events: DataFrame, n: int = 5) -> DataFrame:
    """Newest rows by ingest time; the key breaks the ties inside a batch."""
    return events.orderBy(F.desc("ingested_at"), KEY).limit(n)


def latest_stored(events: DataFrame, n: int = 5) -> DataFrame:
    """``latest_events`` of a stored table, without reading all its columns.

    ``ingested_at`` has one value per batch, so that column alone is next to
    nothing to read. It gives the instant of the n-th newest row, and only row
    groups that reach this instant are read in full.
    """
    instant = F.col("ingested_at")
    newest = events.select(instant).orderBy(instant.desc()).limit(n)
    bound = newest.agg(F.min("ingested_at")).scalar()
    return latest_events(events.filter(instant >= bound), n)


def sample_columns(events: DataFrame, *columns: str, n: int = 10) -> DataFrame:
    """The first ``n`` rows by key, cut to ``columns``."""
    return events.orderBy(KEY).limit(n).select(*columns)


def event_type_share(events: DataFrame) -> DataFrame:
    """Count and percentage per type; the window runs over the counted types only."""
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return events_by_type(events).select(
        "event_type", "n", F.round(100.0 * share.cast("double"), 1).alias("pct")
    )


def file_type_counts(events: DataFrame, file: str = "file_id") -> DataFrame:
    """Views and purchases per landing file."""
    return events.groupBy(file).agg(
        F.count_if(F.col("event_type") == "view").alias("views"),
        F.count_if(F.col("event_type") == "purchase").alias("purchases"),
    )


def running_total(events: DataFrame, file: str = "file_id") -> DataFrame:
    """Rows per file and the total up to and including it, in order of the files' names.

    A window over all files would run in one task. The counted files are dealt into
    ranges of names instead, and written, so that both uses see the same ranges; only
    the sums of the ranges, a row each, go through an unpartitioned window, and each
    range adds its own running sum. Names may be of any type and as sparse as they like.
    """
    files = events.groupBy(file).agg(F.count("*").alias("n")).repartitionByRange(F.col(file))
    files = rewritten(files.withColumn("_range", F.spark_partition_id()), "files")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        files.groupBy("_range")
        .agg(F.sum("n").alias("_n"))
        .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy("_range").orderBy(file).rowsBetween(Window.unboundedPreceding, 0)
    return files.join(offsets, "_range").select(
        file, "n", (F.sum("n").over(inside) + F.col("_offset")).alias("total")
    )
