"""Live aggregates and bounded-state deduplication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brooklet.functions import total_money
from brooklet.schema import KEY


def live_events_per_minute(
    events: DataFrame, lateness: str = "10 minutes", width: str = "1 minute"
) -> DataFrame:
    """Events and purchase revenue per event-time window.

    In append and update mode rows later than ``lateness`` behind the newest event
    are left out of the windows already closed; the query's progress counts them.
    Complete mode keeps all windows and takes every row. A purchase whose amount is
    not finite makes its window's revenue NaN; feed rows from ``accepted`` to keep
    such rows out.
    """
    windows = events.withWatermark("event_timestamp", lateness).groupBy(F.window("event_timestamp", width))
    revenue = total_money(events, "total_amount", F.col("event_type") == "purchase")
    counted = windows.agg(F.count("*").alias("n"), revenue.alias("revenue"))
    return counted.select(F.col("window.start").alias("event_minute"), "n", "revenue")


def dedupe_stream(events: DataFrame, lateness: str = "10 minutes", key: str = KEY) -> DataFrame:
    """Drop repeats of a key that arrive within ``lateness`` of its first row.

    State holds the keys of that period only; repeats beyond it pass. A row
    further than ``lateness`` behind the newest event is dropped whether repeated
    or not (counted in the query's progress): choose it to cover the longest
    delay, or use ``Ingest(dedupe="state")``, which keeps every row.
    """
    return events.withWatermark("event_timestamp", lateness).dropDuplicatesWithinWatermark([key])


def overwrite_sink(path: str) -> Callable[[DataFrame, int], None]:
    """Batch callback for complete mode: the newest result replaces the last one.

    Each batch writes its own folder, so a reader of the previous result is not
    disturbed and a replay rewrites only its own; see ``latest_result``.
    """

    def write(result: DataFrame, batch_id: int) -> None:
        result.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def latest_result(results: DataFrame) -> DataFrame:
    """Rows of the newest batch of an ``overwrite_sink`` folder."""
    newest = results.agg(F.max("batch_id").alias("batch_id"))
    return results.join(F.broadcast(newest), "batch_id", "left_semi").drop("batch_id")
