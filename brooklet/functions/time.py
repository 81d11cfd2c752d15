"""Event-time expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from brooklet.schema import EVENT_TIME_FORMAT


def parse_event_time(text: Column, time_zone: str | None = None) -> Column:
    """Landing text to an instant; NULL when the text does not match the format.

    The text carries no zone. By default it is read in the session time zone,
    as a plain cast would; pass ``time_zone`` to pin the zone of the producer.
    """
    if time_zone is None:
        return F.try_to_timestamp(text, F.lit(EVENT_TIME_FORMAT))
    zoned = F.concat(text, F.lit(f" {time_zone}"))
    return F.try_to_timestamp(zoned, F.lit(f"{EVENT_TIME_FORMAT} VV"))


def render_event_time(moment: Column) -> Column:
    return F.date_format(moment, EVENT_TIME_FORMAT)


def event_minute(moment: Column) -> Column:
    return F.date_trunc("minute", moment)


def latency_micros(event_time: Column, ingested_at: Column) -> Column:
    """Whole microseconds between event time and ingest time."""
    return F.unix_micros(ingested_at) - F.unix_micros(event_time)


def batch_boundary(moment: Column, interval_seconds: int = 10) -> Column:
    """The first trigger boundary at or after ``moment``."""
    steps = F.ceil(F.unix_micros(moment) / F.lit(interval_seconds * 1_000_000))
    return F.timestamp_seconds(steps * interval_seconds)
