"""Typing and filtering of landing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.functions import parse_event_time
from brooklet.schema import EVENT_TYPES, MONEY_COLUMNS, TARGET_COLUMNS

# The fields a row must have.
REQUIRED = ("event_id", "user_id", "event_type", "product_id")
KNOWN_TYPES = ", ".join(f"'{name}'" for name in EVENT_TYPES)


def has_required_fields() -> Column:
    return F.expr(" AND ".join(f"{name} IS NOT NULL" for name in REQUIRED))


def has_known_type() -> Column:
    """Exact match: case and surrounding blanks count."""
    return F.expr(f"event_type IN ({KNOWN_TYPES})")


def has_positive_money() -> Column:
    """Tested on the raw amounts, before rounding; NULL fails."""
    return F.expr(" AND ".join(f"{name} > 0" for name in MONEY_COLUMNS))


def rounded(name: str) -> str:
    """A column as text, amounts rounded half up to cents."""
    return f"round({name}, 2) AS {name}" if name in MONEY_COLUMNS else name


def conform(
    events: DataFrame, ingested_at: Column | None = None, time_zone: str | None = None
) -> DataFrame:
    """Type every landing row without dropping any; keeps the raw ``timestamp``."""
    derived = {
        "event_timestamp": parse_event_time(F.col("timestamp"), time_zone),
        "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
    }
    return events.withColumns(derived)


def clean(
    events: DataFrame, ingested_at: Column | None = None, time_zone: str | None = None
) -> DataFrame:
    """Landing rows to the 12 target columns, invalid rows dropped.

    ``ingested_at`` defaults to the current timestamp, which Spark fixes once per
    query or micro-batch; it may be an expression over ``event_timestamp``.
    """
    kept = events.filter(has_required_fields() & has_known_type() & has_positive_money())
    return conform(kept, ingested_at, time_zone).selectExpr(*map(rounded, TARGET_COLUMNS))
