"""Row contract: name every reason a row may not enter the event table.

``check`` marks each typed row with its reasons in one pass; nothing is dropped.
An empty reason text means the row is accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brooklet.operators.clean import KNOWN_TYPES, REQUIRED, conform, rounded
from brooklet.schema import MONEY_COLUMNS, SOURCE_COLUMNS, TARGET, TARGET_COLUMNS
from brooklet.sources.landing import RAW_COLUMNS

REASONS = "reasons"
# From here on an amount rounds to more than decimal(10,2) holds.
MONEY_LIMIT = "99999999.995D"


def filter_rules() -> dict[str, str]:
    """The rules behind ``clean``, one by one, as the condition that breaks them."""
    rules = {f"{name}_null": f"{name} IS NULL" for name in REQUIRED}
    rules["event_type_unknown"] = f"event_type NOT IN ({KNOWN_TYPES})"
    for name in MONEY_COLUMNS:
        rules[f"{name}_not_positive"] = f"NOT coalesce({name} > 0, false)"
    return rules


def table_rules() -> dict[str, str]:
    """What the table's column types forbid beyond ``filter_rules``."""
    rules: dict[str, str] = {}
    for column in TARGET:
        name = column.name
        if name in MONEY_COLUMNS:
            size = f"abs(double({name}))"
            rules[f"{name}_not_finite"] = f"isnan({size}) OR {size} = double('Infinity')"
            rules[f"{name}_too_large"] = f"{size} >= {MONEY_LIMIT} AND {size} < double('Infinity')"
        elif name not in REQUIRED:
            rules[f"{name}_null"] = f"{name} IS NULL"
        if column.max_chars:
            rules[f"{name}_too_long"] = f"char_length({name}) > {column.max_chars}"
    return rules


def all_rules() -> dict[str, str]:
    return {**filter_rules(), **table_rules()}


def violates(rules: dict[str, str] | None = None) -> Column:
    """True when any rule is broken, never NULL."""
    rules = all_rules() if rules is None else rules
    return F.expr(" OR ".join(f"coalesce({broken}, false)" for broken in rules.values()))


def check(
    events: DataFrame, ingested_at: Column | None = None, time_zone: str | None = None
) -> DataFrame:
    """Typed landing rows plus a comma-separated ``reasons`` text.

    A text keeps the whole projection inside generated code; ``violations``
    splits it for the rows that have one.
    """
    typed = conform(events, ingested_at, time_zone)
    named = (f"CASE WHEN {broken} THEN '{name}' END" for name, broken in all_rules().items())
    return typed.withColumn(REASONS, F.expr(f"concat_ws(',', {', '.join(named)})"))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(REASONS) == "").selectExpr(*map(rounded, TARGET_COLUMNS))


def rejected(checked: DataFrame) -> DataFrame:
    """Rejected rows as they came, with their reasons as a list, and their lines if those were read."""
    lines = [name for name in RAW_COLUMNS if name in checked.columns]
    return checked.filter(F.col(REASONS) != "").select(
        *SOURCE_COLUMNS, "ingested_at", F.split(REASONS, ",").alias(REASONS), *lines
    )


def violations(checked: DataFrame) -> DataFrame:
    """One row per (event, reason).

    Filtered after the split: a filter on the reason text would be pushed below
    ``check`` and work out every rule a second time.
    """
    each = checked.select("event_id", F.explode(F.split(REASONS, ",")).alias("reason"))
    return each.filter(F.col("reason") != "")


