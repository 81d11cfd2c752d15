"""Money expressions: half-up rounding and exact sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brooklet.functions.sums import exact_sum


def round_money(amount: Column) -> Column:
    """Round to cents, half up on the decimal text of the value."""
    return F.round(amount, 2)


def line_total(price: Column, quantity: Column) -> Column:
    return round_money(price * quantity)


def cents(rows: DataFrame, name: str) -> Column:
    """A cent-precise money column as whole cents; NULL where it is not a finite amount."""
    amount = F.col(name)
    if isinstance(rows.schema[name].dataType, T.DecimalType):
        return (amount * 100).cast("bigint")
    return F.when(is_countable(rows, name), F.rint(amount * 100).cast("bigint"))


def is_countable(rows: DataFrame, name: str) -> Column:
    """Whether an amount can be counted in cents: finite, and within a long."""
    if isinstance(rows.schema[name].dataType, T.DecimalType):
        return F.lit(True)
    return F.abs(F.nanvl(F.col(name), F.lit(float("inf")))) < 9e16


def total_money(rows: DataFrame, name: str, counted: Column | None = None) -> Column:
    """Exact sum of a money column, over the rows for which ``counted`` holds.

    NaN as soon as one of these amounts is not finite (or beyond 9e16): such a row is
    neither hidden nor does it stop the query. Reports that want such rows left out
    take theirs from ``accepted``.
    """
    amount = cents(rows, name)
    odd = F.col(name).isNotNull() & ~is_countable(rows, name)
    if counted is not None:
        amount, odd = F.when(counted, amount).otherwise(F.lit(0).cast("bigint")), odd & counted
    if isinstance(rows.schema[name].dataType, T.DecimalType):
        return as_money(exact_sum(amount))
    return F.when(F.count_if(odd) > 0, F.lit(float("nan"))).otherwise(as_money(exact_sum(amount)))


def as_money(total_cents: Column) -> Column:
    """Whole cents back to a double amount."""
    return total_cents.cast("double") / F.lit(100.0)
