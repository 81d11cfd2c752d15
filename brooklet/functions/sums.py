"""Exact sums of whole numbers over any number of rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOW_BITS = 20


def high(whole: Column) -> Column:
    return F.shiftright(whole, LOW_BITS)


def low(whole: Column) -> Column:
    return whole.bitwiseAND(F.lit((1 << LOW_BITS) - 1))


def joined(high_sum: Column, low_sum: Column) -> Column:
    """The total, as decimal, from the sums of both parts."""
    return high_sum.cast("decimal(20,0)") * F.lit(1 << LOW_BITS) + low_sum.cast("decimal(20,0)")


def exact_sum(whole: Column) -> Column:
    """Sum of a bigint expression, the same for any row order.

    The low 20 bits and the rest are added up apart, so that neither long
    overflows: amounts below 10^10 cents are safe for 8 * 10^12 rows, where a
    plain long sum gives out at 9 * 10^8. Long sums stay in generated code; a sum
    of decimals wider than 18 digits does not and takes several times as long.
    """
    return joined(F.sum(high(whole)), F.sum(low(whole)))
