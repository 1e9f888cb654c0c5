"""Aggregate measures whose value does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Currency and distances carry two decimals.
MEASURE_SCALE = 2


# Fixed-point places kept while adding up, and the low bits counted apart: a
# BIGINT pair then holds the sum of 8 * 10^12 rows of up to 9 * 10^12 each.
PLACES = 6
LOW_BITS = 20
LIMIT = 9e12


def fixed_parts(value: Column) -> tuple[Column, Column, Column]:
    """A value in millionths, as high and low BIGINT part, and the value itself if it does not fit."""
    number = value.cast("double")
    fits = F.abs(number) < LIMIT  # false for NaN, which is larger than any number
    units = F.when(fits, F.rint(number * 10**PLACES).cast("bigint"))
    return F.shiftright(units, LOW_BITS), units.bitwiseAND(F.lit((1 << LOW_BITS) - 1).cast("bigint")), F.when(~fits, number)


def exact_units(high: Column, low: Column) -> Column:
    """The sum in millionths, as DECIMAL(38,0), from the sums of the two parts."""
    return (high.cast("decimal(28,0)") * F.lit(1 << LOW_BITS).cast("decimal(9,0)") + low.cast("decimal(28,0)")).cast("decimal(38,0)")


def stable_sum(column: str | Column, scale: int | None = MEASURE_SCALE) -> Column:
    """Sum of a DOUBLE column, added up in fixed-point and rounded once to ``scale`` decimals.

    A floating-point sum changes with the order in which partitions are
    combined; whole millionths add up exactly, so the result is the same for
    any partitioning.  They are summed as two BIGINTs (high and low part), so
    no sum overflows and every buffer stays a machine word.  Values that are
    no such number (NaN, infinite, 9e12 and more) are added as floating point,
    in which NaN propagates.  ``scale=None`` returns the raw floating-point sum.
    """
    value = F.col(column) if isinstance(column, str) else column
    if scale is None:
        return F.sum(value)
    high, low, odd = (F.sum(part) for part in fixed_parts(value))
    exact = exact_units(high, low).cast("decimal(38,6)") / F.lit(10**PLACES).cast("decimal(8,0)")
    exact = F.round(exact, scale).cast("double")
    return F.when(odd.isNull(), exact).otherwise(F.round(odd + F.coalesce(exact, F.lit(0.0)), scale))
