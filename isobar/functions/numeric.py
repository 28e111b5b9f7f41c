"""Rounding that gives the same digits whatever order a mean was summed in."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

EXACT_BELOW = 1e13


def round_half_up(value: Column, digits: int) -> Column:
    """Round through a decimal, so that noise in the last bits of a double cannot flip a tie.

    From 10^13 on, where a double has fewer than three decimals left, it is rounded as it is. NaN stays NaN.
    """
    through = F.round(value.cast("decimal(24,10)"), digits).cast("double")
    return F.when(F.abs(value) < EXACT_BELOW, through).otherwise(F.round(value.cast("double"), digits))


def null_percentage(non_null: Column, total: Column) -> Column:
    """Null share in percent, in the one double expression the 10 % rule is defined by."""
    return (F.lit(1.0) - non_null.cast("double") / total.cast("double")) * F.lit(100.0)
