"""Sums of doubles that do not depend on the order of the rows.

A value is split into whole numbers: its integer part and two limbs of 24 bits below the point. Whole numbers add up exactly, so the sum of
the limbs is the same over any partitions, and putting them together rounds once. Values below 2^31 with no bits beyond the 48th after
the point, which all 4-byte floats from 2^-24 on are, add up without any error; smaller bits are cut off, from each value by itself. Values from
2^31 on, infinities and NaN cannot be split; those are added as doubles.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

LIMB = 2.0**24
SPLIT_BELOW = 2.0**31
#: The parts of a sum, as suffixes of stored columns, and their types.
PARTS = {"whole": "bigint", "high": "bigint", "low": "bigint", "rest": "double"}


def limbs(value: Column) -> dict[str, Column]:
    """What of a value goes to each part; casts cut towards zero, so that every step is exact."""
    number = value.cast("double")
    small = F.when(F.abs(number) < SPLIT_BELOW, number)
    whole = small.cast("bigint")
    scaled = (small - whole) * LIMB
    high = scaled.cast("bigint")
    low = ((scaled - high) * LIMB).cast("bigint")
    return {"whole": whole, "high": high, "low": low, "rest": F.when(~(F.abs(number) < SPLIT_BELOW), number)}


def sum_parts(value: Column) -> dict[str, Column]:
    """The parts of the sum of a column, as aggregates."""
    return {part: F.sum(limb) for part, limb in limbs(value).items()}


def joined(parts: dict[str, Column]) -> Column:
    """The sum that added-up parts make: rounded once to a double. NULL where no value was added."""
    zero = F.lit(0).cast("bigint")
    whole, high, low = (F.coalesce(parts[p], zero).cast("decimal(19,0)") for p in ("whole", "high", "low"))
    limb = F.lit(int(LIMB)).cast("decimal(8,0)")
    fixed = ((whole * limb + high) * limb + low).cast("double") / (LIMB * LIMB)
    none = parts["whole"].isNull() & parts["rest"].isNull()
    return F.when(~none, F.when(parts["rest"].isNull(), fixed).otherwise(fixed + parts["rest"]))


def exact_sum(value: Column) -> Column:
    return joined(sum_parts(value))


def exact_mean(value: Column) -> Column:
    return exact_sum(value) / F.nullif(F.count(value), F.lit(0))
