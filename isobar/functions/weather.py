"""Derived weather variables as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from isobar.specs import DERIVED

SECONDS_PER_HOUR = 3600.0


def wind_speed(u: Column, v: Column) -> Column:
    return F.sqrt(u * u + v * v)


def wind_direction(u: Column, v: Column) -> Column:
    """Direction the wind comes from, in [0, 360). Calm air gives 270."""
    heading = F.lit(270.0) - F.lit(180.0 / math.pi) * F.atan2(v, u)
    return F.pmod(heading, F.lit(360.0))


def precipitation_mm_per_hour(rate: Column) -> Column:
    """kg/m2/s to mm/h: one kg of water on one square metre is one millimetre deep."""
    return rate * F.lit(SECONDS_PER_HOUR)


FORMULAS = {
    "wind_speed_10m": wind_speed,
    "wind_direction_10m": wind_direction,
    "precipitation_mm_per_hour": precipitation_mm_per_hour,
}


def derived_columns(available: list[str]) -> list[Column]:
    """Every derived variable whose inputs are available, carrying its attributes as metadata."""
    return [
        FORMULAS[d.name](*[F.col(i).cast("double") for i in d.inputs]).alias(d.name, metadata=d.attributes)
        for d in DERIVED
        if all(i in available for i in d.inputs)
    ]
