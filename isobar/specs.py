"""What a valid day of observations looks like, and the regions days are averaged over."""

from __future__ import annotations

import json

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


@dataclass(frozen=True)
class ColumnSpec:
    """A required column. Values equal to a bound are valid."""

    name: str
    dtype: str
    lower: float | None = None
    upper: float | None = None

    @property
    def bounded(self) -> bool:
        return self.lower is not None or self.upper is not None


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    coordinates: tuple[ColumnSpec, ...]
    variables: tuple[ColumnSpec, ...]
    time_steps: int | None = None

    @property
    def variable_names(self) -> tuple[str, ...]:
        return tuple(v.name for v in self.variables)


@dataclass(frozen=True)
class Region:
    """A latitude/longitude box; both ends are inclusive and boxes may overlap."""

    name: str
    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


@dataclass(frozen=True)
class Derived:
    """A derived variable: the columns it needs and its attributes."""

    name: str
    inputs: tuple[str, ...]
    units: str
    long_name: str
    description: str

    @property
    def attributes(self) -> dict[str, str]:
        return {"units": self.units, "long_name": self.long_name, "description": self.description}


# Physical bounds, time steps per day, null threshold, region boxes, units, attribute texts, rollup statistics.
HOURLY_GRID = DatasetSpec(
    name="hourly_grid",
    coordinates=(
        ColumnSpec("time", "timestamp"),
        ColumnSpec("latitude", "double", -90.0, 90.0),
        ColumnSpec("longitude", "double", -180.0, 180.0),
    ),
    variables=(
        ColumnSpec("precipitation_surface", "float", 0.0, 1.0),
        ColumnSpec("temperature_2m", "double", -80.0, 54.0),
        ColumnSpec("wind_u_10m", "double", -97.0, 88.0),
        ColumnSpec("wind_v_10m", "double", -88.0, 89.0),
    ),
    time_steps=24,
)
NULL_THRESHOLD = 10.0
REGIONS = (
    Region("europe", 35.0, 70.0, -10.0, 40.0),
    Region("north_america", 15.0, 70.0, -160.0, -50.0),
    Region("global", -90.0, 90.0, -180.0, 180.0),
)
DERIVED = (
    Derived(
        "wind_speed_10m",
        ("wind_u_10m", "wind_v_10m"),
        "m/s",
        "Wind Speed 10 meters above earth surface",
        "Derived from u and v components.",
    ),
    Derived(
        "wind_direction_10m",
        ("wind_u_10m", "wind_v_10m"),
        "degrees",
        "10m Meteorological Wind Direction",
        "Direction the wind is coming from (0=North, 90=East, 180=South, 270=West).",
    ),
    Derived(
        "precipitation_mm_per_hour",
        ("precipitation_surface",),
        "mm/h",
        "Hourly Precipitation Accumulation",
        "Derived assuming surface precipitation rate is in kg/m^2/s.",
    ),
)
CELL_STATS = {"temperature_2m": ("mean", "min", "max"), "wind_speed_10m": ("mean", "max")}
REGION_STATS = {"temperature_2m": ("mean", "max"), "wind_speed_10m": ("mean", "max")}
GOLD_INPUTS = ("temperature_2m", "wind_speed_10m")
GOLD_TABLES = ("daily_global", "daily_regional")
SOURCE_NAME = "NOAA_GFS"


def region_frame(spark: SparkSession, regions: tuple[Region, ...] = REGIONS) -> DataFrame:
    """The regions as a table (region, lat_min, lat_max, lon_min, lon_max)."""

    def row(r: Region) -> Column:
        return F.struct(
            F.lit(r.name).alias("region"),
            F.lit(float(r.lat_min)).alias("lat_min"),
            F.lit(float(r.lat_max)).alias("lat_max"),
            F.lit(float(r.lon_min)).alias("lon_min"),
            F.lit(float(r.lon_max)).alias("lon_max"),
        )

    return spark.range(1).select(F.inline(F.array(*[row(r) for r in regions])))


def declared(text: str) -> dict[str, object]:
    """Regions, null threshold and statistics of a deployment from JSON, under the names that ``Elt`` takes.

    ``regions`` is a list of objects with name, lat_min, lat_max, lon_min and lon_max; ``cell_stats`` and ``region_stats`` map a
    variable to a list of statistics; ``threshold`` is a percentage. What is not given keeps its default.
    """
    found: dict[str, object] = json.loads(text)
    if unknown := set(found) - {"regions", "threshold", "cell_stats", "region_stats"}:
        raise ValueError(f"unknown declarations: {', '.join(sorted(unknown))}")
    if "regions" in found:
        found["regions"] = tuple(Region(**region) for region in found["regions"])
    for key in ("cell_stats", "region_stats"):
        if key in found:
            found[key] = {variable: tuple(names) for variable, names in found[key].items()}
            if odd := {s for names in found[key].values() for s in names} - {"mean", "min", "max", "sum"}:
                raise ValueError(f"unknown statistics: {', '.join(sorted(odd))}")
    return found
