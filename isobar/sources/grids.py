"""Dense arrays to rows and back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from isobar.specs import HOURLY_GRID

# The grid starts at 90 N, 180 W and steps a quarter degree south and east.
NORTH, WEST, STEP = 90.0, -180.0, 0.25


def flatten(df: DataFrame, values: str, width: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per array element, with the coordinates computed from its position.

    ``width`` is the number of longitudes per row of the grid.
    """
    cells = df.select(*keep, F.posexplode(values).alias("position", "value"))
    return cells.select(
        *keep,
        "position",
        (F.lit(NORTH) - F.lit(STEP) * F.floor(F.col("position") / width)).alias("latitude"),
        (F.lit(WEST) + F.lit(STEP) * (F.col("position") % width)).alias("longitude"),
        F.col("value").cast("double").alias("value"),
    )


def pack(df: DataFrame, value: str, order: tuple[str, ...] = ("time",), most: int = HOURLY_GRID.time_steps) -> DataFrame:
    """The values of a cell and day as one array in time order: (date, latitude, longitude, rows, values).

    A cell and day has one row per declared time step, so ``most`` bounds an array. Where there are more rows, the array is NULL and
    ``rows`` says how many there are: such a cell is counted, never collected.
    """
    keys = ("date", "latitude", "longitude")
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    few = counts.where(F.col("rows") <= most).select(*[F.col(k).alias(f"{k}_") for k in keys])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"{k}_")) for k in keys])
    entry = F.struct(*order, F.col(value).alias("packed"))
    packed = (
        df.join(few, same, "left_semi")
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"), F.sort_array(F.collect_list(entry)).alias("entries"))
        .select(*keys, "rows", F.transform("entries", lambda e: e["packed"]).alias("values"))
    )
    more = counts.where(F.col("rows") > most).withColumn("values", F.lit(None).cast(packed.schema["values"].dataType))
    return packed.unionByName(more)
