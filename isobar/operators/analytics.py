"""Reports over the gold tables. Each takes the column it reports on, so that any variable can be asked for."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.functions.dates import month_start
from isobar.functions.numeric import round_half_up


def region_list(regional: DataFrame) -> DataFrame:
    return regional.select("region").distinct()


def regional_trend(regional: DataFrame, value: str = "temp_mean", name: str = "tmp_mean") -> DataFrame:
    return regional.select("region", F.col("date").alias("day"), F.col(value).alias(name)).orderBy("day", "region")


def monthly_averages(regional: DataFrame, value: str = "temp_mean", name: str = "tmp_avg") -> DataFrame:
    return (
        regional.groupBy("region", month_start(F.col("date")).alias("month"))
        .agg(round_half_up(F.avg(value), 2).alias(name))
        .orderBy("month", name, "region")
    )


def monthly_summary(
    regional: DataFrame, mean: str = "temp_mean", peak: str = "temp_max", name: str = "tmp"
) -> DataFrame:
    """Monthly average and maximum of a variable per region, with the number of days behind them."""
    return (
        regional.groupBy("region", month_start(F.col("date")).alias("month"))
        .agg(
            round_half_up(F.avg(mean), 2).alias(f"{name}_avg"),
            round_half_up(F.max(peak), 2).alias(f"{name}_max"),
            F.count(F.lit(1)).alias("days_in_month"),
        )
        .orderBy("month", f"{name}_avg", "region")
    )


def compare_regions(regional: DataFrame, value: str = "temp_mean", name: str = "tmp_avg") -> DataFrame:
    return (
        regional.groupBy(F.col("date").alias("day"), "region")
        .agg(round_half_up(F.avg(value), 2).alias(name))
        .orderBy("day", "region")
    )


def rolling_mean(
    regional: DataFrame, rows: int, value: str = "temp_mean", name: str = "tmp_mean", rolled: str | None = None
) -> DataFrame:
    """Mean over the current and the ``rows - 1`` preceding rows of a region; gaps are not filled.

    A window partition holds one row per calendar day of a region, whatever the size of the
    grid below it, so it stays small.
    """
    frame = Window.partitionBy("region").orderBy("day").rowsBetween(1 - rows, 0)
    return (
        regional.select("region", F.col("date").alias("day"), value)
        .select(
            "region",
            "day",
            round_half_up(F.col(value), 2).alias(name),
            round_half_up(F.avg(value).over(frame), 2).alias(rolled or f"tmp_avg_rolling_{rows}d"),
        )
        .orderBy("day", "region")
    )


def top_days(df: DataFrame, by: list[Column], value: str, name: str, n: int) -> DataFrame:
    """The ``n`` days with the highest value per group, ranked on the unrounded value; ties go to the earlier day.

    Several rows of one day count as one: every task first takes the peak per group and day in a hash aggregate and then keeps its
    own best ``n``, so a hot group is small by the time it is ranked.
    """
    day = F.col("date").alias("day")
    peaks = df.groupBy(*by, day).agg(F.max(value).alias("peak"))
    keys = [c for c in peaks.columns if c not in ("day", "peak")]
    order = Window.partitionBy(*keys).orderBy(F.desc("peak"), F.asc("day"))
    return (
        peaks.withColumn("rank", F.row_number().over(order).cast("bigint"))
        .where(F.col("rank") <= n)
        .select(*keys, "day", round_half_up(F.col("peak"), 2).alias(name), "rank")
        .orderBy(F.asc("rank"), F.desc(name), *keys)
    )


def hottest_days(regional: DataFrame, n: int = 50, value: str = "temp_max", name: str = "tmp_max") -> DataFrame:
    return top_days(regional, [F.col("region")], value, name, n)


def coarse(coordinate: Column) -> Column:
    """Whole degrees; adding zero turns -0.0 into 0.0."""
    return F.round(coordinate, 0) + F.lit(0.0)


def hottest_day_per_location(
    cells: DataFrame, threshold: float = 45.0, n: int = 1, value: str = "temperature_2m_max", name: str = "tmp_max"
) -> DataFrame:
    """The hottest days of each one-degree location, among cells at or above the threshold."""
    hot = cells.where(F.col(value) >= F.lit(threshold))
    by = [coarse(F.col("longitude")).alias("rlongitude"), coarse(F.col("latitude")).alias("rlatitude")]
    return top_days(hot, by, value, name, n)


def coarsen_grid(cells: DataFrame, value: str = "temperature_2m_max") -> DataFrame:
    """Cells gathered into one-degree locations: how many, and their highest value."""
    return cells.groupBy(
        coarse(F.col("longitude")).alias("rlongitude"), coarse(F.col("latitude")).alias("rlatitude")
    ).agg(F.count(F.lit(1)).alias("cells"), F.max(value).alias(f"{value}_max"))


def diurnal_range(
    cells: DataFrame,
    day: date | None = None,
    lat_min: float = 25.0,
    lat_max: float = 60.0,
    min_range: float = 20.0,
) -> DataFrame:
    """Cells of a latitude belt whose daily maximum and minimum are more than ``min_range`` apart."""
    if day is not None:
        cells = cells.where(F.col("date") == F.lit(day))
    spread = F.col("temperature_2m_max") - F.col("temperature_2m_min")
    return cells.where(F.col("latitude").between(lat_min, lat_max) & (spread > F.lit(min_range))).select(
        "date",
        "latitude",
        "longitude",
        F.col("temperature_2m_min").alias("min_tmp"),
        F.col("temperature_2m_mean").alias("mean_tmp"),
        F.col("temperature_2m_max").alias("max_tmp"),
    )
