"""Calendar expressions and day lists."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SECONDS_PER_DAY = 86_400


def utc_day(moment: Column) -> Column:
    """The calendar day of an instant in UTC, whatever the session's time zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(moment) / SECONDS_PER_DAY).cast("int"))


def next_day(day: Column) -> Column:
    return F.date_add(day, 1)


def days_between(first: Column, second: Column) -> Column:
    """Signed number of days from ``first`` to ``second``."""
    return F.datediff(second, first)


def day_list(start: Column, duration: Column | int) -> Column:
    """Array of the ``duration + 1`` days from ``start`` on."""
    duration = F.lit(duration) if isinstance(duration, int) else duration
    return F.sequence(start, F.date_add(start, duration))


def day_text(moment: Column) -> Column:
    return F.date_format(moment, "yyyy-MM-dd")


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM")


def day_from_path(path: Column) -> Column:
    """The day that a folder of the path names, as ``date=1995-01-02`` or bare; NULL if none names a day that exists."""
    names = F.transform(F.split(path, "/"), lambda part: F.element_at(F.split(part, "="), -1))
    days = F.transform(F.filter(names, lambda name: F.length(name) == 10), lambda name: name.try_cast("date"))
    return F.get(F.filter(days, lambda day: day.isNotNull()), F.lit(0))


def day_range(first: date, last: date) -> list[date]:
    """Inclusive list of days for a backfill request."""
    return [first + timedelta(days=i) for i in range((last - first).days + 1)]


def days_frame(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day from ``first`` to ``last``, both inclusive."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
