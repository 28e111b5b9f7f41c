from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.functions import dates, numeric, text, weather


@pytest.mark.parametrize(
    "u, v, degrees",
    [(0.0, -1.0, 0.0), (-1.0, 0.0, 90.0), (0.0, 1.0, 180.0), (1.0, 0.0, 270.0), (0.0, 0.0, 270.0), (None, 1.0, None)],
)
def test_wind_direction(spark, u, v, degrees):
    df = spark.createDataFrame([(u, v)], "u double, v double")
    got = df.select(weather.wind_direction(F.col("u"), F.col("v"))).first()[0]
    assert got == (None if degrees is None else pytest.approx(degrees, abs=1e-9))


def test_wind_direction_stays_below_360(spark):
    df = spark.range(3600).select(F.sin(F.radians(F.col("id") / 10)).alias("u"), F.cos(F.radians(F.col("id") / 10)).alias("v"))
    low, high = df.select(weather.wind_direction(F.col("u"), F.col("v")).alias("d")).agg(F.min("d"), F.max("d")).first()
    assert 0 <= low and high < 360


def test_wind_speed_and_precipitation(spark):
    df = spark.createDataFrame([(3.0, 4.0, 0.5), (None, 4.0, None)], "u double, v double, p double")
    rows = df.select(
        weather.wind_speed(F.col("u"), F.col("v")), weather.precipitation_mm_per_hour(F.col("p"))
    ).collect()
    assert [tuple(r) for r in rows] == [(5.0, 1800.0), (None, None)]


def test_derived_columns_need_their_inputs(spark):
    df = spark.createDataFrame([(1.0,)], "precipitation_surface double")
    assert df.select(*weather.derived_columns(df.columns)).columns == ["precipitation_mm_per_hour"]


def test_derived_columns_carry_attributes(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "wind_u_10m double, wind_v_10m double")
    fields = df.select(*weather.derived_columns(df.columns)).schema.fields
    assert [(f.name, f.metadata["units"]) for f in fields] == [
        ("wind_speed_10m", "m/s"),
        ("wind_direction_10m", "degrees"),
    ]


@pytest.mark.parametrize(
    "size, shown",
    [
        (0, "0.00B"),
        (1023, "1023.00B"),
        (1024, "1.00KB"),
        (1152, "1.12KB"),
        (10_000_000_000_000, "9.09TB"),
        (800 * 10**6 * 365, "271.95GB"),
        (1024**5 * 5000, "5000.00PB"),
        (None, None),
    ],
)
def test_format_bytes(spark, size, shown):
    df = spark.createDataFrame([(None if size is None else float(size),)], "size double")
    assert df.select(text.format_bytes(F.col("size"))).first()[0] == shown


@pytest.mark.parametrize("name", ["daily_global", "wind_speed_10m", "a1b_c", "", "ALL_CAPS"])
def test_title_label(spark, name):
    df = spark.createDataFrame([(name,)], "name string")
    assert df.select(text.title_label(F.col("name"))).first()[0] == name.replace("_", " ").title()


def test_calendar(spark):
    start, later = F.lit(date(2025, 1, 1)), F.lit(date(2025, 1, 13))
    row = spark.range(1).select(
        dates.next_day(F.lit(date(2024, 2, 28))).alias("next"),
        dates.days_between(start, later).alias("gap"),
        dates.days_between(later, start).alias("back"),
        dates.day_list(start, 3).alias("days"),
        dates.month_start(later).alias("month"),
        dates.day_from_path(F.lit("bronze/date=2015-05-13/part-0.parquet")).alias("found"),
        dates.day_from_path(F.lit("bronze/date=2015-13-13/part-0.parquet")).alias("none"),
        dates.day_from_path(F.lit("s3://b/date=1995-01-02/x")).alias("early"),
        dates.day_from_path(F.lit("date=2024-02-31/x")).alias("no_such"),
        dates.day_from_path(F.lit("2024-02-29/date=2024-03-01")).alias("first"),
        dates.day_from_path(F.lit(None).cast("string")).alias("nothing"),
    ).first()
    assert row.next == date(2024, 2, 29)
    assert (row.gap, row.back) == (12, -12)
    assert row.days == [date(2025, 1, d) for d in (1, 2, 3, 4)]
    assert (row.month, row.found, row.none) == (date(2025, 1, 1), date(2015, 5, 13), None)
    assert (row.early, row.no_such, row.first, row.nothing) == (date(1995, 1, 2), None, date(2024, 2, 29), None)
    assert dates.day_range(date(2025, 1, 30), date(2025, 2, 1)) == [date(2025, 1, 30), date(2025, 1, 31), date(2025, 2, 1)]


def test_rounding_ignores_the_order_of_a_sum(spark):
    df = spark.createDataFrame([(1.005,), (1.00499999999999,), (-1.005,), (2.3449,)], "x double")
    got = [r[0] for r in df.select(numeric.round_half_up(F.col("x"), 2)).collect()]
    assert got == [1.01, 1.01, -1.01, 2.34]


def test_rounding_takes_any_double(spark):
    values = [2e14, -2e14, 1e300, float("inf"), None, 9.9e12 + 0.125]
    df = spark.createDataFrame([(v,) for v in [*values, float("nan")]], "x double")
    got = [r[0] for r in df.select(numeric.round_half_up(F.col("x"), 2)).collect()]
    assert got[:5] == values[:5] and got[5] == 9.9e12 + 0.13 and got[6] != got[6]
