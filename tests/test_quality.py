from __future__ import annotations

from collections import Counter
from datetime import date, datetime, timedelta

import pytest

from isobar.operators import audit, lineage, quality
from isobar.operators.silver import drop_null_variables, to_silver, variable_catalog
from isobar.specs import HOURLY_GRID, DatasetSpec
from tests.frames import day_rows, observations

DAY = date(2024, 3, 1)
HUNDRED = tuple((float(i), 0.0) for i in range(-50, 50))
ANY_STEPS = DatasetSpec(HOURLY_GRID.name, HOURLY_GRID.coordinates, HOURLY_GRID.variables, None)


def messages(df, spec=HOURLY_GRID):
    return [r.message for r in quality.quality_violations(quality.day_profile(df, spec), spec).collect()]


@pytest.mark.parametrize("nulls, dropped", [(9, False), (10, False), (11, True), (100, True)])
def test_null_rule_keeps_exactly_ten_percent(spark, nulls, dropped):
    df = observations(spark, day_rows(DAY, HUNDRED, 1, temperature_2m=lambda hour, cell: None if cell < nulls else 1.0))
    flags = quality.null_share_flags(quality.day_profile(df)).where("variable = 'temperature_2m'").first()
    assert flags.dropped is dropped
    assert flags.null_percentage == (1.0 - (100 - nulls) / 100) * 100


@pytest.mark.parametrize("value, passes", [(54.0, True), (-80.0, True), (54.125, False), (-80.125, False)])
def test_bounds_are_inclusive(spark, value, passes):
    found = messages(observations(spark, day_rows(DAY, temperature_2m=lambda hour, cell: value if hour == 5 else 0.0)))
    assert (found == []) is passes


def test_message_texts(spark):
    hot = day_rows(DAY, temperature_2m=60.0, cells=((91.0, 181.0),), hours=23)
    assert messages(observations(spark, hot)) == [
        "Coordinate 'latitude' max value 91.0 is above 90.0",
        "Coordinate 'longitude' max value 181.0 is above 180.0",
        "Variable 'temperature_2m' max value 60.0 is above 54.0",
        "Expected 24 time steps, but found 23",
    ]
    cold = day_rows(DAY, precipitation_surface=-0.5)
    assert messages(observations(spark, cold)) == ["Variable 'precipitation_surface' min value -0.5 is below 0.0"]


def test_variable_without_values_passes_the_gate_and_is_dropped(spark):
    df = observations(spark, day_rows(DAY, precipitation_surface=None))
    status = quality.day_status(quality.day_profile(df)).first()
    assert status.passed and status.reason is None and status.precipitation_surface__drop


def test_missing_columns_are_reported(spark):
    df = observations(spark, day_rows(DAY)).drop("longitude", "wind_u_10m")
    assert messages(df) == ["Missing coordinate: 'longitude'", "Missing variable: 'wind_u_10m'"]
    assert messages(observations(spark, day_rows(DAY)).drop("time")) == [
        "Missing coordinate: 'time'",
        "Missing 'time' dimension.",
    ]


def test_steps_are_checked_only_if_declared(spark):
    assert messages(observations(spark, day_rows(DAY, hours=3)), ANY_STEPS) == []


def test_a_duplicated_hour_is_no_extra_step(spark):
    rows = day_rows(DAY)
    df = observations(spark, rows, rows[:1])
    assert messages(df) == []
    assert audit.duplicate_observations(df).count() == 1
    check = audit.hours_check(df, 1).first()
    assert check.hours_equal and check.duplicate_timestamps


def test_all_reasons_of_a_day_are_collected(spark):
    df = observations(spark, day_rows(DAY, hours=23, temperature_2m=60.0), day_rows(date(2024, 3, 2)))
    status = {r.date: r for r in quality.day_status(quality.day_profile(df)).collect()}
    assert status[DAY].reason == (
        "Data Quality Validation Failed:\n- Variable 'temperature_2m' max value 60.0 is above 54.0"
        "\n- Expected 24 time steps, but found 23"
    )
    assert status[date(2024, 3, 2)].passed


def test_split_is_whole(spark):
    df = observations(spark, day_rows(DAY, hours=23), day_rows(date(2024, 3, 2)))
    status = quality.day_status(quality.day_profile(df))
    assert quality.passed(df, status).count() == 24
    assert quality.quarantined(df, status).count() == 23


def test_no_rows_no_days(spark):
    empty = observations(spark, [])
    assert quality.day_profile(empty).count() == 0
    assert messages(empty) == []


def test_dtype_check_is_opt_in(spark):
    df = observations(spark, day_rows(DAY))
    assert messages(df) == []
    assert quality.dtype_violations(df) == ["Column 'precipitation_surface' is double, declared float"]


def test_dropped_inputs_leave_derivations_null(spark):
    df = observations(
        spark,
        day_rows(DAY, wind_v_10m=lambda hour, cell: None if hour < 6 else 4.0),
        day_rows(date(2024, 3, 2), wind_v_10m=lambda hour, cell: None if hour < 2 else 4.0),
    )
    status = quality.day_status(quality.day_profile(df))
    silver = to_silver(df, status)
    assert silver.where("date = '2024-03-01' AND wind_speed_10m IS NOT NULL").count() == 0
    assert silver.where("date = '2024-03-01' AND wind_v_10m IS NOT NULL").count() == 0
    assert silver.where("date = '2024-03-02' AND wind_speed_10m = 5.0").count() == 22
    assert drop_null_variables(df, status).count() == df.count()
    failed = {r.date: (r.stage, r.reason) for r in lineage.failed_days(status).collect()}
    assert failed == {DAY: ("gold", "Missing variable: wind_speed_10m")}


def test_dropped_precipitation_does_not_block_gold(spark):
    status = quality.day_status(quality.day_profile(observations(spark, day_rows(DAY, precipitation_surface=None))))
    assert [r.date for r in lineage.gold_ready(status).collect()] == [DAY]
    record = lineage.silver_lineage(status).first()
    assert record.variables_dropped == ["precipitation_surface"]
    assert record.variables_derived == ["wind_direction_10m", "wind_speed_10m"]
    assert record.variables == ["temperature_2m", "wind_direction_10m", "wind_speed_10m", "wind_u_10m", "wind_v_10m"]


def test_variable_catalog(spark):
    df = observations(spark, day_rows(DAY))
    rows = variable_catalog(to_silver(df, quality.day_status(quality.day_profile(df)))).collect()
    assert [(r.variable, r.units, r.n_values) for r in rows] == [
        ("wind_speed_10m", "m/s", 24),
        ("wind_direction_10m", "degrees", 24),
        ("precipitation_mm_per_hour", "mm/h", 24),
    ]


@pytest.mark.parametrize("steps", [24, 96])
def test_time_checks_equal_brute_force(spark, steps):
    """Hourly, off-hour and sub-second times, some of them twice, one cell without a longitude."""
    start = datetime(2024, 3, 1)
    offsets = [(i * 37 % 172_800) * 1_000 + (500 if i % 11 == 0 else 0) for i in range(400)]
    offsets += [h * 3_600_000 for h in range(48)] + [3_600_000, 3_600_000, 37_000, 0]
    rows = [
        (start + timedelta(milliseconds=ms), 1.0 + i % 3, None if i % 5 == 0 else 2.0) for i, ms in enumerate(offsets)
    ] + [(start, 1.0, None), (start, 1.0, None)]
    df = spark.createDataFrame(rows, "time timestamp, latitude double, longitude double").repartition(5)
    counts = Counter(rows)
    wanted = {key: n for key, n in counts.items() if n > 1}
    assert wanted
    found = {(r.time, r.latitude, r.longitude): r.copies for r in audit.duplicate_observations(df, steps).collect()}
    assert found == wanted
    check = audit.hours_check(df, 2, steps).first()
    assert check.ingested_hours == len({time for time, _, _ in rows}) and check.duplicate_timestamps
    single = df.dropDuplicates()
    assert audit.duplicate_observations(single, steps).count() == 0
    assert not audit.hours_check(single, 2, steps).first().duplicate_timestamps


def test_hours_of_no_rows(spark):
    check = audit.hours_check(observations(spark, []), 1).first()
    assert tuple(check) == (24, 0, False, False)
