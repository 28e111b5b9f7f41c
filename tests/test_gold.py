from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.operators import gold
from isobar.specs import REGIONS, Region, region_frame

DAY = date(2024, 3, 1)


def cells(spark, *points):
    return spark.createDataFrame([(DAY, lat, lon) for lat, lon in points], "date date, latitude double, longitude double")


@pytest.mark.parametrize(
    "point, names",
    [
        ((35.0, -10.0), {"europe", "global"}),
        ((70.0, 40.0), {"europe", "global"}),
        ((15.0, -160.0), {"north_america", "global"}),
        ((70.0, -50.0), {"north_america", "global"}),
        ((34.75, 0.0), {"global"}),
        ((70.25, 0.0), {"global"}),
        ((-90.0, 179.75), {"global"}),
        ((90.0, -180.0), {"global"}),
    ],
)
def test_region_edges_are_inclusive(spark, point, names):
    assert {r.region for r in gold.assign_regions(cells(spark, point)).collect()} == names


def test_binned_join_equals_broadcast_join(spark):
    grid = spark.range(0, 721 * 12).select(
        F.lit(DAY).alias("date"),
        (F.lit(90.0) - F.col("id") % 721 * 0.25).alias("latitude"),
        (F.lit(-180.0) + F.floor(F.col("id") / 721) * 30.25).alias("longitude"),
    )
    wanted = sorted(map(tuple, gold.assign_regions(grid).collect()))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    binned = gold.assign_regions(grid, REGIONS)
    assert "SortMergeJoin" in binned._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastNestedLoopJoin" not in binned._jdf.queryExecution().toString()
    assert sorted(map(tuple, binned.collect())) == wanted
    table = gold.assign_regions(grid, region_frame(spark))
    assert sorted(map(tuple, table.collect())) == wanted


def test_empty_box_gives_no_row(spark):
    boxes = (Region("nowhere", 0.0, 1.0, 0.0, 1.0),)
    assert gold.assign_regions(cells(spark, (50.0, 10.0)), boxes).count() == 0


def silver(spark, rows):
    return spark.createDataFrame(
        [(DAY, *r) for r in rows],
        "date date, latitude double, longitude double, temperature_2m double, wind_speed_10m double",
    )


def test_daily_rollup_skips_nulls_and_keeps_empty_cells(spark):
    rows = [(50.0, 10.0, 1.0, 2.0), (50.0, 10.0, None, 4.0), (50.0, 10.0, 4.0, None), (60.0, 10.0, None, None)]
    got = {r.latitude: r for r in gold.daily_rollup(silver(spark, rows)).collect()}
    full, empty = got[50.0], got[60.0]
    assert (full.temperature_2m_mean, full.temperature_2m_min, full.temperature_2m_max) == (2.5, 1.0, 4.0)
    assert (full.wind_speed_10m_mean, full.wind_speed_10m_max) == (3.0, 4.0)
    assert empty.temperature_2m_mean is None and empty.wind_speed_10m_max is None


def test_regional_mean_is_over_hours_and_cells_at_once(spark):
    rows = [(50.0, 10.0, 0.0, 1.0), (50.0, 10.0, 0.0, 1.0), (50.0, 10.0, 0.0, 1.0), (51.0, 10.0, 8.0, 1.0), (51.0, 10.0, None, 1.0)]
    df = silver(spark, rows)
    regional = {r.region: r for r in gold.regional_rollup(df).collect()}
    mean_of_means = gold.daily_rollup(df).agg(F.avg("temperature_2m_mean")).first()[0]
    assert regional["europe"].temperature_2m_mean == 2.0
    assert mean_of_means == 4.0


def test_statistics_are_a_parameter(spark):
    df = silver(spark, [(50.0, 10.0, 1.0, 2.0), (50.0, 10.0, 3.0, 2.0)])
    got = gold.regional_rollup(df, stats={"temperature_2m": ("min", "mean", "max")}).where("region = 'europe'").first()
    assert (got.temperature_2m_min, got.temperature_2m_mean, got.temperature_2m_max) == (1.0, 2.0, 3.0)


def test_conditional_aggregates_equal_the_join(spark):
    rows = [(35.0 + i % 40, -20.0 + i % 70, None if i % 7 == 0 else i / 8, i % 50 / 8) for i in range(500)]
    df = silver(spark, rows)
    wanted = sorted(map(tuple, gold.regional_rollup(df, region_frame(spark)).collect()))
    inline = gold.regional_rollup(df)
    assert "Join" not in inline._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, inline.collect())) == wanted
    assert gold.regional_rollup(df.where("latitude < 0")).count() == 0


def some_boxes(n):
    """Overlapping boxes; every third shares its name with another one."""
    return tuple(
        Region(f"r{i - i % 3 if i % 3 == 2 else i}", -80.0 + i % 40, -70.0 + 3 * (i % 40), -170.0 + i, -150.0 + 2 * (i % 100)) for i in range(n)
    )


@pytest.mark.parametrize("n", [1, 2, 8, 9, 20, 300])
def test_boxes_of_one_name_are_one_region_in_either_form(spark, n):
    rows = [(DAY, -85.0 + i % 170, -175.0 + (i * 7) % 350, i / 8, i % 50 / 8) for i in range(600)]
    df = spark.createDataFrame(rows, "date date, latitude double, longitude double, temperature_2m double, wind_speed_10m double")
    boxes = some_boxes(n)
    joined = gold.regional_rollup(df, region_frame(spark, boxes))
    assert "NestedLoop" not in joined._jdf.queryExecution().executedPlan().toString()
    wanted = {}
    for _, lat, lon, t, _ in rows:
        for name in {b.name for b in boxes if b.lat_min <= lat <= b.lat_max and b.lon_min <= lon <= b.lon_max}:
            wanted.setdefault(name, []).append(t)
    expected = {name: (sum(t) / len(t), max(t)) for name, t in wanted.items()}
    forms = [joined] + ([gold.regional_rollup(df, boxes)] if n <= 20 else [])
    for form in forms:
        assert {r.region: (r.temperature_2m_mean, r.temperature_2m_max) for r in form.collect()} == expected


def test_rollups_from_totals_equal_rollups_from_silver(spark):
    rows = [(DAY, 35.0 + i % 4, i % 3 * 1.0, None if i % 5 == 0 else i / 8, i / 4) for i in range(90)]
    df = spark.createDataFrame(rows, "date date, latitude double, longitude double, temperature_2m double, wind_speed_10m double")
    stats = {"temperature_2m": ("mean", "min", "max"), "wind_speed_10m": ("mean",)}
    totals = gold.cell_totals(df, stats)
    assert sorted(gold.cells_from_totals(totals, stats).collect()) == sorted(gold.daily_rollup(df, stats).collect())
    from_cells = gold.regions_from_totals(totals, REGIONS, stats)
    assert sorted(from_cells.collect()) == sorted(gold.regional_rollup(df, REGIONS, stats).collect())
