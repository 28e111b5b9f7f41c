from __future__ import annotations

from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.operators import analytics, audit
from isobar.operators.profile import profile
from isobar.plans.marts import build_marts
from isobar.plans.reports import REPORTS

FIRST = date(2024, 1, 1)


def regional(spark, *rows):
    return spark.createDataFrame(
        [(FIRST + timedelta(days=d), region, float(t), float(x)) for region, d, t, x in rows],
        "date date, region string, temp_mean double, temp_max double",
    )


def test_rolling_frames_count_rows_not_days(spark):
    df = regional(spark, *[("a", d, d + 1, 0) for d in (0, 1, 2, 9)], ("b", 0, 100, 0))
    rows = analytics.rolling_mean(df, 3).where("region = 'a'").orderBy("day").collect()
    assert [r.tmp_avg_rolling_3d for r in rows] == [1.0, 1.5, 2.0, 5.0]


def test_rolling_mean_uses_unrounded_values(spark):
    df = regional(spark, ("a", 0, 0.004, 0), ("a", 1, 0.004, 0), ("a", 2, 0.008, 0))
    assert [r.tmp_avg_rolling_7d for r in analytics.rolling_mean(df, 7).orderBy("day").collect()] == [0.0, 0.0, 0.01]


def test_top_days_rank_on_the_unrounded_value(spark):
    df = regional(spark, ("a", 0, 0, 40.001), ("a", 1, 0, 40.004), ("a", 2, 0, 40.004), ("a", 3, 0, 1))
    rows = analytics.hottest_days(df, 3).collect()
    assert [(r.day.day, r.tmp_max, r["rank"]) for r in rows] == [(2, 40.0, 1), (3, 40.0, 2), (1, 40.0, 3)]


def test_top_days_have_a_first_in_every_group(spark):
    df = regional(spark, *[(f"r{i % 5}", i, 0, i) for i in range(50)])
    rows = analytics.hottest_days(df, 1).collect()
    assert {r.region for r in rows} == {f"r{i}" for i in range(5)} and {r["rank"] for r in rows} == {1}


def cell_table(spark, *rows):
    return spark.createDataFrame(
        [(FIRST + timedelta(days=d), lat, lon, lo, (lo + hi) / 2, hi) for d, lat, lon, lo, hi in rows],
        "date date, latitude double, longitude double,"
        " temperature_2m_min double, temperature_2m_mean double, temperature_2m_max double",
    )


def test_locations_are_whole_degrees(spark):
    df = cell_table(
        spark, (0, 10.25, 20.25, 0.0, 46.0), (1, 9.75, 19.75, 0.0, 47.0), (0, -0.25, 0.25, 0.0, 45.0), (0, 30.0, 30.0, 0.0, 44.9)
    )
    rows = analytics.hottest_day_per_location(df).collect()
    assert [(r.rlongitude, r.rlatitude, r.day.day, r.tmp_max) for r in rows] == [(20.0, 10.0, 2, 47.0), (0.0, 0.0, 1, 45.0)]
    assert str(rows[1].rlatitude) == "0.0"


def test_days_of_a_location_count_once(spark):
    df = cell_table(spark, (0, 10.25, 20.0, 0.0, 50.0), (0, 9.75, 20.0, 0.0, 49.0), (1, 10.0, 20.0, 0.0, 48.0))
    for n in (1, 2):
        rows = analytics.hottest_day_per_location(df, n=n).collect()
        assert [(r.day.day, r.tmp_max, r["rank"]) for r in rows] == [(1, 50.0, 1), (2, 48.0, 2)][:n]


def test_diurnal_range(spark):
    df = cell_table(spark, (0, 25.0, 0.0, 0.0, 20.5), (0, 60.0, 0.0, 0.0, 20.0), (1, 40.0, 0.0, 0.0, 30.0), (0, 61.0, 0.0, 0.0, 40.0))
    assert [r.latitude for r in analytics.diurnal_range(df, FIRST).collect()] == [25.0]
    assert analytics.diurnal_range(df).count() == 2


def test_any_variable_can_be_reported(spark):
    df = regional(spark, ("a", 0, 1, 5), ("a", 1, 3, 7))
    assert analytics.monthly_averages(df, "temp_max", "mx").first().mx == 6.0
    assert analytics.compare_regions(df, "temp_max", "mx").count() == 2


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows holds one value; the rest is spread, with nulls and a far outlier."""
    value = (
        F.when(F.col("id") % 3 == 0, 7.0)
        .when(F.col("id") == 1, -1e9)
        .when(F.col("id") % 10 == 1, F.lit(None))
        .otherwise((F.col("id") * 7919 % 5000) / 16)
    )
    return spark.range(20_000).select(
        value.alias("x"),
        F.when(F.col("id") < 0, 1.0).alias("void"),
        (F.col("id") % 4).cast("int").alias("k"),
        F.concat(F.lit("s"), (F.col("id") % 37).cast("string")).alias("name"),
        F.date_add(F.lit(FIRST), (F.col("id") % 100).cast("int")).alias("day"),
    )


def test_exact_profile_equals_brute_force(skewed):
    table = skewed.toPandas()
    rows = {r.column_name: r for r in profile(skewed, exact=True).collect()}
    for name in ("x", "k"):
        values = table[name].dropna().to_numpy(dtype=float)
        r = rows[name]
        assert r["count"] == len(values) and r.distinct_values == len(np.unique(values))
        assert [r.q25, r.q50, r.q75] == pytest.approx(list(np.quantile(values, [0.25, 0.5, 0.75])), rel=1e-12)
        assert r.avg == pytest.approx(values.mean()) and r.std == pytest.approx(values.std(ddof=1))
    assert rows["x"].null_percentage == pytest.approx(100 * table["x"].isna().mean())
    assert (rows["name"].distinct_values, rows["name"].q50, rows["name"].min) == (37, None, "s0")
    assert (rows["day"].distinct_values, rows["day"].min) == (100, "2024-01-01")
    assert (rows["void"].distinct_values, rows["void"].q50, rows["void"].null_percentage) == (0, None, 100.0)


def test_sketched_profile_is_near(skewed):
    exact = {r.column_name: r for r in profile(skewed, exact=True).collect()}
    for r in profile(skewed).collect():
        wanted = exact[r.column_name]
        assert r["count"] == wanted["count"] and r.min == wanted.min and r.avg == wanted.avg
        assert r.distinct_values == pytest.approx(wanted.distinct_values, rel=0.15)
        if wanted.q50 is not None:
            assert r.q50 == pytest.approx(wanted.q50, abs=1.0)


def gold_views(spark, region="a"):
    daily = cell_table(spark, (0, 10.0, 20.0, 0.0, 46.0)).withColumn("wind_speed_10m_mean", F.lit(1.0))
    table = regional(spark, (region, 0, 1, 5)).withColumn("wind_speed_mean", F.lit(1.0))
    return {
        "daily_global": daily,
        "daily_regional": table,
        "stg_daily_global": daily,
        "stg_daily_regional": table,
    }


def test_marts_are_built_behind_passing_tests(spark, root):
    built = build_marts(spark, gold_views(spark), root)
    assert {n: t.count() for n, t in built.items()} == {
        "mart_global_hottest_days": 1,
        "mart_regional_monthly_averages": 1,
    }


def test_failing_test_stops_the_marts(spark, root):
    with pytest.raises(audit.FailedTests, match="stg_daily_regional.region: 1"):
        build_marts(spark, gold_views(spark, region=None), root)


@pytest.mark.parametrize("name", sorted(REPORTS))
def test_reports_run_over_the_views(spark, name):
    REPORTS[name](gold_views(spark)).collect()


def test_null_report_ignores_keys(spark):
    df = cell_table(spark, (0, 10.0, 20.0, 0.0, 46.0)).withColumn("temperature_2m_min", F.lit(None).cast("double"))
    rows = {r.variable: r.null_percentage for r in audit.table_null_report(df).collect()}
    assert rows == {"temperature_2m_min": 100.0, "temperature_2m_mean": 0.0, "temperature_2m_max": 0.0}
