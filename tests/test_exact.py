"""Sums that do not depend on the order of the rows."""

from __future__ import annotations

from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from isobar.functions.exact import PARTS, exact_mean, exact_sum, joined, sum_parts
from isobar.operators import gold
from isobar.specs import CELL_STATS, REGION_STATS

SCHEMA = "date date, time timestamp, latitude double, longitude double, temperature_2m double, wind_speed_10m double"


def noisy(spark, rows=20_000):
    """Values with bits all over, so that the order of a plain sum shows."""
    draw = F.pmod(F.xxhash64("id"), F.lit(10**9)) / 7e6
    return spark.range(rows).select(
        F.expr("date_add(DATE '2024-01-01', CAST(id % 3 AS INT))").alias("date"),
        F.expr("timestamp_seconds(id % 24)").alias("time"),
        (F.col("id") % 40 + 20.0).alias("latitude"),
        (F.col("id") % 7 - 3.0).alias("longitude"),
        F.when(F.col("id") % 50 > 0, draw - 70).alias("temperature_2m"),
        F.sqrt(draw).alias("wind_speed_10m"),
    )


def test_rollups_are_equal_to_the_bit_over_any_partitions(spark):
    base = noisy(spark)
    cells, regions, plain = set(), set(), set()
    for n in (1, 8, 211):
        dealt = base.repartition(n, F.rand(n)) if n > 1 else base.coalesce(1).orderBy(F.rand(5))
        cells.add(tuple(sorted(map(tuple, gold.daily_rollup(dealt).collect()))))
        totals = gold.cell_totals(dealt, {v: () for v in CELL_STATS})
        by_totals = gold.regions_from_totals(totals, gold.REGIONS, REGION_STATS)
        assert sorted(map(tuple, by_totals.collect())) == sorted(map(tuple, gold.regional_rollup(dealt).select(by_totals.columns).collect()))
        regions.add(tuple(sorted(map(tuple, by_totals.collect()))))
        plain.add(tuple(sorted(map(tuple, dealt.groupBy("date").agg(F.avg("temperature_2m")).collect()))))
    assert len(cells) == 1 and len(regions) == 1 and len(plain) > 1


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.none() | st.floats(-2147483520.0, 2147483520.0, width=32).filter(lambda x: x == 0 or abs(x) >= 2.0**-24), max_size=40))
def test_sums_of_floats_have_no_error(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "v double")
    total, mean = rows.agg(exact_sum(F.col("v")), exact_mean(F.col("v"))).first()
    known = [Fraction(v) for v in values if v is not None]
    if not known:
        assert total is None and mean is None
    else:
        assert total == float(sum(known)) and mean == float(sum(known)) / len(known)


@pytest.mark.parametrize("values, want", [([1e300, 1.0], 1e300), ([float("inf"), 1.0], float("inf")), ([2.0**31, 0.5], 2.0**31 + 0.5), ([-(2.0**40), None, 1.0], 1 - 2.0**40)])
def test_what_cannot_be_split_is_added_as_doubles(spark, values, want):
    assert spark.createDataFrame([(v,) for v in values], "v double").agg(exact_sum(F.col("v"))).first()[0] == want


def test_nan_stays(spark):
    assert str(spark.createDataFrame([(float("nan"),), (1.0,)], "v double").agg(exact_mean(F.col("v"))).first()[0]) == "nan"


def test_stored_parts_add_up(spark):
    values = noisy(spark, 999).select((F.spark_partition_id() % 3).alias("k"), "temperature_2m")
    stored = values.groupBy("k").agg(*[c.alias(p) for p, c in sum_parts(F.col("temperature_2m")).items()])
    again = stored.agg(joined({p: F.sum(p) for p in PARTS})).first()[0]
    assert again == values.agg(exact_sum(F.col("temperature_2m"))).first()[0]
