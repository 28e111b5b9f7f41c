"""Rolling means over blocks of long keys against one window per key."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import Window, functions as F

from isobar.operators import rolling

FIRST = date(2020, 1, 1)
ROWS = "date date, latitude double, longitude double, v double"
CELL = ("latitude", "longitude")


def whole(df, width):
    frame = Window.partitionBy(*CELL).orderBy("date", "v").rowsBetween(1 - width, 0)
    return df.select(*CELL, F.col("date").alias("day"), F.round("v", 2).alias("v"), F.round(F.avg("v").over(frame), 2).alias("m"))


def blocks(df, width, block_days):
    return rolling.rolling_mean_by_key(df, CELL, width, "v", "v", "m", block_days=block_days)


def ordered(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("width", "block_days"), [(1, 5), (2, 1), (7, 3), (7, 30), (30, 10), (5, 10_000)])
def test_blocks_equal_one_window_per_key(spark, width, block_days):
    """Dense and sparse keys, gaps over several blocks, NULL keys, days and values, days that repeat."""
    draw = random.Random(width * 100 + block_days)
    rows = [(FIRST + timedelta(days=d), 1.0, 1.0, draw.uniform(-9, 9)) for d in range(200)]
    rows += [(FIRST + timedelta(days=draw.randrange(2000)), 2.0, draw.choice([1.0, None]), draw.choice([None, draw.uniform(-9, 9)])) for _ in range(120)]
    rows += [(None, 3.0, 1.0, float(i)) for i in range(3)] + [(FIRST - timedelta(days=40_000), 3.0, 1.0, 2.0), (FIRST, 3.0, 1.0, 4.0), (FIRST, 3.0, 1.0, 4.0)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    assert ordered(blocks(df, width, block_days)) == ordered(whole(df, width))


def test_no_group_holds_a_long_key(spark):
    """One cell has most rows; its groups are blocks, each with the rows of one frame more."""
    df = spark.range(4000).select(F.date_add(F.lit(FIRST), F.col("id").cast("int")).alias("date"), F.lit(1.0).alias("latitude"), F.lit(2.0).alias("longitude"), F.rand(3).alias("v"))
    groups = rolling.with_halos(df, CELL, "date", "v", 30, 100).groupBy(*CELL, "block").count().collect()
    assert len(groups) in (40, 41) and max(g["count"] for g in groups) == 100 + 29
    assert sum(g["count"] for g in groups) == 4000 + 29 * (len(groups) - 1)


def test_sparse_days_are_not_copied_for_every_frame(spark):
    """A row in every second block, and some dense blocks between: few rows are copied, and frames reach over several blocks."""
    draw = random.Random(7)
    sparse = [(FIRST + timedelta(days=20 * d), 1.0, 1.0, draw.uniform(-9, 9)) for d in range(1500)]
    dense = [(FIRST + timedelta(days=20 * d + h), 2.0, 1.0, draw.uniform(-9, 9)) for d in range(900) for h in range(10 if d % 30 == 0 else 1)]
    short = [(FIRST + timedelta(days=20 * d), 3.0, None, draw.uniform(-9, 9)) for d in range(100)]
    df = spark.createDataFrame(sparse + dense + short, ROWS).repartition(5)
    met = rolling.with_halos(df, CELL, "date", "v", 8, 10)
    groups = met.groupBy(*CELL, "block").count().collect()
    assert max(g["count"] for g in groups) <= (rolling.FRAMES + 2) * 8
    halos = {r["latitude"]: r["count"] for r in met.where("halo").groupBy("latitude").count().collect()}
    assert halos[1.0] <= 7 * (len(sparse) // (rolling.FRAMES * 8) + 1) and halos[2.0] <= 7 * 70 and 3.0 not in halos
    assert ordered(blocks(df, 8, 10)) == ordered(whole(df, 8))


@pytest.mark.parametrize("frames", [0, 1, 2])
def test_blocks_of_few_rows_equal_one_window_per_key(spark, monkeypatch, frames):
    """Keys cut into many blocks, some with fewer rows than a frame, with NULL and repeated days."""
    monkeypatch.setattr(rolling, "FRAMES", frames or 0.2)
    draw = random.Random(frames)
    rows = [(FIRST + timedelta(days=draw.randrange(3000) // 7 * draw.choice([1, 7])), draw.choice([1.0, None]), draw.choice([2.0, 3.0]), draw.uniform(-9, 9)) for _ in range(700)]
    rows += [(None, None, 2.0, float(i)) for i in range(9)] + [(FIRST + timedelta(days=40), 1.0, 3.0, float(i)) for i in range(25)]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    for width in (2, 5, 20):
        assert ordered(blocks(df, width, 4)) == ordered(whole(df, width))


def test_extra_columns_and_empty_tables(spark):
    df = spark.createDataFrame([], ROWS + ", block int, halo int, n int")
    assert blocks(df, 7, 30).collect() == [] and blocks(df, 7, 30).columns == [*CELL, "day", "v", "m"]
