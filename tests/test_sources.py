from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar import session
from isobar.sources import grids, landing, tables
from tests.frames import day_rows, observations

MONDAY, TUESDAY = date(2024, 1, 1), date(2024, 1, 2)


def test_nan_becomes_null_when_landing(spark):
    df = observations(spark, day_rows(MONDAY, hours=1, temperature_2m=float("nan")))
    row = landing.land(df).first()
    assert row.temperature_2m is None and row.wind_u_10m == 3.0 and row.spatial_ref == 0


def test_date_is_derived_where_missing(spark):
    df = observations(spark, day_rows(MONDAY, hours=1)).drop("date")
    assert landing.land(df).first().date == MONDAY


def test_day_slice(spark):
    df = observations(spark, day_rows(MONDAY), day_rows(TUESDAY))
    assert landing.day_slice(df, TUESDAY).select("date").distinct().collect() == [(TUESDAY,)]
    assert landing.day_slice(df, TUESDAY).count() == 24


def test_landing_scan_and_partition_pruning(spark, root):
    tables.write_days(observations(spark, day_rows(MONDAY), day_rows(TUESDAY)), root)
    scan = landing.scan_observations(spark, root)
    plan = landing.day_slice(scan, MONDAY)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_landing_without_a_date_is_pruned_by_time(spark, root):
    observations(spark, day_rows(MONDAY), day_rows(TUESDAY)).drop("date").write.parquet(root)
    sliced = landing.land_days(spark.read.parquet(root), [MONDAY])
    plan = sliced._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(time), GreaterThanOrEqual(time" in plan
    assert sliced.count() == 24


@pytest.mark.parametrize("zone", ["America/New_York", "Asia/Tokyo"])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_days_are_utc_days_in_any_session(spark, zone, kind):
    rows = observations(spark, day_rows(MONDAY), day_rows(TUESDAY)).drop("date").withColumn("time", F.col("time").cast(kind))
    rows = session.stage(rows)
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        counts = {r.date: r["count"] for r in landing.land(rows).groupBy("date").count().collect()}
        sliced = landing.land_days(rows, [TUESDAY]).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert counts == {MONDAY: 24, TUESDAY: 24} and sliced == 24


def test_write_replaces_only_its_days(spark, root):
    tables.write_days(observations(spark, day_rows(MONDAY), day_rows(TUESDAY)), root)
    tables.write_days(observations(spark, day_rows(TUESDAY, hours=5)), root)
    counts = {r.date: r["count"] for r in spark.read.parquet(root).groupBy("date").count().collect()}
    assert counts == {MONDAY: 24, TUESDAY: 5}


def test_concat_tolerates_uneven_variables(spark):
    a = observations(spark, day_rows(MONDAY)).drop("wind_u_10m")
    b = observations(spark, day_rows(TUESDAY))
    both = landing.concat_days([a, b])
    assert both.count() == 48 and both.where("wind_u_10m IS NULL").count() == 24


def test_hours_of_a_cell_land_in_one_file(spark, root):
    grid = tuple((lat / 4, 10.0) for lat in range(-40, 40))
    tables.write_days(observations(spark, day_rows(MONDAY, grid)), root)
    named = spark.read.parquet(root).select("latitude", F.input_file_name().alias("file"))
    files = named.groupBy("latitude").agg(F.count_distinct("file").alias("files"))
    assert files.agg(F.max("files")).first()[0] == 1


def test_day_sizes_list_files_without_reading_them(spark, root):
    tables.write_days(observations(spark, day_rows(MONDAY), day_rows(TUESDAY)), root)
    sizes = tables.day_sizes(spark, root)
    assert "content" not in sizes._jdf.queryExecution().executedPlan().toString()
    assert {r.date for r in sizes.where("size_bytes > 0 AND files = 1").collect()} == {MONDAY, TUESDAY}


def test_flatten_and_pack_are_inverse(spark):
    grid = spark.createDataFrame([(1, [float(i) for i in range(6)])], "id int, v array<double>")
    rows = grids.flatten(grid, "v", width=3, keep=("id",)).orderBy("position").collect()
    assert [(r.latitude, r.longitude, r.value) for r in rows[2:5]] == [
        (90.0, -179.5, 2.0),
        (89.75, -180.0, 3.0),
        (89.75, -179.75, 4.0),
    ]
    df = observations(spark, day_rows(MONDAY, ((1.0, 2.0), (3.0, 4.0)), temperature_2m=lambda h, c: None if h == 3 else h * 1.0))
    packed = grids.pack(df.repartition(7), "temperature_2m").collect()
    assert len(packed) == 2
    assert all(r["values"] == [None if h == 3 else float(h) for h in range(24)] for r in packed)


def test_cell_with_too_many_rows_is_reported_and_not_collected(spark):
    df = spark.range(1000).select(
        F.lit(MONDAY).alias("date"),
        F.lit(1.0).alias("latitude"),
        F.lit(2.0).alias("longitude"),
        F.timestamp_seconds(F.col("id") % 24 * 3600).alias("time"),
        "id",
        F.col("id").cast("double").alias("v"),
    )
    assert [(r.rows, r["values"]) for r in grids.pack(df, "v", ("time", "id")).collect()] == [(1000, None)]
    whole = grids.pack(df, "v", ("id",), most=1000).first()
    assert whole.rows == 1000 and whole["values"] == [float(i) for i in range(1000)]
    nowhere = df.where("id < 3").withColumn("latitude", F.lit(None).cast("double"))
    assert [(r.latitude, r["values"]) for r in grids.pack(nowhere, "v").collect()] == [(None, [0.0, 1.0, 2.0])]


def test_scratch_folder_follows_the_cluster(spark):
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    first, second = session.scratch_root(spark), session.scratch_root(spark)
    assert first != second
    if base:
        assert first.startswith(base)


def test_staged_folders_are_deleted(spark):
    mark = session.staged_so_far()
    staged = session.stage(spark.range(3))
    assert staged.count() == 3
    path = staged.inputFiles()[0].rpartition("/")[0]
    session.release(mark)
    assert tables.stored(spark, path) is None and session.staged_so_far() == mark


def test_days_are_dropped(spark, root):
    tables.write_days(observations(spark, day_rows(MONDAY), day_rows(TUESDAY)), root)
    tables.drop_days(spark, root, [MONDAY, date(2023, 1, 1)])
    assert spark.read.parquet(root).select("date").distinct().collect() == [(TUESDAY,)]
    schema = spark.read.parquet(root).schema
    assert tables.read_days(spark, root, schema, [MONDAY]).count() == 0
    assert tables.read_days(spark, root, schema, [MONDAY, TUESDAY]).count() == 24


def test_staged_tables_know_their_size(spark):
    staged = session.stage(spark.range(10))
    assert staged.count() == 10
    joined = spark.range(10**6).join(staged, "id")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()


def test_reading_what_was_never_written(spark, root):
    assert tables.read_or_empty(spark, root, spark.range(1).schema).count() == 0


def test_hot_day_is_split_into_several_files(spark, root):
    """A third of all rows in one cell and day must not end up in one task."""
    hot = F.col("id") % 3 == 0
    df = spark.range(600_000).select(
        F.when(hot, F.lit(MONDAY)).otherwise(F.date_add(F.lit(MONDAY), (F.col("id") % 20).cast("int"))).alias("date"),
        F.when(hot, 10.0).otherwise(F.col("id") % 180 - 90.0).alias("latitude"),
        F.when(hot, 20.0).otherwise(F.col("id") % 360 - 180.0).alias("longitude"),
        F.timestamp_seconds(F.col("id") % 24 * 3600).alias("time"),
        F.hash("id").cast("double").alias("temperature_2m"),
    )
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    spark.conf.set(advisory, "512kb")
    try:
        tables.write_days(df, root)
    finally:
        spark.conf.set(advisory, before)
    sizes = {r.date: r.files for r in tables.day_sizes(spark, root).collect()}
    assert sizes[MONDAY] > 4
    stored = spark.read.parquet(root)
    assert stored.count() == 600_000
    assert stored.agg(F.sum("temperature_2m")).first() == df.agg(F.sum("temperature_2m")).first()
