from __future__ import annotations

import json
from dataclasses import replace
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from isobar.__main__ import main
from isobar.functions.dates import days_frame
from isobar.operators import audit, lineage
from isobar.plans.audits import AUDITS
from isobar.plans.elt import Elt
from isobar.sources import tables
from isobar.specs import HOURLY_GRID, declared
from tests.frames import day_rows, observations

GOOD, HOT, BARE, LATE = (date(2024, 5, d) for d in (1, 2, 3, 4))
EUROPE = ((50.0, 10.0), (51.0, 10.0))


@pytest.fixture
def source(spark):
    return observations(
        spark,
        day_rows(GOOD, EUROPE, precipitation_surface=None, temperature_2m=lambda hour, cell: float(hour)),
        day_rows(HOT, EUROPE, temperature_2m=60.0),
        day_rows(BARE, EUROPE, temperature_2m=lambda hour, cell: None if hour < 12 else 1.0),
    )


@pytest.fixture
def elt(spark, root):
    return Elt(spark, root)


def days_of(df):
    return sorted(r.date for r in df.select("date").distinct().collect())


def test_layers_failures_and_rerun(elt, source):
    days = [GOOD, HOT, BARE]
    report = elt.run(source, days)
    assert days_of(elt.bronze()) == days
    assert days_of(elt.silver()) == [GOOD, BARE]
    assert days_of(elt.daily_global()) == [GOOD] == days_of(elt.daily_regional())
    assert report.rows == {"daily_global": 2, "daily_regional": 2}
    assert report.failed == {
        HOT: "Data Quality Validation Failed:\n- Variable 'temperature_2m' max value 60.0 is above 54.0",
        BARE: "Missing variable: temperature_2m",
    }
    cell = elt.daily_global().first()
    assert (cell.temperature_2m_mean, cell.temperature_2m_max, cell.wind_speed_10m_max) == (11.5, 23.0, 5.0)

    before = elt.ledger().where("status = 'ok'").count()
    again = elt.run(source, days)
    assert again.days["bronze"] == [] and again.days["silver"] == [HOT]
    assert again.days["daily_global"] == again.days["daily_regional"] == []
    assert elt.ledger().where("status = 'ok'").count() == before
    assert elt.silver().count() == 96


def test_days_arrive_one_after_another(elt, source):
    elt.run(source, [GOOD])
    elt.run(source, [BARE])
    assert days_of(elt.bronze()) == [GOOD, BARE]
    assert days_of(elt.daily_global()) == [GOOD]


def test_batches_give_the_same_tables(spark, source, root):
    days = [BARE, HOT, GOOD, LATE]
    whole, batched = Elt(spark, root + "/whole"), Elt(spark, root + "/batched")
    one, many = whole.run(source, days), batched.run(source, days, batch_days=1)
    assert (one.days, one.rows, one.failed) == (many.days, many.rows, many.failed)
    for read in (Elt.bronze, Elt.silver, Elt.daily_global, Elt.daily_regional):
        assert sorted(map(str, read(whole).collect())) == sorted(map(str, read(batched).collect()))


def test_gold_waits_for_finished_silver(spark, elt, source):
    elt.to_bronze(source, [GOOD])
    partial = elt_image(spark, elt, day_rows(GOOD, EUROPE, hours=3))
    tables.write_days(partial, elt.at.silver)
    assert elt.to_gold([GOOD]) == ({"daily_global": [], "daily_regional": []}, {})
    elt.run(source, [GOOD])
    assert elt.daily_global().first().temperature_2m_max == 23.0


def test_half_written_day_is_repeated(spark, elt, source):
    tables.write_days(elt_image(spark, elt, day_rows(GOOD, EUROPE, hours=3)), elt.at.bronze)
    elt.run(source, [GOOD])
    assert elt.bronze().count() == 48


def elt_image(spark, elt, rows):
    df = observations(spark, rows).withColumn("spatial_ref", F.lit(0).cast("bigint"))
    return tables.store_as_float(df, elt.spec.variable_names)


def test_landing_without_a_variable_fails_its_days(elt, source):
    report = elt.run(source.drop("wind_u_10m"), [GOOD])
    assert report.failed == {GOOD: "Data Quality Validation Failed:\n- Missing variable: 'wind_u_10m'"}
    assert elt.lineage().where("layer = 'bronze'").first().variable_count == 3


def test_days_that_never_landed_stay_pending(spark, elt, source):
    report = elt.run(source, [GOOD, LATE])
    assert report.failed == {LATE: "No observations for this day"}
    ledger = elt.ledger()
    requested = days_frame(spark, GOOD, LATE)
    assert days_of(lineage.pending(requested, ledger, "bronze", "bronze")) == [HOT, BARE, LATE]
    complete = {r.date: r.all_done for r in lineage.gold_completeness(requested, ledger).collect()}
    assert complete == {GOOD: True, HOT: False, BARE: False, LATE: False}
    assert days_of(audit.missing_days(requested, elt.daily_global())) == [HOT, BARE, LATE]


def test_landing_types_are_brought_in_line(spark, elt, source):
    loose = source.select(
        F.col("time").cast("timestamp_ntz").alias("time"),
        F.col("latitude").cast("float").alias("latitude"),
        *[c for c in source.columns if c not in ("time", "latitude", "date")],
    )
    elt.run(loose, [GOOD])
    assert elt.bronze().select("time").distinct().count() == 24
    assert days_of(elt.daily_regional()) == [GOOD]


def test_lineage(elt, source):
    elt.run(source, [GOOD, HOT])
    records = {(r.layer, r.transformation, r.date): r for r in elt.lineage().collect()}
    bronze, silver = records["bronze", "bronze", HOT], records["silver", "silver", GOOD]
    assert bronze.variable_count == 4 and bronze.row_count == 48 and bronze.size_bytes == 48 * 4 * 4
    assert silver.parent_layer == "bronze" and silver.parent_date == GOOD
    assert silver.variables_dropped == ["precipitation_surface"]
    cells, regional = records["gold", "daily_global", GOOD], records["gold", "daily_regional", GOOD]
    assert cells.row_count == 2 and cells.size_bytes > 0 and json.loads(cells.spatial_bounds) == "Global"
    bounds = json.loads(regional.spatial_bounds)
    assert bounds["europe"]["lat_slice"] == {"start": 70.0, "stop": 35.0, "step": None}
    assert ("silver", "silver", HOT) not in records


def test_a_finished_layer_is_not_written_again(elt, source):
    elt.run(source, [HOT])
    elt.run(source.withColumn("temperature_2m", F.lit(1.0)), [HOT])
    assert elt.bronze().agg(F.max("temperature_2m")).first()[0] == 60.0
    assert days_of(elt.silver()) == []


def test_views_answer_sql(spark, elt, source):
    elt.run(source, [GOOD])
    tables.register_views(spark, elt.views())
    rows = spark.sql("SELECT region, MAX(temp_max) AS t FROM daily_regional GROUP BY region ORDER BY region").collect()
    assert [tuple(r) for r in rows] == [("europe", 23.0), ("global", 23.0)]
    assert spark.table("hourly_global").count() == 48


def test_stored_schemas(elt, source):
    elt.run(source, [GOOD])
    assert dict(elt.daily_global().dtypes) == {
        "latitude": "double",
        "longitude": "double",
        "spatial_ref": "bigint",
        "temperature_2m_mean": "float",
        "temperature_2m_min": "float",
        "temperature_2m_max": "float",
        "wind_speed_10m_mean": "float",
        "wind_speed_10m_max": "float",
        "date": "date",
    }
    assert elt.views()["daily_regional"].columns == [
        "date",
        "region",
        "temp_mean",
        "temp_max",
        "wind_speed_mean",
        "wind_speed_max",
    ]
    stored = elt.spark.read.parquet(elt.at.silver).schema
    assert stored["wind_speed_10m"].metadata["units"] == "m/s"


def test_silver_write_does_not_shuffle(elt, source):
    elt.run(source, [GOOD])
    silver = elt.silver([GOOD])
    plan = silver.sortWithinPartitions("date")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def straddling(spark):
    """48 rows of two complete days, and one of the first day whose time lies on the second."""
    rows = [*day_rows(GOOD), *day_rows(HOT)]
    return observations(spark, rows, [(day_rows(HOT)[5][0], GOOD, *day_rows(HOT)[5][2:])])


@pytest.mark.parametrize("batch", [None, 1, 2])
def test_batches_change_neither_rows_nor_verdicts(spark, root, batch):
    elt = Elt(spark, root)
    report = elt.run(straddling(spark), [GOOD, HOT], batch_days=batch)
    assert elt.bronze().count() == 49
    assert list(report.failed) == [GOOD] and "1 rows have a time on another day" in report.failed[GOOD]
    assert days_of(elt.daily_global()) == [HOT]


def test_rows_without_a_time_are_judged(spark, elt):
    untimed = observations(spark, day_rows(GOOD), [(None, *day_rows(GOOD)[0][1:])])
    report = elt.run(untimed, [GOOD])
    assert elt.bronze().count() == 25
    assert report.failed == {GOOD: "Data Quality Validation Failed:\n- 1 rows have no time"}


@pytest.mark.parametrize("dated", [True, False])
def test_session_zone_does_not_matter(spark, elt, root, dated):
    source = observations(spark, day_rows(GOOD, EUROPE))
    (source if dated else source.drop("date")).write.parquet(root + "/landing")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        landed = spark.read.parquet(root + "/landing")
        report = elt.run(landed, [GOOD])
        hours = audit.hours_check(elt.bronze(), 1).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert report.failed == {} and days_of(elt.daily_global()) == [GOOD]
    assert hours.hours_equal and not hours.duplicate_timestamps


def test_redo_lands_a_repaired_day(spark, elt):
    broken, whole = (observations(spark, day_rows(GOOD, EUROPE, hours=h), day_rows(HOT, EUROPE)) for h in (20, 24))
    assert list(elt.run(broken, [GOOD, HOT]).failed) == [GOOD]
    assert list(elt.run(whole, [GOOD, HOT]).failed) == [GOOD]
    report = elt.run(whole, [GOOD], redo=True)
    assert report.failed == {} and report.days["bronze"] == [GOOD]
    assert days_of(elt.daily_global()) == [GOOD, HOT] == days_of(elt.silver())
    assert elt.bronze().count() == 96
    assert elt.run(whole, [GOOD, HOT]).days == {"bronze": [], "silver": [], "daily_global": [], "daily_regional": []}


def test_redo_of_a_day_that_lands_empty_leaves_nothing(spark, elt, source):
    elt.run(source, [GOOD])
    report = elt.run(source.where("date <> '2024-05-01'"), [GOOD], redo=True)
    assert report.failed == {GOOD: "No observations for this day"}
    for table in (elt.bronze(), elt.silver(), elt.daily_global(), elt.daily_regional()):
        assert table.count() == 0
    complete = lineage.gold_completeness(days_frame(spark, GOOD, GOOD), elt.ledger()).first()
    assert complete.finished == 0


def test_half_written_day_that_lands_empty_leaves_nothing(spark, elt, source):
    tables.write_days(elt_image(spark, elt, day_rows(LATE, EUROPE, hours=3)), elt.at.bronze)
    assert elt.run(source, [LATE]).failed == {LATE: "No observations for this day"}
    assert elt.bronze().count() == 0


def test_a_laid_out_landing_gives_the_same_tables(spark, root, source):
    one, two = Elt(spark, root + "/one"), Elt(spark, root + "/two")
    ordered = source.coalesce(1).sortWithinPartitions("date", "latitude", "longitude", "time")
    assert one.run(source, [GOOD, HOT]).rows == two.run(ordered, [GOOD, HOT], laid_out=True).rows
    assert sorted(map(str, one.bronze().collect())) == sorted(map(str, two.bronze().collect()))


def test_a_rerun_without_news_writes_nothing(elt, source):
    elt.run(source, [GOOD, HOT, BARE])
    entries = elt.journal().count()
    elt.run(source, [GOOD, HOT, BARE])
    assert elt.journal().count() == entries


def test_temperature_only(spark, root, source):
    spec = replace(HOURLY_GRID, variables=tuple(v for v in HOURLY_GRID.variables if v.name == "temperature_2m"))
    elt = Elt(spark, root, spec=spec, region_stats={"temperature_2m": ("mean", "min", "max")}, source="elsewhere")
    elt.run(source.drop("wind_u_10m", "wind_v_10m", "precipitation_surface"), [GOOD])
    row = elt.daily_regional().where("region = 'europe'").first()
    assert (row.temperature_2m_mean, row.temperature_2m_min, row.temperature_2m_max) == (11.5, 0.0, 23.0)
    assert elt.daily_global().columns == ["latitude", "longitude", "spatial_ref", "temperature_2m_mean", "temperature_2m_min", "temperature_2m_max", "date"]
    assert {r.source for r in elt.lineage().collect()} == {"elsewhere"}
    logic = elt.lineage().where("transformation = 'daily_regional'").first().aggregation_logic
    assert json.loads(logic)["metrics"] == {"temperature_2m": ["mean", "min", "max"]}


def test_threshold_can_be_set(spark, root, source):
    assert list(Elt(spark, root + "/a", threshold=60.0).run(source, [BARE]).failed) == []
    assert list(Elt(spark, root + "/b").run(source, [BARE]).failed) == [BARE]


def test_gold_sizes_are_file_sizes(elt, source):
    elt.run(source, [GOOD])
    folder = Path(elt.at.daily_global) / f"date={GOOD.isoformat()}"
    stored = elt.lineage().where("transformation = 'daily_global'").first().size_bytes
    assert stored == sum(f.stat().st_size for f in folder.glob("*.parquet"))


def test_one_scan_of_silver_for_both_gold_tables(elt, source, monkeypatch):
    reads = []
    silver = Elt.silver
    monkeypatch.setattr(Elt, "silver", lambda self, days=None: reads.append(days) or silver(self, days))
    elt.run(source, [GOOD])
    assert reads == [[GOOD]]


def test_command_line(spark, root, source, capsys):
    source.write.parquet(root + "/landing")
    at = ["--root", root + "/tables"]
    main(["run", "--landing", root + "/landing", "--start", GOOD.isoformat(), "--end", BARE.isoformat(), "--source", "here", *at], spark)
    assert "2 days failed" in capsys.readouterr().out
    main(["marts", *at], spark)
    fresh = spark.newSession()
    main(["sql", "SELECT COUNT(*) AS n FROM mart_regional_monthly_averages", *at], fresh)
    assert capsys.readouterr().out.split() == ["n", "2"]
    main(["sql", "SELECT * FROM mart_global_hottest_days", "--out", root + "/out", *at], fresh)
    assert spark.read.parquet(root + "/out").columns == ["rlongitude", "rlatitude", "day", "tmp_max", "rank"]
    main(["sql", "SELECT id FROM range(1500)", *at], spark)
    assert len(capsys.readouterr().out.split()) == 1501
    for name in AUDITS:
        main(["audit", name, "--out", f"{root}/audit/{name}", *at], spark)
    missing = {(r.table_name, r.date) for r in spark.read.parquet(f"{root}/audit/missing_days").collect()}
    assert ("silver", HOT) in missing and ("daily_global", BARE) in missing and ("bronze", HOT) not in missing
    main(["report", "rolling_7d", "--value", "wind_speed_mean", *at], spark)
    assert capsys.readouterr().out.splitlines()[0].split() == ["region", "day", "wind_speed_mean", "wind_speed_mean_rolling_7d"]
    main(["tables", *at], spark)
    listed = dict(line.split("\t")[::2] for line in capsys.readouterr().out.splitlines()[1:])
    assert listed["daily_global"] == "2" and listed["mart_regional_monthly_averages"] == "2" and int(listed["ledger"]) > 4
    main(["sql", "SELECT reason FROM ledger WHERE status = 'failed' AND transformation = 'silver'", *at], spark)
    assert "max value 60.0" in capsys.readouterr().out
    main(["report", "diurnal_range", "--day", GOOD.isoformat(), "--min-range", "22.5", "--lat-max", "50.5", *at], spark)
    assert len(capsys.readouterr().out.splitlines()) == 2
    main(["report", "hottest_day_per_location", "--threshold", "20", "--value", "temperature_2m_mean", *at], spark)
    assert capsys.readouterr().out.split() == ["rlongitude", "rlatitude", "day", "temperature_2m_mean", "rank"]
    main(["report", "monthly_summary", "--value", "wind_speed", *at], spark)
    assert capsys.readouterr().out.split()[:5] == ["region", "month", "wind_speed_avg", "wind_speed_max", "days_in_month"]
    main(["summary", "daily_regional", *at], spark)
    assert capsys.readouterr().out.splitlines()[0].split()[0] == "column_name"
    with pytest.raises(ValueError, match="takes no"):
        main(["report", "rolling_7d", "--day", GOOD.isoformat(), *at], spark)


def test_declarations_come_from_a_file(spark, root, source, tmp_path):
    file = tmp_path / "declared.json"
    box = {"name": "alps", "lat_min": 50.5, "lat_max": 52, "lon_min": 0, "lon_max": 20}
    file.write_text(json.dumps({"regions": [box], "threshold": 60, "region_stats": {"temperature_2m": ["min", "sum"]}}))
    source.write.parquet(root + "/landing")
    at = ["--root", root + "/tables", "--declarations", str(file)]
    main(["run", "--landing", root + "/landing", "--start", GOOD.isoformat(), "--end", BARE.isoformat(), *at], spark)
    with open(file) as declared_file:
        stored = Elt(spark, root + "/tables", **declared(declared_file.read())).daily_regional()
    assert {(r.date, r.region): (r.temperature_2m_min, r.temperature_2m_sum) for r in stored.collect()} == {(GOOD, "alps"): (0.0, 276.0), (BARE, "alps"): (1.0, 12.0)}
    for wrong in ('{"region": []}', '{"cell_stats": {"temperature_2m": ["median"]}}'):
        with pytest.raises(ValueError, match="unknown"):
            declared(wrong)
