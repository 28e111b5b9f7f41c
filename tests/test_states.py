"""Profiles from stored day states."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from isobar.operators import profile
from isobar.plans.elt import Elt
from tests.frames import day_rows, observations

DAYS = [date(2024, 5, d) for d in (1, 2, 3)]
EXACT = ("column_name", "column_type", "min", "max", "count", "null_percentage")


@pytest.fixture
def table(spark):
    return spark.range(30_000).select(
        F.expr("date_add(DATE '2024-01-01', CAST(id % 17 AS INT))").alias("date"),
        F.when(F.col("id") % 9 > 0, F.sqrt(F.col("id") % 5000 + 1e6)).alias("root"),
        (F.col("id") % 123).alias("whole"),
        (F.col("id") % 7).cast("float").alias("single"),
        F.concat(F.lit("é"), F.col("id") % 300).alias("name"),
        F.lit(None).cast("double").alias("nothing"),
        F.when(F.col("id") % 17 == 3, F.lit(2.5)).alias("one_day"),
    )


def test_merged_states_equal_the_profile(table):
    merged = profile.profile_from_states(profile.day_states(table))
    want = {r.column_name: r for r in profile.moments(table).collect()}
    got = {r.column_name: r for r in merged.collect()}
    assert set(got) == set(want) == set(table.columns)
    for name, row in got.items():
        assert [row[c] for c in EXACT] == [want[name][c] for c in EXACT]
        assert row.avg == (None if want[name].avg is None else pytest.approx(want[name].avg, rel=1e-12))
        assert row["std"] == (None if want[name]["std"] is None else pytest.approx(want[name]["std"], rel=1e-9, abs=1e-9))
    near = profile.within_bounds(table, merged).collect()
    assert all(r.distinct_near for r in near)
    assert {r.column_name: r.quartiles_near for r in near} == {c: None if c in ("date", "name", "nothing") else True for c in table.columns}


def test_no_rows_no_profile(table):
    assert profile.profile_from_states(profile.day_states(table.where("false"))).collect() == []


def test_states_do_not_grow_with_rows(table):
    size = F.sum(F.length("quantiles") + F.length("distinct_values")).alias("size")
    small = profile.day_states(table, 200).agg(size).first().size
    assert profile.day_states(table.union(table).union(table), 200).agg(size).first().size < 1.5 * small


def test_summary_reads_states_only_and_fills_gaps(spark, root, monkeypatch):
    elt = Elt(spark, root)
    source = observations(spark, *[day_rows(d, temperature_2m=float(d.day)) for d in DAYS])
    elt.run(source, DAYS[:2])
    want = {r.column_name: tuple(r) for r in profile.moments(elt.daily_global()).collect()}

    def summary():
        return {r.column_name: tuple(r[c] for c in ("column_name", "column_type", "min", "max", "avg", "std", "count", "null_percentage")) for r in elt.summary("daily_global").collect()}

    with monkeypatch.context() as patch:
        patch.setattr(Elt, "daily_global", lambda *a: pytest.fail("cells were read"))
        assert summary() == want
    with monkeypatch.context() as patch:
        patch.setattr(Elt, "_sketch", lambda *a: None)
        elt.run(source, DAYS)
    assert elt.states("daily_global").select("date").distinct().count() == 2
    assert summary()["date"][3] == "2024-05-03" and elt.states("daily_global").select("date").distinct().count() == 3
    assert elt.summary("daily_regional").where("column_name = 'region'").first()["count"] == 6
