"""Days whose landing files change, and failed days that do not."""

from __future__ import annotations

from datetime import date

import pytest

from isobar.plans.elt import ABSENT, Elt
from isobar.sources import landing, tables
from tests.frames import day_rows, observations

GOOD, BAD, LATE = (date(2024, 5, d) for d in (1, 2, 3))
DAYS = [GOOD, BAD, LATE]


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path / "landing")


@pytest.fixture
def elt(spark, root):
    return Elt(spark, root)


def put(spark, folder, *days):
    tables.write_days(observations(spark, *days), folder)


def run(spark, elt, folder):
    return elt.run(landing.scan_observations(spark, folder), DAYS)


def test_unchanged_failures_are_not_judged_again(spark, elt, folder, monkeypatch):
    put(spark, folder, day_rows(GOOD), day_rows(BAD, temperature_2m=60.0))
    first = run(spark, elt, folder)
    assert set(first.failed) == {BAD, LATE}
    entries = elt.journal().count()
    monkeypatch.setattr(Elt, "_judged", lambda *a: pytest.fail("a profile was read"))
    monkeypatch.setattr(tables, "write_days", lambda *a, **k: pytest.fail("a day was written"))
    again = run(spark, elt, folder)
    assert again.failed == first.failed and not any(again.days.values())
    assert elt.journal().count() == entries


def test_repaired_and_late_days_are_noticed(spark, elt, folder):
    put(spark, folder, day_rows(GOOD), day_rows(BAD, hours=23))
    run(spark, elt, folder)
    put(spark, folder, day_rows(BAD), day_rows(LATE))
    report = run(spark, elt, folder)
    assert report.failed == {} and report.days["bronze"] == [BAD, LATE] and report.days["daily_global"] == [BAD, LATE]
    assert elt.bronze().count() == 72
    assert not any(run(spark, elt, folder).days.values())


def test_a_finished_day_that_changes_is_built_anew(spark, elt, folder):
    put(spark, folder, day_rows(GOOD, temperature_2m=1.0))
    run(spark, elt, folder)
    put(spark, folder, day_rows(GOOD, temperature_2m=2.0))
    run(spark, elt, folder)
    assert [r.temperature_2m_mean for r in elt.daily_global().collect()] == [2.0]
    assert [r.high for r in elt.states("daily_global").where("column_name = 'temperature_2m_mean'").collect()] == ["2.0"]


def test_files_that_are_gone_change_nothing(spark, elt, folder):
    put(spark, folder, day_rows(GOOD), day_rows(BAD))
    run(spark, elt, folder)
    tables.drop_days(spark, folder, [GOOD])
    assert not any(run(spark, elt, folder).days.values())
    assert elt.daily_global().count() == 2


def test_other_declarations_try_again(spark, elt, folder, root):
    put(spark, folder, day_rows(GOOD, temperature_2m=lambda hour, cell: None if hour < 6 else 1.0))
    assert GOOD in run(spark, elt, folder).failed
    patient = Elt(spark, root, threshold=50.0)
    assert GOOD not in run(spark, patient, folder).failed


def test_fingerprints_follow_the_files(spark, folder):
    def now():
        stored = landing.scan_observations(spark, folder)
        return {r.date: (r.n_rows, r.fingerprint) for r in landing.fingerprints(stored, DAYS).collect()}

    put(spark, folder, day_rows(GOOD), day_rows(BAD))
    first = now()
    assert first == now() and {d: n for d, (n, _) in first.items()} == {GOOD: 24, BAD: 24}
    put(spark, folder, day_rows(BAD))
    assert now()[GOOD] == first[GOOD] and now()[BAD] != first[BAD]
    assert ABSENT not in [f for _, f in now().values()]


def test_a_table_that_is_no_scan_has_none(spark):
    assert landing.fingerprints(observations(spark, day_rows(GOOD)), DAYS) is None
