"""Every query against its SQL on the driver's tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry
from isobar import registry
from tests.parity import difference

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables")


@pytest.mark.parametrize("name", sorted(registry.registered()))
def test_query_equals_sql(spark, name):
    assert difference(spark, SF_DIR, name) == ""


def test_entry_returns_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["region", "month", "tmp_avg", "tmp_max", "days_in_month"]
    assert result.count() > 0


# The order that each ordered query promises: column names, those with a minus downwards.
ORDERS = {
    "regional_trend": ("day", "region"),
    "monthly_regional_averages": ("month", "tmp_avg", "region"),
    "monthly_wind_averages": ("month", "wind_avg", "region"),
    "mart_regional_monthly_averages": ("month", "tmp_avg", "region"),
    "compare_regions_over_time": ("day", "region"),
    "rolling_7d": ("day", "region"),
    "rolling_30d": ("day", "region"),
    "hottest_days_per_region": ("rank", "-tmp_max", "region"),
    "mart_global_hottest_days": ("rank", "-tmp_max", "rlongitude", "rlatitude"),
}


@pytest.mark.parametrize("name", ORDERS)
def test_ordered_queries_are_in_order(spark, name):
    result = entry.queries()[name](spark, SF_DIR)
    plan = result._jdf.queryExecution().optimizedPlan().toString()
    assert plan.startswith("Sort [") and ", true" in plan.splitlines()[0]
    rows = result.collect()
    keys = [tuple(-r[c[1:]] if c[0] == "-" else r[c] for c in ORDERS[name]) for r in rows]
    assert len(rows) > 1 and keys == sorted(keys)


def test_every_query_has_sql():
    assert set(registry.registered()) <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())
