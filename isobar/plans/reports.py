"""The reports by name, over the gold views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from isobar.operators import analytics, audit, profile, rolling

Views = dict[str, DataFrame]

CELL = ("latitude", "longitude")

REPORTS: dict[str, Callable[[Views], DataFrame]] = {
    "describe_daily_global": lambda v: audit.describe(v["daily_global"]),
    "describe_daily_regional": lambda v: audit.describe(v["daily_regional"]),
    "summarize_daily_global": lambda v: profile.profile(v["daily_global"]),
    "summarize_daily_regional": lambda v: profile.profile(v["daily_regional"]),
    "region_list": lambda v: analytics.region_list(v["daily_regional"]),
    "regional_trend": lambda v: analytics.regional_trend(v["daily_regional"]),
    "monthly_regional_averages": lambda v: analytics.monthly_averages(v["daily_regional"]),
    "hottest_days_per_region": lambda v: analytics.hottest_days(v["daily_regional"]),
    "hottest_day_per_location": lambda v: analytics.hottest_day_per_location(v["daily_global"]),
    "monthly_summary": lambda v: analytics.monthly_summary(v["daily_regional"]),
    "compare_regions_over_time": lambda v: analytics.compare_regions(v["daily_regional"]),
    "rolling_7d": lambda v: analytics.rolling_mean(v["daily_regional"], 7),
    "rolling_30d": lambda v: analytics.rolling_mean(v["daily_regional"], 30),
    "rolling_30d_per_cell": lambda v: rolling.rolling_mean_by_key(v["daily_global"], CELL, 30, "temperature_2m_mean", "tmp_mean", "tmp_avg_rolling_30d"),
    "diurnal_range": lambda v: analytics.diurnal_range(v["daily_global"]),
    "not_null_tests": lambda v: audit.not_null_tests(v),
}

# Reports on one column, which may be another one; the monthly summary takes a variable, of which it needs mean and maximum.
VALUED: dict[str, Callable[..., DataFrame]] = {
    "regional_trend": lambda v, value: analytics.regional_trend(v["daily_regional"], value, value),
    "monthly_regional_averages": lambda v, value: analytics.monthly_averages(v["daily_regional"], value, f"{value}_avg"),
    "monthly_summary": lambda v, value: analytics.monthly_summary(v["daily_regional"], f"{value}_mean", f"{value}_max", value),
    "hottest_days_per_region": lambda v, value: analytics.hottest_days(v["daily_regional"], value=value, name=value),
    "hottest_day_per_location": lambda v, value=None, **limits: analytics.hottest_day_per_location(
        v["daily_global"], **limits, **({"value": value, "name": value} if value else {})
    ),
    "compare_regions_over_time": lambda v, value: analytics.compare_regions(v["daily_regional"], value, f"{value}_avg"),
    "rolling_7d": lambda v, value: analytics.rolling_mean(v["daily_regional"], 7, value, value, f"{value}_rolling_7d"),
    "rolling_30d": lambda v, value: analytics.rolling_mean(v["daily_regional"], 30, value, value, f"{value}_rolling_30d"),
    "rolling_30d_per_cell": lambda v, value: rolling.rolling_mean_by_key(v["daily_global"], CELL, 30, value, value, f"{value}_rolling_30d"),
}
#: Limits that a report takes instead of its own.
LIMITED: dict[str, tuple[str, ...]] = {
    "hottest_day_per_location": ("threshold",),
    "diurnal_range": ("day", "lat_min", "lat_max", "min_range"),
}


def report_on(name: str, views: Views, value: str | None = None, **limits) -> DataFrame:
    """A report by name, on ``value`` instead of its own column and within ``limits`` instead of its own, as far as given."""
    limits = {limit: given for limit, given in limits.items() if given is not None}
    if value is not None and name not in VALUED:
        raise ValueError(f"{name} takes no column")
    if unknown := set(limits) - set(LIMITED.get(name, ())):
        raise ValueError(f"{name} takes no {', '.join(sorted(unknown))}")
    if value is None and not limits:
        return REPORTS[name](views)
    if name == "diurnal_range":
        return analytics.diurnal_range(views["daily_global"], **limits)
    return VALUED[name](views, value, **limits)
