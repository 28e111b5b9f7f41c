"""The two marts, built as tables behind the declared tests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from isobar.operators import analytics, audit
from isobar.sources.tables import register_views


MARTS: dict[str, Callable[[dict[str, DataFrame]], DataFrame]] = {
    "mart_global_hottest_days": lambda views: analytics.hottest_day_per_location(views["stg_daily_global"]),
    "mart_regional_monthly_averages": lambda views: analytics.monthly_summary(views["stg_daily_regional"]),
}


def build_marts(spark: SparkSession, views: dict[str, DataFrame], root: str) -> dict[str, DataFrame]:
    """Test the staging views, then write each mart, register it under its name and return it as read back.

    A failing test raises before anything is written.
    """
    audit.require_passing(audit.not_null_tests(views))
    built = {}
    for name, build in MARTS.items():
        path, mart = f"{root.rstrip('/')}/{name}", build(views)
        mart.write.mode("overwrite").parquet(path)
        built[name] = spark.read.schema(mart.schema).parquet(path)
    register_views(spark, built)
    return built
