"""The driver's tables in the shape of observations and gold tables.

The expressions are plain SQL that Spark and the checking engine both read, so that the
comparison SQL can be built from the very same text. All values are multiples of 1/8 or
1/1024, which keeps first-level sums exact in any order.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.operators.gold import aggregate_regions

OBS_COLUMNS = {
    "time": "date_trunc('hour', ts)",
    "date": "CAST(ts AS DATE)",
    "latitude": "90e0 - 0.25e0*((user_id*37+11)%721)",
    "longitude": "-180e0 + 0.25e0*((user_id*101+7)%1440)",
    "precipitation_surface": (
        "CASE WHEN EXTRACT(DAY FROM ts)=5 OR event_id%97=0 THEN NULL"
        " ELSE CAST((event_id%50) AS DOUBLE)/1024e0 END"
    ),
    "temperature_2m": (
        "CASE WHEN event_id%89=0 THEN NULL"
        " WHEN EXTRACT(DAY FROM ts)=13 AND event_id%10=0 THEN 60e0"
        " ELSE CAST((event_id*31)%880 AS DOUBLE)/8e0 - 60e0 END"
    ),
    "wind_u_10m": "CASE WHEN event_id%101=0 THEN NULL ELSE CAST((event_id*17)%321 AS DOUBLE)/8e0 - 20e0 END",
    "wind_v_10m": (
        "CASE WHEN EXTRACT(DAY FROM ts)=7 AND event_id%5=0 THEN NULL"
        " ELSE CAST((event_id*23)%241 AS DOUBLE)/8e0 - 15e0 END"
    ),
}
OBS_FILTER = "NOT (EXTRACT(DAY FROM ts)=20 AND EXTRACT(HOUR FROM ts)>=20)"

DAILY_KEYS = {
    "date": "CAST(l_shipdate AS DATE)",
    "latitude": "90e0 - 0.25e0*((l_partkey*37+11)%721)",
    "longitude": "-180e0 + 0.25e0*((l_suppkey*101+7)%1440)",
}
DAILY_TEMPERATURE = "CAST((l_orderkey*31+l_linenumber*7)%880 AS DOUBLE)/8e0 - 60e0"
DAILY_WIND = "l_quantity/8e0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def obs(
    spark: SparkSession,
    sf_dir: str,
    first: date | None = None,
    last: date | None = None,
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """Hourly observations from ``events``; a day range is filtered on the stored timestamp."""
    events = table(spark, sf_dir, "events")
    if first is not None:
        events = events.where(F.col("ts") >= F.lit(datetime.combine(first, datetime.min.time())).cast("timestamp_ntz"))
    if last is not None:
        after = datetime.combine(last + timedelta(days=1), datetime.min.time())
        events = events.where(F.col("ts") < F.lit(after).cast("timestamp_ntz"))
    columns = [f"{expression} AS {name}" for name, expression in OBS_COLUMNS.items()]
    return events.where(OBS_FILTER).selectExpr(*extra, *columns)


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several years of per-cell daily rollups from ``lineitem``."""
    keys = [f"{expression} AS {name}" for name, expression in DAILY_KEYS.items()]
    rows = table(spark, sf_dir, "lineitem").selectExpr(*keys, f"{DAILY_TEMPERATURE} AS t", f"{DAILY_WIND} AS w")
    return rows.groupBy(*DAILY_KEYS).agg(
        F.avg("t").alias("temperature_2m_mean"),
        F.min("t").alias("temperature_2m_min"),
        F.max("t").alias("temperature_2m_max"),
        F.avg("w").alias("wind_speed_10m_mean"),
        F.max("w").alias("wind_speed_10m_max"),
    )


def daily_regional(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-region daily table under its query names; feeds the SQL-layer reports only."""
    measures = {
        "temp_mean": ("mean", "temperature_2m_mean"),
        "temp_max": ("max", "temperature_2m_max"),
        "wind_speed_mean": ("mean", "wind_speed_10m_mean"),
        "wind_speed_max": ("max", "wind_speed_10m_max"),
    }
    return aggregate_regions(daily(spark, sf_dir), measures)
