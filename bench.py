"""Time a full run, and the reports, marts and audits over the gold tables it stores. Prints one JSON line.

The reports run the way they are used: over ``Elt.views()``, one folder per day. Those over whole cell tables run again over a
table of several years (``*_years``), whose building is timed on its own (``build_*``). With ``BENCH_ROWS`` set, three operators also run
over that many generated rows, next to DuckDB on the same files; these figures go to the entry ``large``.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from isobar.operators import audit, gold  # noqa: E402
from isobar.plans.elt import Elt  # noqa: E402
from isobar.plans.marts import build_marts  # noqa: E402
from isobar.plans.reports import REPORTS  # noqa: E402
from isobar.registry import observed_days, requested_days  # noqa: E402
from isobar.session import configure, scratch_root, stage  # noqa: E402
from isobar.sources import fixtures  # noqa: E402
from isobar.specs import HOURLY_GRID  # noqa: E402

REPEATS = 3
CELL_COLUMNS = ("temperature_2m_mean", "temperature_2m_min", "temperature_2m_max", "wind_speed_10m_mean", "wind_speed_10m_max")


def best(work: Callable) -> float:
    times = []
    for _ in range(REPEATS):
        started = time.perf_counter()
        work()
        times.append(time.perf_counter() - started)
    return round(min(times), 3)


def large(spark: SparkSession, rows: int) -> dict[str, list[float]]:
    """Seconds of Spark and of DuckDB, for the hottest day per location, the profile and the daily rollup of generated cells."""
    path = scratch_root(spark)
    number = F.col("id")
    spark.range(rows).select(
        F.date_add(F.lit("2015-01-01").cast("date"), (number % 360).cast("int")).alias("date"),
        (90 - F.pmod(F.hash(number), F.lit(721)) * 0.25).alias("latitude"),
        (-180 + F.pmod(F.hash(number, F.lit(1)), F.lit(1440)) * 0.25).alias("longitude"),
        *[(F.pmod(F.hash(number, F.lit(i + 2)), F.lit(1120)) / 8 - 92).cast("float").alias(c) for i, c in enumerate(CELL_COLUMNS)],
    ).write.parquet(path)
    cells = spark.read.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW cells AS SELECT * FROM read_parquet('{path.removeprefix('file:')}/*.parquet')")
    hottest = (
        "SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lon, lat ORDER BY peak DESC, date) AS rank FROM (SELECT ROUND(longitude, 0)"
        " AS lon, ROUND(latitude, 0) AS lat, date, MAX(temperature_2m_max) AS peak FROM cells WHERE temperature_2m_max >= 45 GROUP BY 1, 2, 3))"
        " WHERE rank = 1"
    )
    rollup = "SELECT COUNT(*) FROM (SELECT date, latitude, longitude, AVG(temperature_2m_mean), MAX(temperature_2m_max) FROM cells GROUP BY 1, 2, 3)"
    by_cell = cells.groupBy("date", "latitude", "longitude").agg(F.avg("temperature_2m_mean"), F.max("temperature_2m_max"))
    return {
        "hottest_day_per_location": [
            best(lambda: REPORTS["hottest_day_per_location"]({"daily_global": cells}).collect()),
            best(lambda: con.execute(hottest).fetchall()),
        ],
        "summarize": [
            best(lambda: REPORTS["summarize_daily_global"]({"daily_global": cells}).collect()),
            best(lambda: con.execute("SUMMARIZE cells").fetchall()),
        ],
        "daily_rollup": [best(by_cell.count), best(lambda: con.execute(rollup).fetchall())],
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("isobar-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    seconds: dict[str, float] = {}

    def timed(name: str, work: Callable, repeats: int = 1):
        result, best = None, float("inf")
        for _ in range(repeats):
            started = time.perf_counter()
            result = work()
            best = min(best, time.perf_counter() - started)
        seconds[name] = round(best, 3)
        return result

    spark.range(10**6).selectExpr("sum(id)").collect()
    source = fixtures.obs(spark, sf_dir)
    days = observed_days(source)

    def run_all() -> Elt:
        fresh = Elt(spark, scratch_root(spark))
        fresh.run(source, days)
        return fresh

    elt = timed("elt_run", run_all, REPEATS)
    timed("elt_rerun_failed_days", lambda: elt.run(source, days))
    views = elt.views()
    for name, report in REPORTS.items():
        timed(name, lambda report=report: report(views).collect(), REPEATS)
    timed("marts_with_tests", lambda: build_marts(spark, views, scratch_root(spark)), REPEATS)

    cells = timed("build_daily_global", lambda: stage(fixtures.daily(spark, sf_dir)), REPEATS)
    regional = timed("build_daily_regional", lambda: stage(fixtures.daily_regional(spark, sf_dir)), REPEATS)
    years = {"daily_global": cells, "daily_regional": regional}
    for name in ("summarize_daily_global", "hottest_day_per_location", "diurnal_range", "rolling_30d", "hottest_days_per_region"):
        timed(f"{name}_years", lambda name=name: REPORTS[name](years).collect(), REPEATS)

    def audit_layers() -> None:
        for layer in (elt.bronze(), elt.silver()):
            variables = tuple(v for v in layer.columns if v in HOURLY_GRID.variable_names)
            audit.null_report(layer, variables).collect()
            audit.hours_check(layer, len(days)).collect()
            expected = requested_days(elt.bronze())
            audit.missing_days(expected, layer).collect()
            audit.extra_days(expected, layer).collect()

    def audit_gold() -> None:
        for table in (elt.daily_global(), gold.regional_view(elt.daily_regional())):
            audit.table_null_report(table).collect()
            audit.missing_days(requested_days(elt.bronze()), table).collect()

    timed("audit_bronze_and_silver", audit_layers, REPEATS)
    timed("audit_gold", audit_gold, REPEATS)
    print(
        json.dumps(
            {
                "metric": "total seconds, best of 3 each (rerun: once)",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf_dir.rstrip("/").rsplit("sf", 1)[-1]),
                "rows": {
                    "daily_global": views["daily_global"].count(),
                    "daily_regional": views["daily_regional"].count(),
                    "daily_global_years": cells.count(),
                    "daily_regional_years": regional.count(),
                },
                **({"large": large(spark, int(os.environ["BENCH_ROWS"]))} if os.environ.get("BENCH_ROWS") else {}),
            }
        )
    )


if __name__ == "__main__":
    main()
