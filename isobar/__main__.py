"""Command line: run the layers for a day or a range of days, build the marts, audit the tables, show a report or a query.

    python -m isobar run --landing PATH --root PATH --date 2015-01-15
    python -m isobar run --landing PATH --root PATH --start 2015-01-15 --end 2016-01-15 --redo
    python -m isobar marts --root PATH
    python -m isobar audit null_report --root PATH
    python -m isobar report rolling_7d --root PATH --value wind_speed_mean
    python -m isobar report diurnal_range --root PATH --day 2015-01-15 --min-range 25
    python -m isobar summary daily_global --root PATH
    python -m isobar tables --root PATH
    python -m isobar sql "SELECT region, MAX(temp_max) FROM daily_regional GROUP BY region" --root PATH --out PATH
"""

from __future__ import annotations

import argparse
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from isobar.functions.dates import day_range
from isobar.operators import audit
from isobar.plans.audits import AUDITS
from isobar.plans.elt import Elt
from isobar.plans.marts import build_marts
from isobar.plans.reports import REPORTS, report_on
from isobar.session import configure
from isobar.sources.landing import scan_observations
from isobar.sources.tables import register_views
from isobar.specs import SOURCE_NAME, declared


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="isobar")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="landing to bronze, silver and gold")
    run.add_argument("--landing", required=True)
    days = run.add_mutually_exclusive_group(required=True)
    days.add_argument("--date", type=date.fromisoformat, help="one day")
    days.add_argument("--start", type=date.fromisoformat, help="first day of a range")
    run.add_argument("--end", type=date.fromisoformat, help="last day of a range")
    run.add_argument("--batch-days", type=int, help="days per job; all at once if not given")
    run.add_argument("--redo", action="store_true", help="land the days again and rebuild everything from them")
    run.add_argument("--laid-out", action="store_true", help="the landing is ordered by day and cell: copy it without a shuffle")
    run.add_argument("--source", default=SOURCE_NAME, help="where the landing comes from, for lineage")
    marts = commands.add_parser("marts", help="test the gold views and build the marts")
    audits = commands.add_parser("audit", help="print an audit of the stored tables")
    audits.add_argument("name", choices=sorted(AUDITS))
    report = commands.add_parser("report", help="print a report over the gold views")
    report.add_argument("name", choices=sorted(REPORTS))
    report.add_argument("--value", help="the column to report on, where the report takes one")
    summary = commands.add_parser("summary", help="print a column profile of a gold table from its stored sketches")
    summary.add_argument("name", choices=("daily_global", "daily_regional"))
    report.add_argument("--day", type=date.fromisoformat, help="one day only, where the report takes one")
    for limit in ("lat-min", "lat-max", "min-range", "threshold"):
        report.add_argument(f"--{limit}", type=float, help="a limit other than the report's own, where it takes one")
    listing = commands.add_parser("tables", help="print the tables and views with their sizes")
    sql = commands.add_parser("sql", help="print the result of a query over the gold views")
    sql.add_argument("query")
    for command in (audits, report, summary, listing, sql):
        command.add_argument("--out", help="write the whole result there as Parquet instead of printing it")
    for command in (run, marts, audits, report, summary, listing, sql):
        command.add_argument("--root", required=True)
        command.add_argument("--declarations", help="JSON file with regions, threshold and statistics of the deployment")
    parsed = parser.parse_args(words)
    if parsed.command == "run" and parsed.start and not parsed.end:
        parser.error("--end is required with --start")
    return parsed


def deliver(result: DataFrame, out: str | None) -> None:
    """All rows, to a table or, one partition at a time, to the screen."""
    if out:
        result.write.mode("overwrite").parquet(out)
        return
    print("\t".join(result.columns))
    for row in result.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(words: list[str] | None = None, spark: SparkSession | None = None) -> None:
    asked = arguments(words)
    spark = spark or configure(SparkSession.builder.appName("isobar").getOrCreate())
    own = {}
    if asked.declarations:
        with open(asked.declarations, encoding="utf-8") as file:
            own = declared(file.read())
    elt = Elt(spark, asked.root, source=getattr(asked, "source", SOURCE_NAME), **own)
    if asked.command == "run":
        days = [asked.date] if asked.date else day_range(asked.start, asked.end)
        report = elt.run(scan_observations(spark, asked.landing), days, asked.batch_days, asked.redo, asked.laid_out)
        print(f"Total execution time: {report.seconds:.2f}s")
        if report.failed:
            print(f"{len(report.failed)} days failed: {sorted(d.isoformat() for d in report.failed)}")
        else:
            print("All days processed.")
    elif asked.command == "marts":
        build_marts(spark, elt.views(), elt.at.marts)
    elif asked.command == "audit":
        deliver(AUDITS[asked.name](elt), asked.out)
    elif asked.command == "summary":
        deliver(elt.summary(asked.name), asked.out)
    elif asked.command == "report":
        limits = {limit: getattr(asked, limit) for limit in ("day", "lat_min", "lat_max", "min_range", "threshold")}
        deliver(report_on(asked.name, elt.views(), asked.value, **limits), asked.out)
    elif asked.command == "tables":
        views = elt.views()
        register_views(spark, views)
        deliver(audit.list_tables(spark, tuple(views)), asked.out)
    else:
        register_views(spark, elt.views())
        deliver(spark.sql(asked.query), asked.out)


if __name__ == "__main__":
    main()
