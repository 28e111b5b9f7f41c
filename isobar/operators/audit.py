"""Audits of finished tables: nulls, hours, missing days, declared tests, schema listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isobar.functions.dates import SECONDS_PER_DAY, utc_day
from isobar.functions.numeric import null_percentage
from isobar.session import stage
from isobar.specs import HOURLY_GRID

MASK_BITS = 62
KEY_COLUMNS = ("latitude", "longitude", "spatial_ref", "date")

# SQL names of the stored types, and the not-null tests declared on the gold views.
SQL_TYPES = {
    "double": "DOUBLE",
    "float": "FLOAT",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "date": "DATE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
}
NOT_NULL = {
    "stg_daily_regional": ("date", "region"),
    "stg_daily_global": ("date", "latitude", "longitude"),
}


def _rows_from(df: DataFrame, rows: list[Column]) -> DataFrame:
    return df.select(F.inline(F.array(*rows)))


def null_report(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Per column over all days: elements, values and null share, from one aggregate."""
    totals = df.agg(F.count(F.lit(1)).alias("_total"), *[F.count(c).alias(c) for c in columns])
    return _rows_from(
        totals,
        [
            F.struct(
                F.lit(c).alias("variable"),
                F.col("_total").alias("total_elements"),
                F.col(c).alias("non_null_count"),
                F.when(F.col("_total") > 0, null_percentage(F.col(c), F.col("_total"))).alias("null_percentage"),
            )
            for c in columns
        ],
    )


def table_null_report(df: DataFrame, ignore: tuple[str, ...] = KEY_COLUMNS) -> DataFrame:
    return null_report(df, tuple(c for c in df.columns if c not in ignore))


def days_present(df: DataFrame) -> DataFrame:
    return df.select("date").distinct()


def missing_days(expected: DataFrame, df: DataFrame) -> DataFrame:
    """Expected days the table does not have."""
    return expected.join(days_present(df), "date", "left_anti")


def extra_days(expected: DataFrame, df: DataFrame) -> DataFrame:
    """Days the table has although nobody expected them."""
    return days_present(df).join(expected, "date", "left_anti")


def _cell_days(obs: DataFrame, steps: int) -> DataFrame:
    """Per cell and day: how many rows, and which of the day's time steps they are on, as one bit each.

    A time off the step grid, or any time where a day has more steps than there are bits, is
    kept as a key of its own. ``n_rows > bit_count(on)`` then says exactly that some time is
    there twice. On tables laid out by cell, a day of a cell is one row before the shuffle.
    """
    time = F.col("time")
    at = F.pmod(F.unix_seconds(time), F.lit(SECONDS_PER_DAY))
    slot = (at * steps / F.lit(SECONDS_PER_DAY)).cast("int")
    if steps <= MASK_BITS:
        off_grid = F.when((at * steps % SECONDS_PER_DAY != 0) | (F.date_trunc("second", time) != time), time)
        on = F.call_function("shiftleft", F.lit(1).cast("bigint"), slot)
    else:
        off_grid, on = time, F.lit(1).cast("bigint")
    return (
        obs.where(time.isNotNull())
        .select(utc_day(time).alias("day"), "latitude", "longitude", off_grid.alias("off_grid"), on.alias("on"))
        .groupBy("day", "latitude", "longitude", "off_grid")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_or("on").alias("on"))
        .withColumn("repeated", F.col("n_rows") > F.bit_count("on"))
    )


def duplicate_observations(obs: DataFrame, steps: int = HOURLY_GRID.time_steps) -> DataFrame:
    """Times a cell has more than one row for, with the number of rows.

    Only the cells and days that repeat a time are counted by time. They are listed in the
    shared folder first, so that a short list is broadcast and a long one is not.
    """
    suspects = _cell_days(obs, steps).where("repeated").select("day", "latitude", "longitude").distinct()
    keys = stage(suspects.withColumnsRenamed({"latitude": "lat", "longitude": "lon"}))
    same_cell = F.col("latitude").eqNullSafe(F.col("lat")) & F.col("longitude").eqNullSafe(F.col("lon"))
    rows = obs.join(keys, (utc_day(F.col("time")) == F.col("day")) & same_cell, "left_semi")
    counted = rows.groupBy("time", "latitude", "longitude").agg(F.count(F.lit(1)).alias("copies"))
    return counted.where(F.col("copies") > 1)


def hours_check(obs: DataFrame, n_days: int, steps: int = HOURLY_GRID.time_steps) -> DataFrame:
    """Expected against present time steps, and whether any cell has one twice: one pass, one small shuffle."""
    per_day = (
        _cell_days(obs, steps)
        .groupBy("day", "off_grid")
        .agg(F.bit_or("on").alias("on"), F.bool_or("repeated").alias("repeated"))
    )
    expected = F.lit(n_days * steps).cast("bigint")
    present = F.coalesce(F.sum(F.bit_count("on").cast("bigint")), F.lit(0).cast("bigint"))
    return per_day.agg(present.alias("ingested_hours"), F.bool_or("repeated").alias("repeated")).select(
        expected.alias("expected_hours"),
        "ingested_hours",
        (expected == F.col("ingested_hours")).alias("hours_equal"),
        F.coalesce("repeated", F.lit(False)).alias("duplicate_timestamps"),
    )


def not_null_tests(tables: dict[str, DataFrame], tests: dict[str, tuple[str, ...]] = NOT_NULL) -> DataFrame:
    """The declared not-null tests: failures per table and column, one scan per table."""
    results = []
    for table, columns in tests.items():
        nulls = tables[table].agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
        results.append(
            _rows_from(
                nulls,
                [
                    F.struct(
                        F.lit(table).alias("table_name"),
                        F.lit(c).alias("column_name"),
                        F.col(c).alias("failures"),
                        (F.col(c) != 0).alias("should_warn"),
                        (F.col(c) != 0).alias("should_error"),
                    )
                    for c in columns
                ],
            )
        )
    combined = results[0]
    for result in results[1:]:
        combined = combined.unionByName(result)
    return combined


class FailedTests(RuntimeError):
    """A declared test found rows it must not find."""


def require_passing(results: DataFrame) -> None:
    """Stop before anything downstream is built. There is one result row per declared test."""
    failed = [f"{r.table_name}.{r.column_name}: {r.failures}" for r in results.where("should_error").collect()]
    if failed:
        raise FailedTests("; ".join(failed))


def sql_type(stored: str) -> str:
    return SQL_TYPES.get(stored, stored.upper())


def describe(df: DataFrame, counts: bool = False) -> DataFrame:
    """Name, SQL type and nullability of every column; ``counts`` adds the number of values it holds."""
    source = df.agg(*[F.count(c).alias(c) for c in df.columns]) if counts else df.sparkSession.range(1)
    return _rows_from(
        source,
        [
            F.struct(
                F.lit(field.name).alias("column_name"),
                F.lit(sql_type(field.dataType.simpleString())).alias("column_type"),
                F.lit("YES" if field.nullable else "NO").alias("null"),
                *([F.col(field.name).alias("n_values")] if counts else []),
            )
            for field in df.schema.fields
        ],
    )


def list_tables(spark: SparkSession, names: tuple[str, ...]) -> DataFrame:
    """The registered tables and views among ``names``, with their sizes."""
    listings = [
        spark.table(t.name).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(t.name).alias("table_name"),
            F.lit("VIEW" if t.tableType in ("TEMPORARY", "VIEW") else "BASE TABLE").alias("table_type"),
            "n_rows",
        )
        for t in spark.catalog.listTables()
        if t.name in names
    ]
    if not listings:
        return spark.createDataFrame([], "table_name string, table_type string, n_rows bigint")
    combined = listings[0]
    for listing in listings[1:]:
        combined = combined.unionByName(listing)
    return combined
