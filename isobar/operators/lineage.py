"""Lineage records and the ledger of finished days."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.operators.silver import kept_variables
from isobar.specs import CELL_STATS, DERIVED, GOLD_INPUTS, GOLD_TABLES, HOURLY_GRID, SOURCE_NAME, DatasetSpec, Region

OK, FAILED, REDO = "ok", "failed", "redo"
VALUE_BYTES = 4

LEDGER = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("transformation", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("recorded_at", T.TimestampType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)
LINEAGE = T.StructType(
    [
        T.StructField("layer", T.StringType()),
        T.StructField("transformation", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("parent_layer", T.StringType()),
        T.StructField("parent_date", T.DateType()),
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("variable_count", T.IntegerType()),
        T.StructField("variables", T.ArrayType(T.StringType())),
        T.StructField("variables_dropped", T.ArrayType(T.StringType())),
        T.StructField("variables_derived", T.ArrayType(T.StringType())),
        T.StructField("aggregation_logic", T.StringType()),
        T.StructField("spatial_bounds", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("size_bytes", T.LongType()),
        T.StructField("execution_duration_seconds", T.DoubleType()),
    ]
)
JOURNAL = T.StructType(
    [
        *LINEAGE.fields,
        T.StructField("status", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("fingerprint", T.StringType()),
    ]
)


def aggregation_text(stats: Mapping[str, Iterable[str]]) -> str:
    """What the lineage of a rollup states: its period, and the statistics it holds of each variable."""
    return json.dumps({"time": "1D", "metrics": {variable: list(names) for variable, names in stats.items()}})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` in order, NULL where ``df`` lacks one."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields]
    )


def _stamp(df: DataFrame, layer: str, transformation: str, source: str, parent: str | None) -> DataFrame:
    return (
        df.withColumn("layer", F.lit(layer))
        .withColumn("transformation", F.lit(transformation))
        .withColumn("source", F.lit(source))
        .withColumn("parent_layer", F.lit(parent).cast("string"))
        .withColumn("parent_date", F.col("date") if parent else F.lit(None).cast("date"))
        .withColumn("ingestion_timestamp", F.current_timestamp())
    )


def _sized(records: DataFrame) -> DataFrame:
    """Number of variables and the bytes their values take uncompressed."""
    return records.withColumn("variable_count", F.size("variables")).withColumn(
        "size_bytes", F.col("row_count") * VALUE_BYTES * F.col("variable_count")
    )


def bronze_lineage(profile: DataFrame, spec: DatasetSpec = HOURLY_GRID, source: str = SOURCE_NAME) -> DataFrame:
    """One record per ingested day: time span, variables and the bytes their values take."""
    names = [F.when(F.col(f"{v}__count").isNotNull(), F.lit(v)) for v in sorted(spec.variable_names)]
    records = profile.select(
        "date",
        "start_time",
        "end_time",
        F.filter(F.array(*names), lambda name: name.isNotNull()).alias("variables"),
        F.col("n_rows").alias("row_count"),
    )
    return _stamp(_sized(records), "bronze", "bronze", source, None)


def silver_lineage(status: DataFrame, spec: DatasetSpec = HOURLY_GRID, source: str = SOURCE_NAME) -> DataFrame:
    """One record per day that passed: variables kept, dropped and derived, time span, bytes."""
    names = kept_variables(spec)
    records = status.where("passed").select(
        "date",
        "start_time",
        "end_time",
        names["variables_kept"].alias("variables"),
        names["variables_dropped"].alias("variables_dropped"),
        names["variables_derived"].alias("variables_derived"),
        F.col("n_rows").alias("row_count"),
    )
    return _stamp(_sized(records), "silver", "silver", source, "bronze")


def gold_lineage(
    table: DataFrame,
    transformation: str,
    spatial_bounds: str,
    source: str = SOURCE_NAME,
    stats: Mapping[str, Iterable[str]] = CELL_STATS,
) -> DataFrame:
    """One record per day of a gold table; over a day table the count reads file footers only."""
    records = table.groupBy("date").agg(F.count(F.lit(1)).alias("row_count"))
    records = records.withColumn("aggregation_logic", F.lit(aggregation_text(stats))).withColumn(
        "spatial_bounds", F.lit(spatial_bounds)
    )
    return _stamp(records, "gold", transformation, source, "silver")


def bounds_text(regions: Iterable[Region]) -> str:
    """Region boxes as JSON slices; latitude runs from north to south."""

    def slice_of(start: float, stop: float) -> dict[str, float | None]:
        return {"start": start, "stop": stop, "step": None}

    return json.dumps(
        {
            r.name: {"lat_slice": slice_of(r.lat_max, r.lat_min), "lon_slice": slice_of(r.lon_min, r.lon_max)}
            for r in regions
        }
    )


def gold_blockers(inputs: Iterable[str] = GOLD_INPUTS) -> Column:
    """The gold inputs a passed day lacks, because they or what they derive from were dropped."""
    sources = {d.name: d.inputs for d in DERIVED}
    lacking = []
    for name in inputs:
        dropped = F.lit(False)
        for i in sources.get(name, (name,)):
            dropped = dropped | F.col(f"{i}__drop")
        lacking.append(F.when(dropped, F.lit(name)))
    return F.filter(F.array(*lacking).cast("array<string>"), lambda name: name.isNotNull())


def blocked_reason(blockers: str) -> str:
    return f"Missing variable: {blockers}"


def gold_ready(status: DataFrame, inputs: Iterable[str] = GOLD_INPUTS) -> DataFrame:
    """Status rows of the days whose silver holds every gold input."""
    return status.where(F.col("passed") & (F.size(gold_blockers(inputs)) == 0))


def failed_days(status: DataFrame, inputs: Iterable[str] = GOLD_INPUTS) -> DataFrame:
    """One row per failing day: the layer it failed to reach and why."""
    blockers = gold_blockers(inputs)
    return (
        status.withColumn(
            "stage",
            F.when(~F.col("passed"), F.lit("silver")).when(F.size(blockers) > 0, F.lit("gold")),
        )
        .where(F.col("stage").isNotNull())
        .select(
            "date",
            "stage",
            F.when(F.col("stage") == "silver", F.col("reason"))
            .otherwise(F.concat(F.lit(blocked_reason("")), F.array_join(blockers, ", ")))
            .alias("reason"),
        )
    )


def ledger_rows(
    days: DataFrame, layer: str, transformation: str, status: str = OK, reason: Column | None = None
) -> DataFrame:
    """Ledger entries for days that reached, or failed to reach, a table."""
    return days.select(
        F.lit(layer).alias("layer"),
        F.lit(transformation).alias("transformation"),
        "date",
        F.lit(status).alias("status"),
        (F.lit(None).cast("string") if reason is None else reason).alias("reason"),
        F.current_timestamp().alias("recorded_at"),
        F.lit(None).cast("string").alias("fingerprint"),
    )


def journal_rows(records: DataFrame, failures: DataFrame | None, layer: str, transformation: str) -> DataFrame:
    """Lineage of the finished days and the reasons of the failed ones, as entries of one table."""
    entries = conform(records.withColumn("status", F.lit(OK)), JOURNAL)
    if failures is None:
        return entries
    failed = (
        failures.select("date", "reason", *[c for c in failures.columns if c == "fingerprint"])
        .withColumn("layer", F.lit(layer))
        .withColumn("transformation", F.lit(transformation))
        .withColumn("ingestion_timestamp", F.current_timestamp())
        .withColumn("status", F.lit(FAILED))
    )
    return entries.unionByName(conform(failed, JOURNAL))


def journal_ledger(journal: DataFrame) -> DataFrame:
    return conform(journal.withColumn("recorded_at", F.col("ingestion_timestamp")), LEDGER)


def journal_lineage(journal: DataFrame) -> DataFrame:
    return conform(journal.where(F.col("status") == OK), LINEAGE)


def ledger_of(status: DataFrame) -> DataFrame:
    """The ledger a run over these days leaves behind.

    Every day reaches bronze; daily gold runs before regional, so a day that lacks an input
    reaches neither.
    """
    failures = failed_days(status)
    entries = [
        ledger_rows(status, "bronze", "bronze"),
        ledger_rows(status.where("passed"), "silver", "silver"),
        ledger_rows(failures.where("stage = 'silver'"), "silver", "silver", FAILED, F.col("reason")),
    ]
    for transformation in GOLD_TABLES:
        entries.append(ledger_rows(gold_ready(status), "gold", transformation))
        blocked = failures.where("stage = 'gold'")
        entries.append(ledger_rows(blocked, "gold", transformation, FAILED, F.col("reason")))
    combined = entries[0]
    for entry in entries[1:]:
        combined = combined.unionByName(entry)
    return combined


def latest(ledger: DataFrame) -> DataFrame:
    """The last word on each table and day."""
    last = F.max_by(F.struct("status", "reason", "fingerprint"), "recorded_at").alias("last")
    return ledger.groupBy("layer", "transformation", "date").agg(last).select("layer", "transformation", "date", "last.*")


def journal_marks(days: DataFrame, layer: str, transformation: str, status: str) -> DataFrame:
    """Journal entries that say nothing but a status."""
    marks = days.withColumn("layer", F.lit(layer)).withColumn("transformation", F.lit(transformation))
    marks = marks.withColumn("status", F.lit(status)).withColumn("ingestion_timestamp", F.current_timestamp())
    return conform(marks, JOURNAL)


def pending(requested: DataFrame, ledger: DataFrame, layer: str, transformation: str) -> DataFrame:
    """Requested days the ledger does not list as finished for this table."""
    done = latest(ledger).where(
        (F.col("status") == OK) & (F.col("layer") == layer) & (F.col("transformation") == transformation)
    )
    return requested.join(done.select("date"), "date", "left_anti")


def gold_completeness(requested: DataFrame, ledger: DataFrame, required: tuple[str, ...] = GOLD_TABLES) -> DataFrame:
    """Per requested day: how many of the required gold tables are finished, and whether all are."""
    finished = (
        latest(ledger)
        .where((F.col("status") == OK) & (F.col("layer") == "gold") & F.col("transformation").isin(*required))
        .groupBy("date")
        .agg(F.count(F.lit(1)).alias("finished"))
    )
    count = F.coalesce("finished", F.lit(0))
    return requested.join(finished, "date", "left").select(
        "date", count.cast("bigint").alias("finished"), (count == len(required)).alias("all_done")
    )
