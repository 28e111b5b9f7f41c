"""Reading landed observations, slicing days and putting uneven partitions together."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from isobar.functions.dates import utc_day


def clean(df: DataFrame) -> DataFrame:
    """NaN becomes NULL, once, here; from then on NULL is the only missing value."""
    columns = [
        F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name, metadata=f.metadata)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        else F.col(f.name)
        for f in df.schema.fields
    ]
    return df.select(*columns)


EPOCH = "TIMESTAMP '1970-01-01 00:00:00Z' + (time - TIMESTAMP_NTZ '1970-01-01 00:00:00')"


def instants(df: DataFrame) -> DataFrame:
    """A ``time`` without a zone is UTC, whatever the session's time zone."""
    if isinstance(df.schema["time"].dataType, T.TimestampNTZType):
        return df.withColumn("time", F.expr(EPOCH))
    return df


def land(df: DataFrame, spatial_ref: int = 0) -> DataFrame:
    """Cleaned observations with the ``date`` key and the scalar coordinate as columns.

    A ``date`` that the landing table has is kept as it is; the gate compares it with ``time``. Without one, it is the
    UTC day of ``time``.
    """
    df = clean(df)
    if "time" in df.columns:
        df = instants(df)
    if "date" not in df.columns:
        df = df.withColumn("date", utc_day(F.col("time")))
    if "spatial_ref" not in df.columns:
        df = df.withColumn("spatial_ref", F.lit(spatial_ref).cast("bigint"))
    return df


def scan_observations(spark: SparkSession, path: str) -> DataFrame:
    """Lazy scan of a landing folder of Parquet files."""
    return land(spark.read.parquet(path))


def days_slice(df: DataFrame, days: list[date]) -> DataFrame:
    """The rows of the listed days.

    A row belongs to its ``date`` and to nothing else, so that it is in the same slice however days are batched. On a
    partitioned landing table the test prunes partitions.
    """
    return df.where(F.col("date").isin(days))


def land_days(df: DataFrame, days: list[date]) -> DataFrame:
    """``land`` and ``days_slice`` in one. Where ``date`` follows from ``time``, the days bound ``time`` as well, which reaches
    row-group statistics and changes nothing else."""
    if days and "date" not in df.columns:
        bare = isinstance(df.schema["time"].dataType, T.TimestampNTZType)

        def midnight(day: date) -> Column:
            return F.lit(f"{day} 00:00:00{'' if bare else 'Z'}").cast("timestamp_ntz" if bare else "timestamp")

        df = df.where((F.col("time") >= midnight(min(days))) & (F.col("time") < midnight(max(days) + timedelta(days=1))))
    return days_slice(land(df), days)


def fingerprints(df: DataFrame, days: list[date]) -> DataFrame | None:
    """Per listed day of a landing table of files: its files, rows and a digest of the names, sizes, times and rows of the files that hold it.

    Reads at most the column that tells the day. The digest adds up over files, so a day of many files is never gathered; it changes if a file of the
    day is added, removed, rewritten or gets other rows. Nothing for a table that is no scan of files.
    """
    source = [F.col(f"_metadata.{c}").alias(f"_{c}") for c in ("file_name", "file_size", "file_modification_time")]
    try:
        told = land_days(df, days).select("date", *source)
    except AnalysisException:
        return None
    files = told.groupBy("date", "_file_name", "_file_size", "_file_modification_time").agg(F.count(F.lit(1)).alias("n"))
    mark = F.xxhash64("_file_name", "_file_size", "_file_modification_time", "n").cast("decimal(38,0)")
    added = files.groupBy("date").agg(F.count(F.lit(1)).alias("files"), F.sum("n").alias("n_rows"), F.sum(mark).alias("marks"))
    return added.select("date", "files", "n_rows", F.concat_ws(":", "files", "n_rows", "marks").alias("fingerprint"))


def day_slice(df: DataFrame, day: date) -> DataFrame:
    """One UTC calendar day."""
    return days_slice(df, [day])


def concat_days(frames: list[DataFrame]) -> DataFrame:
    """Day tables on top of each other; a variable missing from one of them reads as NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
