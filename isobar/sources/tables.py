"""Tables partitioned by day: layout, idempotent writes, reads and byte sizes."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from isobar.session import delete

LATITUDE_BAND = 15.0


def store_as_float(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The storage type of the array variables: 4-byte floats, half the bytes to scan."""
    narrow = set(columns)
    return df.select(
        *[
            F.col(f.name).cast("float").alias(f.name, metadata=f.metadata) if f.name in narrow else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _day_order(df: DataFrame) -> list[str]:
    return [c for c in ("date", "latitude", "longitude", "time") if c in df.columns]


def lay_out_days(df: DataFrame) -> DataFrame:
    """Bring the hours of a cell together, so that the daily rollup shrinks 24 to 1 before its shuffle.

    Rebalancing by day and latitude band lets adaptive execution split a band that is too
    large and merge bands that are too small; no task has to hold a hot day or cell whole.
    """
    if "latitude" not in df.columns:
        return df.hint("rebalance", F.col("date"))
    keyed = df.withColumn("latitude_band", F.floor(F.col("latitude") / LATITUDE_BAND))
    return keyed.hint("rebalance", F.col("date"), F.col("latitude_band")).drop("latitude_band")


def write_days(df: DataFrame, path: str, laid_out: bool = False) -> None:
    """Replace exactly the days present in ``df``; other days stay untouched.

    ``laid_out`` says that ``df`` is a row-by-row image of a table written this way. Its
    tasks then write the files they read, without a shuffle.
    """
    spread = df if laid_out else lay_out_days(df)
    ordered = spread.sortWithinPartitions(*_day_order(df))
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)


def _folders(path: str, days: list[date]) -> str:
    """The folders of some days as one pattern, so that the folders of other days are never listed."""
    return f"{path}/date={{{','.join(sorted(d.isoformat() for d in days))}}}"


def read_days(spark: SparkSession, path: str, schema: T.StructType, days: list[date] | None = None) -> DataFrame:
    """Lazy read of a day table, without rows before its first write; with ``days`` only their folders are listed."""
    if days is None:
        return read_or_empty(spark, path, schema)
    if not days:
        return spark.createDataFrame([], schema)
    return read_or_empty(spark, _folders(path, days), schema, path).where(F.col("date").isin(days))


def drop_days(spark: SparkSession, path: str, days: list[date]) -> None:
    """Delete the stored rows of some days, as far as there are any."""
    delete(spark, *[f"{path}/date={d.isoformat()}" for d in days])


def append_rows(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("append").parquet(path)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, root: str | None = None) -> DataFrame:
    """The table, or no rows where nothing was written yet. ``root`` is the table's folder if ``path`` is below it."""
    try:
        return spark.read.option("basePath", root or path).schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def stored(spark: SparkSession, path: str) -> DataFrame | None:
    """The table as it was written, or nothing if it never was."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def day_sizes(spark: SparkSession, path: str, days: list[date] | None = None) -> DataFrame:
    """Bytes and files per day, from the file listing alone: the content column is never read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("basePath", path)
    files = reader.load(_folders(path, days) if days else path)
    return files.groupBy("date").agg(
        F.sum("length").alias("size_bytes"),
        F.count(F.lit(1)).alias("files"),
    )


def register_views(spark: SparkSession, views: dict[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)
