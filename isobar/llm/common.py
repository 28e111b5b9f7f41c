"""Column expressions and table access that several operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

SPACES = " \t\n\x0b\f\r"
GAP = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words(text: Column) -> Column:
    """The maximal runs of characters other than space and U+0009 to U+000D; none for NULL."""
    return F.when(trimmed(text) != "", F.split(trimmed(text), GAP)).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.when(trimmed(text) != "", F.size(F.split(trimmed(text), GAP))).otherwise(0).cast("bigint")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` names it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def unit_draw(*parts: Column, bits: int = 40) -> Column:
    """A whole number in 0 .. 2^bits - 1 that follows from the text of ``parts`` alone."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, bits // 4), 16, 10).cast("bigint")


def empty_to(text: Column, value: str) -> Column:
    return F.coalesce(text, F.lit(value))
