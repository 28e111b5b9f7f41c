"""Places in a sorted order, without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.session import stage

_IN_PART = 33  # bits of monotonically_increasing_id() that count rows of a partition


def places(rows: DataFrame, group: Sequence[str], order: Sequence[Column], name: str = "pos") -> DataFrame:
    """``rows`` with each row's place in its group, from 0, in the written ``order``; a NULL is a group of its own, the first one.

    Rows are range-partitioned by group, order and a number of their own, so neither a hot group nor equal rows meet in one task. Every
    partition then numbers its rows by itself, and a row per group and partition says how many rows of the group came before.
    """
    keys = [F.col(c).asc_nulls_first() for c in group] + list(order)
    salted = rows.withColumn("_turn", F.monotonically_increasing_id())
    ordered = salted.repartitionByRange(*keys, "_turn").sortWithinPartitions(*keys, "_turn").drop("_turn")
    written = stage(ordered.withColumn("_at", F.monotonically_increasing_id()))
    numbered = written.withColumn("_part", F.shiftright("_at", _IN_PART))
    runs = numbered.groupBy("_part", *group).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1) if group else Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = runs.select("_part", "_first", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"), *[F.col(c).alias(f"_of_{c}") for c in group])
    same = F.col("_part") == F.col("_run_part")
    for c in group:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    met = numbered.join(before.withColumnRenamed("_part", "_run_part"), same)
    return met.select(*rows.columns, (F.col("_before") + F.col("_at") - F.col("_first")).alias(name))
