"""Rolling means for keys of any length: a long key is cut into blocks of days, and each block gets the rows before it that its frames need."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window, functions as F

from isobar.functions.numeric import round_half_up
from isobar.session import stage

BLOCK_DAYS = 365
#: Rows without a day come before all others.
NO_DAY = -(2**31)
#: Sparse days are one block up to this many frames of rows, and a key with no more rows is not cut.
FRAMES = 16


def _cuts(own: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Of keys with more than ``FRAMES`` frames of rows, each block of days (of_..., from): the block it becomes a part of (into), the rows
    behind it there (behind), and the later blocks that are reached from there (near).

    Blocks of days with fewer rows than a frame would be copied many times, up to ``width - 1`` rows for each of them. Neighbouring ones are
    put together, so a block has a frame of rows or more, unless it lies between two such blocks.
    """
    long = own.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FRAMES * width)
    long = stage(long.select(*[F.col(k).alias(f"of_{k}") for k in keys]))
    mine = reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys])
    days = own.join(long, mine, "left_semi").groupBy(*keys, "block").agg(F.count(F.lit(1)).alias("n"))

    before = Window.partitionBy(*keys).orderBy("block")
    upto = before.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    full = F.col("n") >= width
    days = days.withColumn("full", full).withColumn("upto", F.sum("n").over(upto)).withColumn("run", F.sum(full.cast("bigint")).over(upto))
    sparse = F.sum(F.when(full, 0).otherwise(F.col("n"))).over(upto)
    days = days.withColumn("piece", F.when(full, 0).otherwise(F.floor((sparse - 1) / (FRAMES * width))))
    of = Window.partitionBy(*keys, "run", "full", "piece")
    days = days.withColumn("into", F.min("block").over(of)).withColumn("end", F.max("upto").over(of))

    blocks = days.groupBy(*keys, "into").agg(F.max("end").alias("end"), F.sum("n").alias("n"))
    later = F.collect_list(F.struct("into", (F.col("end") - F.col("n")).alias("start"))).over(Window.partitionBy(*keys).orderBy("into").rowsBetween(1, width - 1))
    # rows between the block and a later one
    gaps = F.transform("later", lambda x: F.struct(x["into"].alias("to"), (x["start"] - F.col("end")).alias("between")))
    reached = blocks.withColumn("later", later).withColumn("near", F.filter(gaps, lambda x: x["between"] < width - 1)).select(*keys, "into", "near")
    of_keys = [F.col(k).alias(f"of_{k}") for k in keys]
    named = reached.select(*of_keys, F.col("into").alias("whole"), "near")
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys], F.col("into") == F.col("whole"))
    return stage(days.join(named, same).select(*of_keys, F.col("block").alias("from"), "into", (F.col("end") - F.col("upto")).alias("behind"), "near"))


def with_halos(rows: DataFrame, keys: Sequence[str], day: str, value: str, width: int, block_days: int) -> DataFrame:
    """``keys``, ``day`` and ``value`` with ``block`` and ``halo``: every row in its own block, and a copy with ``halo`` in each later block
    that reaches back to it with a frame of ``width`` rows.

    Keys with more than ``FRAMES`` frames of rows are cut into blocks of ``block_days`` days; sparse neighbouring ones make one block of
    about as many frames. A frame may still reach back over several blocks, so each block lists the later ones that have fewer than
    ``width - 1`` rows between; the last rows of the block go to those they still concern. Rows per group are then those of
    ``block_days`` days, or of some ``FRAMES`` frames, and ``width - 1`` more, however long the key. A NULL key is a key.
    """
    block = F.floor(F.coalesce(F.unix_date(F.col(day)), F.lit(NO_DAY)) / block_days).cast("bigint")
    own = rows.select(*keys, day, value, block.alias("block"))
    if width < 2:
        return own.withColumn("halo", F.lit(False))
    cuts = _cuts(own, keys, width)
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"of_{k}")) for k in keys], F.col("block") == F.col("from"))
    placed = own.join(cuts.select(*[f"of_{k}" for k in keys], "from", "into"), same, "left")
    placed = placed.select(*keys, day, value, F.coalesce("into", F.lit(0).cast("bigint")).alias("block"), F.lit(False).alias("halo"))

    ends = cuts.where((F.size("near") > 0) & (F.col("behind") < width - 1))
    met = own.join(ends, same)
    last = Window.partitionBy(*keys, "into").orderBy(F.col(day).desc(), F.col(value).desc())
    tails = met.withColumn("from_end", F.row_number().over(last)).where(F.col("from_end") < width)
    wanted = F.filter("near", lambda x: x["between"] + F.col("from_end") < width)
    halos = tails.select(*keys, day, value, F.explode(wanted).alias("x")).select(*keys, day, value, F.col("x.to").alias("block"), F.lit(True).alias("halo"))
    return placed.unionByName(halos)


def rolling_mean_by_key(
    rows: DataFrame, keys: Sequence[str], width: int, value: str, name: str, rolled: str, day: str = "date", block_days: int = BLOCK_DAYS
) -> DataFrame:
    """Mean over the current and the ``width - 1`` preceding rows of a key, as a window over the whole key gives it.

    Rows of a key and day are ordered by value. NULL values count as rows and not in the mean. One group holds ``block_days`` days of
    a key or some frames, so neither a long key nor one that holds most rows comes into one task. The rows are read more than once.
    """
    frame = Window.partitionBy(*keys, "block").orderBy(day, value).rowsBetween(1 - width, 0)
    met = with_halos(rows, keys, day, value, width, block_days).withColumn("mean", F.avg(value).over(frame)).where(~F.col("halo"))
    return met.select(*keys, F.col(day).alias("day"), round_half_up(F.col(value), 2).alias(name), round_half_up(F.col("mean"), 2).alias(rolled))
