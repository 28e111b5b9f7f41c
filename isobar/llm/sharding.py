"""Shards by jump consistent hashing.

The key walks a pseudo-random chain of shard numbers; its shard is the last one below the number of shards. The chain does not
depend on that number, so appending a shard moves only the keys whose chain visits it, and no ring table is kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# Fixed values of the published algorithm: the multiplier of its 64-bit generator, and the range of its draws.
MULTIPLIER = 2862933555777941757
DRAWS = 2**31
#: Blocks of keys within a shard in which slots are counted; bounds the table of offsets, whatever the input.
SLOT_BLOCKS = 1024
#: Bytes that each row costs besides its text.
ROW_BYTES = 8


def jump(key: Column, shards: int) -> Column:
    """A struct of ``b``, the shard of ``key`` among ``shards``, and ``j``, the next shard of its chain (``shards`` or more).

    The 64-bit product is taken in decimals, which hold it whole. A NULL key counts as 0.
    """
    start = F.pmod(F.coalesce(key, F.lit(0)).cast("decimal(38,0)"), F.lit(str(2**64)).cast("decimal(38,0)"))
    begin = F.struct(start.cast("decimal(20,0)").alias("key"), F.lit(-1).cast("bigint").alias("b"), F.lit(0).cast("bigint").alias("j"))

    def step(state: Column, _: Column) -> Column:
        product = state["key"] * F.lit(str(MULTIPLIER)).cast("decimal(19,0)") + F.lit(1).cast("decimal(1,0)")
        drawn = (product % F.lit(str(2**64)).cast("decimal(20,0)")).cast("decimal(20,0)")

        def moved(key: Column) -> Column:
            high = F.floor(key / F.lit(str(2**33)).cast("decimal(10,0)")).cast("double")
            ahead = F.floor((state["j"] + 1).cast("double") * (F.lit(float(DRAWS)) / (high + 1))).cast("bigint")
            return F.struct(key.alias("key"), state["j"].alias("b"), ahead.alias("j"))

        return F.when(state["j"] < shards, F.transform(F.array(drawn), moved)[0]).otherwise(state)

    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), begin, step)


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its key, size, checksum, shard, slot within the shard, and shard if one more were appended.

    Law ``key``: only the key and the number of shards decide. The size is the UTF-8 bytes of the text and eight more. Slots count
    from 0 without gaps in the order of blocks of keys: rows are numbered within a block, and a table of at most
    ``shards * SLOT_BLOCKS`` counts, which is all that is broadcast, says where each block begins. So no task holds a shard.

    A NULL key counts as key 0; a NULL text has size 8 and no checksum; an empty one the checksum 0. Rows that repeat a key share its
    shard and get slots of their own, ordered by checksum. An empty table gives no rows. Other columns are not read.
    """
    chain = jump(F.col("id"), shards)
    rows = docs.select(F.col(key).cast("bigint").alias("id"), F.col(text).alias("body")).select(
        "id",
        (F.coalesce(F.octet_length("body"), F.lit(0)) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32("body").cast("bigint").alias("text_crc32"),
        chain.alias("chain"),
        F.pmod(F.xxhash64("id"), F.lit(SLOT_BLOCKS)).alias("block"),
    )
    rows = rows.select("id", "size", "text_crc32", F.col("chain.b").alias("shard"), F.col("chain.j").alias("after"), "block")
    counts = rows.groupBy("shard", "block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = counts.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("shard", "block").orderBy("id", "text_crc32", "size")
    placed = rows.withColumn("rank", F.row_number().over(inside)).join(F.broadcast(begins), ["shard", "block"])
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("begin") + F.col("rank") - 1).cast("bigint").alias("slot"),
        F.when(F.col("after") == shards, F.lit(shards)).otherwise(F.col("shard")).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int, key: str = "doc_id") -> None:
    """The documents as Parquet, one folder per shard; tasks write to the folders, large shards as several files."""
    tagged = docs.select("*", jump(F.col(key).cast("bigint"), shards)["b"].cast("int").alias("shard_folder"))
    tagged.hint("rebalance", "shard_folder").write.mode("overwrite").partitionBy("shard_folder").parquet(path)
