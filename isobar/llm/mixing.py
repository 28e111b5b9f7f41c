"""Mix sources to target weights by pivotal dependent rounding.

Every document of a source should be taken target / size of the source times. The whole part is taken outright. The fractional parts
are rounded by the pivotal method: a unit meets the unit that still holds a fraction, mass moves at random between the two until one
of them is 0 or 1, and the other goes on. Mass is words, not copies: each document's expectation stays exact, and the words of a
source change only when the last unit of all is drawn.

Meetings run through blocks of bounded size, the largest document first, so that small ones are left to hold fractions. The units
left at the end of their blocks meet in blocks of the next level of a tree, down to one unit per source.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.llm.common import let, unit_draw, word_count
from isobar.session import stage

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Units of a block, as a mean.
BLOCK = 256
OUT = "array<struct<i:int,size:bigint,pick:int>>"


def text_salt(text: Column) -> Column:
    """Tells rows with the same id apart."""
    return F.substring(F.md5(text), 1, 16)


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, most: int) -> DataFrame:
    """``sizes`` (source, source_size, units, one row per source) with the words to take of each source.

    Weights go round in code-point order of the sources, NULL last. Sources are filled in proportion to weight up to ``most`` times
    their size, and what is over is shared again until none is above: one level of filling holds for all sources below their bound.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("bound") / F.col("weight"), F.col("source").asc_nulls_last())
    earlier, later = by_ratio.rowsBetween(Window.unboundedPreceding, -1), by_ratio.rowsBetween(0, Window.unboundedFollowing)
    rows = sizes.withColumn("weight", weight).withColumn("bound", F.col("source_size") * most)
    total = F.sum("source_size").over(everything) * F.lit(share)
    level = (total - F.coalesce(F.sum("bound").over(earlier), F.lit(0))) / F.sum("weight").over(later)
    rows = rows.withColumn("total", total).withColumn("full", F.col("bound") / F.col("weight") <= level)
    left = F.col("total") - F.sum(F.when(F.col("full"), F.col("bound")).otherwise(0)).over(everything)
    open_weight = F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).over(everything)
    rows = rows.withColumn("left", left).withColumn("open_weight", open_weight)
    target = F.when(F.col("full"), F.col("bound").cast("double")).otherwise(F.col("left") / F.col("open_weight") * F.col("weight"))
    return rows.select("source", "source_size", "units", target.alias("target"))


def _meeting(state: Column, unit: Column) -> Column:
    """The unit that holds a fraction meets the next one: one of the two is decided, the other holds on.

    Mass is counted in words. ``up`` is what the holder can take from the unit, ``down`` what it can give; the odds keep
    both expectations, and the words of the two together stay the same.
    """
    held, met = state["p"] * state["size"], unit["p"] * unit["size"]
    room, met_room = (1 - state["p"]) * state["size"], (1 - unit["p"]) * unit["size"]
    amounts = F.struct(F.least(room, met).alias("up"), F.least(held, met_room).alias("down"))

    def outcome(m: Column) -> Column:
        rises = unit["draw"] * (m["up"] + m["down"]) < m["down"]

        def settle(holder_done: Column, pick: int, rest: Column, other: int, kept: Column) -> Column:
            done = F.struct(*_named(state, "i", "size"), F.lit(pick).alias("pick"))
            done_unit = F.struct(*_named(unit, "i", "size"), F.lit(other).alias("pick"))
            onward = _state(unit["i"], unit["size"], rest, F.concat(state["out"], F.array(done)))
            stay = _state(state["i"], state["size"], kept, F.concat(state["out"], F.array(done_unit)))
            return F.when(holder_done, onward).otherwise(stay)

        rising = settle(room <= met, 1, unit["p"] - m["up"] / unit["size"], 0, state["p"] + m["up"] / state["size"])
        falling = settle(held <= met_room, 0, unit["p"] + m["down"] / unit["size"], 1, state["p"] - m["down"] / state["size"])
        return F.when(rises, rising).otherwise(falling)

    first = _state(unit["i"], unit["size"], unit["p"], state["out"])
    return F.when(state["i"] < 0, first).otherwise(let(amounts, outcome))


def _named(row: Column, *names: str) -> list[Column]:
    return [row[n].alias(n) for n in names]


def _state(i: Column, size: Column, p: Column, out: Column) -> Column:
    return F.struct(i.alias("i"), size.alias("size"), F.least(F.greatest(p, F.lit(0.0)), F.lit(1.0)).alias("p"), out.alias("out"))


def _meet(units: DataFrame, level: int, seed: str) -> DataFrame:
    """One run of meetings per (source, block), largest unit first: ``pick`` 0 or 1, or NULL for the unit left holding ``p``."""
    draw = unit_draw(F.lit(seed), F.lit(level), F.col("id").cast("string"), F.col("salt")) / F.lit(float(1 << 40))
    rest = [c for c in units.columns if c not in ("source", "block", "id", "salt", "size", "p")]
    unit = F.struct((-F.col("size")).alias("order"), "id", "salt", "size", "p", draw.alias("draw"), *rest)
    runs = units.groupBy("source", "block").agg(F.array_sort(F.collect_list(unit)).alias("run"))
    nobody = F.struct(
        F.lit(-1).alias("i"), F.lit(0).cast("bigint").alias("size"), F.lit(0.0).alias("p"), F.expr(f"cast(array() as {OUT})").alias("out")
    )
    meeting = F.transform("run", lambda u, i: F.struct(i.alias("i"), *_named(u, "size", "p", "draw")))

    def outcomes(end: Column) -> Column:
        holding = F.struct(*_named(end, "i"), F.lit(None).cast("int").alias("pick"), *_named(end, "p"))
        decided = F.transform(end["out"], lambda o: F.struct(*_named(o, "i", "pick"), F.lit(0.0).alias("p")))
        return F.concat(decided, F.array(holding))

    met = runs.select("source", "run", F.explode(let(F.aggregate(meeting, nobody, _meeting), outcomes)).alias("o"))
    met = met.select("source", F.get("run", F.col("o.i")).alias("u"), "o.pick", "o.p")
    return met.select("source", *[f"u.{c}" for c in ("id", "salt", "size", *rest)], "pick", "p")


def _blocks(count: Column, block: int) -> Column:
    return F.greatest(F.ceil(count / F.lit(block)), F.lit(1)).cast("bigint")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = "mix",
    block: int = BLOCK,
    id_column: str = "doc_id",
    source_column: str = "source",
    text_column: str = "text",
) -> DataFrame:
    """One row per document: id, source, size, its source's size and target, and the number of times the mix takes it.

    The size is the number of words. Blocks are chosen by a hash of id and text, about ``block`` documents each, whatever the size of
    the source. The tree has one level per factor of ``block`` in the largest source's number of documents; a level writes its
    outcome to the shared folder, which also carries the rows past lost executors. Draws depend on the seed, the level, the
    id and the text only, so reruns agree.

    A NULL or empty text has size 0 and is taken 0 times; NULL sources form one source, which is ordered last; documents with a NULL
    or repeated id are units of their own. A source of size 0 has the target 0. An empty table gives no rows. Other columns are not read.
    """
    rows = stage(
        docs.select(
            F.col(id_column).cast("bigint").alias("id"),
            F.col(source_column).cast("string").alias("source"),
            word_count(F.col(text_column)).alias("size"),
            text_salt(F.col(text_column)).alias("salt"),
        )
    )
    has_words = F.when(F.col("size") > 0, 1)
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(has_words).alias("units"))
    targets = stage(source_targets(sizes, weights, share, most))
    largest = targets.agg(F.max("units")).first()[0] or 0

    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of")
    joined = joined.withColumn("copies", F.when(F.col("size") > 0, copies).otherwise(0.0)).withColumn("base", F.floor("copies").cast("bigint"))
    joined = joined.withColumn("p", F.col("copies") - F.col("base")).drop("copies")
    decided = [joined.where("p = 0").withColumn("pick", F.lit(0)).drop("p", "units")]
    units, level = joined.where("p > 0"), 0
    while largest > 0:
        place = unit_draw(F.lit(seed), F.lit("block"), F.lit(level), F.col("id").cast("string"), F.col("salt"))
        count = _blocks(F.col("units"), block)
        run = units.withColumn("block", F.pmod(place, count)).withColumn("units", count)
        met = stage(_meet(run, level, seed))
        decided.append(met.where("pick IS NOT NULL").drop("p", "units"))
        units = met.where("pick IS NULL").drop("pick")
        if largest <= block:
            break
        largest, level = -(-largest // block), level + 1
    last = unit_draw(F.lit(seed), F.lit("last"), F.col("id").cast("string"), F.col("salt")) / F.lit(float(1 << 40))
    decided.append(units.withColumn("pick", (last < F.col("p")).cast("int")).drop("p", "units"))
    mixed = reduce(DataFrame.unionByName, decided)
    return mixed.select("id", "source", "salt", "size", "source_size", "target", (F.col("base") + F.col("pick")).cast("bigint").alias("copies"))


def take(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents (doc_id, text, source, and any other columns) as often as ``mix`` takes them.

    Rows that agree in id, source and text share their number of copies as evenly as it goes. Numbering them adds no shuffle: the
    join has already brought them together.
    """

    def keyed(df: DataFrame, id_: Column, source: Column, salt: Column, *rest: Column) -> DataFrame:
        null_id, null_source = F.lit(-(2**63)).cast("bigint"), F.lit("")
        return df.select(
            F.coalesce(id_.cast("bigint"), null_id).alias("k_id"),
            F.coalesce(F.concat(F.lit("="), source.cast("string")), null_source).alias("k_source"),
            F.coalesce(salt, F.lit("")).alias("k_salt"),
            *rest,
        )

    keys = ["k_id", "k_source", "k_salt"]
    packed = docs.select(F.struct(*docs.columns).alias("row"))
    rows = keyed(packed, F.col("row.doc_id"), F.col("row.source"), text_salt(F.col("row.text")), F.col("row"))
    counts = keyed(mixed, F.col("id"), F.col("source"), F.col("salt"), F.col("copies")).groupBy(*keys)
    counts = counts.agg(F.sum("copies").alias("total"), F.count(F.lit(1)).alias("same")).where("total > 0")
    turn = F.row_number().over(Window.partitionBy(*keys).orderBy(*keys))
    share = F.expr("total div same") + (F.col("turn") <= F.col("total") % F.col("same")).cast("bigint")
    taken = rows.join(counts, keys).withColumn("turn", turn).select("row", share.alias("n")).where("n > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("bigint"), "n"))).select("row.*")
