"""Column profiles: one row per column with extremes, distinct values, moments, quartiles and nulls."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from isobar.functions.exact import PARTS, joined, sum_parts
from isobar.functions.numeric import null_percentage
from isobar.operators.audit import SQL_TYPES
from isobar.session import stage

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
#: Size of the quantile sketches. The rank of a quartile is then off by less than RANK_ERROR of the rows, in 99 of 100 cases, and the
#: error falls as the size grows. Approximate distinct counts have a relative standard deviation of DISTINCT_DEVIATION.
SKETCH_SIZE = 4000
RANK_ERROR = 0.001
DISTINCT_DEVIATION = 0.05


def _numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def _by_column(df: DataFrame, measures: list[Column], rows: list[Column]) -> DataFrame:
    """One wide aggregate over the table, turned into one row per column."""
    return df.agg(*measures).select(F.inline(F.array(*rows)))


def moments(df: DataFrame) -> DataFrame:
    """Extremes, counts, mean and deviation of every column, in generated code throughout."""
    measures: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    rows: list[Column] = []
    for field in df.schema.fields:
        c, dtype = field.name, field.dataType.simpleString()
        measures += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), F.count(c).alias(f"{c}__n")]
        avg = std = F.lit(None).cast("double")
        if _numeric(field):
            value = F.col(c).cast("double")
            measures += [F.avg(value).alias(f"{c}__avg"), F.stddev_samp(value).alias(f"{c}__std")]
            avg, std = F.col(f"{c}__avg"), F.col(f"{c}__std")
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.lit(SQL_TYPES.get(dtype, dtype.upper())).alias("column_type"),
                F.col(f"{c}__min").cast("string").alias("min"),
                F.col(f"{c}__max").cast("string").alias("max"),
                avg.alias("avg"),
                std.alias("std"),
                F.col(f"{c}__n").alias("count"),
                F.when(F.col("_rows") > 0, null_percentage(F.col(f"{c}__n"), F.col("_rows"))).alias("null_percentage"),
            )
        )
    return _by_column(df, measures, rows)


def sketches(df: DataFrame, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """Approximate distinct counts and quartiles: mergeable sketches of bounded size per task and column."""
    measures: list[Column] = []
    rows: list[Column] = []
    for field in df.schema.fields:
        c = field.name
        measures.append(F.approx_count_distinct(c).alias(f"{c}__distinct"))
        quartiles = F.lit(None).cast("array<double>")
        if _numeric(field):
            measures.append(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(sketch_size)).alias(f"{c}__sketch"))
            sketch, wanted = F.col(f"{c}__sketch"), F.array(*[F.lit(q) for q in QUARTILES.values()])
            filled = F.kll_sketch_get_n_double(sketch) > 0
            quartiles = F.when(filled, F.kll_sketch_get_quantile_double(sketch, wanted))
        rows.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(f"{c}__distinct").alias("distinct_values"),
                quartiles.alias("quartiles"),
            )
        )
    return _by_column(df, measures, rows).select(
        "column_name", "distinct_values", *[F.col("quartiles")[i].alias(q) for i, q in enumerate(QUARTILES)]
    )


def profile(df: DataFrame, exact: bool = False, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """Profile every column of a table.

    By default distinct counts and quartiles are sketches. They run as an aggregate of their
    own: next to them, the extremes and moments would lose their generated code, which costs
    more than reading the columns again. ``exact`` counts every distinct value instead, which
    shuffles them all. The joined parts have one row per column of the table.
    """
    if not exact:
        return moments(df).join(F.broadcast(sketches(df, sketch_size)), "column_name")
    counted = value_counts(df)
    distinct = counted.groupBy("column_name").agg(F.count(F.lit(1)).alias("distinct_values"))
    quartiles = exact_quantiles(counted, QUARTILES)
    return (
        moments(df)
        .join(F.broadcast(distinct), "column_name", "left")
        .join(F.broadcast(quartiles), "column_name", "left")
        .withColumn("distinct_values", F.coalesce("distinct_values", F.lit(0)).cast("bigint"))
    )


def within_bounds(df: DataFrame, sketched: DataFrame, rank_error: float = RANK_ERROR) -> DataFrame:
    """A sketched profile of ``df`` with ``distinct_near`` (within four deviations) and ``quartiles_near`` (each quartile lies between the
    exact values at ranks ``rank_error`` below and above its own; NULL for columns without quartiles)."""
    counted = value_counts(df)
    around = {
        f"{name}_{side}": min(max(p + shift, 0.0), 1.0)
        for name, p in QUARTILES.items()
        for side, shift in (("low", -rank_error), ("high", rank_error))
    }
    distinct = counted.groupBy("column_name").agg(F.count(F.lit(1)).alias("exact_distinct"))
    joined = sketched.join(F.broadcast(distinct), "column_name", "left").join(
        F.broadcast(exact_quantiles(counted, around)), "column_name", "left"
    )
    exact = F.coalesce("exact_distinct", F.lit(0))
    near = [F.col(q).between(F.col(f"{q}_low"), F.col(f"{q}_high")) for q in QUARTILES]
    return joined.withColumn(
        "distinct_near", F.abs(F.col("distinct_values") - exact) <= 4 * DISTINCT_DEVIATION * exact + 1
    ).withColumn("quartiles_near", reduce(Column.__and__, near))


def value_counts(df: DataFrame) -> DataFrame:
    """Distinct values of all columns with their frequencies, range-partitioned by column and value.

    Equal values collapse before the shuffle, so a value held by a third of all rows is one
    row here. ``block`` numbers the range partitions in value order. Written to the shared
    folder, because several steps read it.
    """

    def entry(field: T.StructField) -> Column:
        number = F.col(field.name).cast("double") if _numeric(field) else F.lit(None).cast("double")
        text = F.lit(None).cast("string") if _numeric(field) else F.col(field.name).cast("string")
        return F.struct(F.lit(field.name).alias("column_name"), number.alias("number"), text.alias("text"))

    long = df.select(F.inline(F.array(*[entry(f) for f in df.schema.fields])))
    present = long.where(F.col("number").isNotNull() | F.col("text").isNotNull())
    counted = present.groupBy("column_name", "number", "text").agg(F.count(F.lit(1)).alias("n"))
    ranged = counted.repartitionByRange("column_name", "number", "text")
    return stage(ranged.withColumn("block", F.spark_partition_id()))


def exact_quantiles(counted: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Interpolated quantiles of every numeric column without gathering a column anywhere.

    Rank positions are found per block from block totals; only the blocks that hold a wanted
    rank are ranked inside. There are at most two of them per column and quantile, so they are
    broadcast to the value counts, which are filtered where they lie.
    """
    numbers = counted.where(F.col("number").isNotNull())
    blocks = numbers.groupBy("column_name", "block").agg(F.sum("n").alias("block_n"))
    before = Window.partitionBy("column_name").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("column_name")
    placed = blocks.select(
        "column_name",
        "block",
        "block_n",
        F.coalesce(F.sum("block_n").over(before), F.lit(0)).alias("rows_before"),
        F.sum("block_n").over(whole).alias("total"),
    )
    wanted = F.array(
        *[
            F.struct(F.lit(name).alias("quantile"), (F.lit(p) * (F.col("total") - 1)).alias("position"))
            for name, p in quantiles.items()
        ]
    )
    targets = placed.select("column_name", "block", "block_n", "rows_before", F.inline(wanted)).where(
        (F.ceil("position") >= F.col("rows_before"))
        & (F.floor("position") < F.col("rows_before") + F.col("block_n"))
    )
    inside = Window.partitionBy("column_name", "block", "quantile").orderBy("number")
    ranked = numbers.join(F.broadcast(targets), ["column_name", "block"]).withColumn(
        "last", F.col("rows_before") + F.sum("n").over(inside) - 1
    )

    def at(rank: Column) -> Column:
        holds = (F.col("last") - F.col("n") < rank) & (rank <= F.col("last"))
        return F.max(F.when(holds, F.col("number")))

    position = F.col("position")
    ends = ranked.groupBy("column_name", "quantile", "position").agg(
        at(F.floor(position)).alias("lower"), at(F.ceil(position)).alias("upper")
    )
    share = position - F.floor(position)
    values = ends.withColumn("value", F.col("lower") + share * (F.col("upper") - F.col("lower")))
    return values.groupBy("column_name").agg(
        *[F.max(F.when(F.col("quantile") == name, F.col("value"))).alias(name) for name in quantiles]
    )


# Profiles from stored states: one row per day and column, merged without reading the table again.

#: Bits of the registers that distinct counts are estimated from: a relative standard deviation of 1.04 / 2^(bits / 2), or 1.6 %.
DISTINCT_BITS = 12
STATE = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("column_type", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("n", T.LongType()),
        *[T.StructField(f"sum_{part}", T.DoubleType() if kind == "double" else T.LongType()) for part, kind in PARTS.items()],
        T.StructField("mean", T.DoubleType()),
        T.StructField("spread", T.DoubleType()),
        T.StructField("low", T.StringType()),
        T.StructField("low_number", T.DoubleType()),
        T.StructField("high", T.StringType()),
        T.StructField("high_number", T.DoubleType()),
        T.StructField("quantiles", T.BinaryType()),
        T.StructField("distinct_values", T.BinaryType()),
    ]
)


def day_states(df: DataFrame, sketch_size: int = SKETCH_SIZE) -> DataFrame:
    """The mergeable state of every column but the day, per day: counts, the parts of the sum, mean and sum of squared deviations, extremes, a
    quantile sketch (KLL) and a distinct-count sketch (HLL) of 64-bit hashes.

    A day's state has a bounded size whatever the number of its rows. Extremes are kept as text, next to the number they are compared by.
    """
    measures: list[Column] = [F.count(F.lit(1)).alias("_rows")]
    rows: list[Column] = []
    for field in df.schema.fields:
        c, dtype = field.name, field.dataType.simpleString()
        if c == "date":
            continue
        held = F.when(F.col(c).isNotNull(), F.xxhash64(c))
        measures += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max"), F.count(c).alias(f"{c}__n")]
        measures.append(F.hll_sketch_agg(held, F.lit(DISTINCT_BITS)).alias(f"{c}__distinct"))
        cells = dict.fromkeys((f.name for f in STATE.fields), F.lit(None)) | {
            "date": F.col("date"),
            "column_name": F.lit(c),
            "column_type": F.lit(SQL_TYPES.get(dtype, dtype.upper())),
            "n_rows": F.col("_rows"),
            "n": F.col(f"{c}__n"),
            "low": F.col(f"{c}__min").cast("string"),
            "high": F.col(f"{c}__max").cast("string"),
            "distinct_values": F.col(f"{c}__distinct"),
        }
        if _numeric(field):
            value = F.col(c).cast("double")
            measures += [total.alias(f"{c}__{part}") for part, total in sum_parts(value).items()]
            measures += [F.var_pop(value).alias(f"{c}__var"), F.kll_sketch_agg_double(value, F.lit(sketch_size)).alias(f"{c}__sketch")]
            parts = {part: F.col(f"{c}__{part}") for part in PARTS}
            cells |= {f"sum_{part}": total for part, total in parts.items()} | {
                "mean": F.when(F.col(f"{c}__n") > 0, joined(parts) / F.col(f"{c}__n")),
                "spread": F.col(f"{c}__var") * F.col(f"{c}__n"),
                "low_number": F.col(f"{c}__min").cast("double"),
                "high_number": F.col(f"{c}__max").cast("double"),
                "quantiles": F.col(f"{c}__sketch"),
            }
        rows.append(F.struct(*[cells[f.name].cast(f.dataType).alias(f.name) for f in STATE.fields]))
    return df.groupBy("date").agg(*measures).select(F.inline(F.array(*rows)))


def _date_state(states: DataFrame) -> DataFrame:
    """The profile of the day column itself, which needs no sketch of its own: its values are the days."""
    days = states.groupBy("date").agg(F.max("n_rows").alias("n"))
    return days.agg(
        F.lit("date").alias("column_name"),
        F.lit("DATE").alias("column_type"),
        F.min("date").cast("string").alias("min"),
        F.max("date").cast("string").alias("max"),
        F.count(F.lit(1)).alias("distinct_values"),
        F.lit(None).cast("double").alias("avg"),
        F.lit(None).cast("double").alias("std"),
        *[F.lit(None).cast("double").alias(q) for q in QUARTILES],
        F.sum("n").alias("count"),
        F.when(F.sum("n") > 0, F.lit(0.0)).alias("null_percentage"),
    ).where(F.col("count") > 0)


def profile_from_states(states: DataFrame) -> DataFrame:
    """The profile that ``profile`` gives, from day states alone: work grows with the days and columns and not with the rows.

    Sums merge exactly. The deviation is that within the days plus that of the days' means from the whole mean, so no large squares cancel. Equal
    sketch sizes merge within the bounds that one sketch of the whole table has.
    """
    whole = states.groupBy("column_name").agg(
        F.max("column_type").alias("column_type"),
        F.coalesce(F.min_by("low", "low_number"), F.min("low")).alias("min"),
        F.coalesce(F.max_by("high", "high_number"), F.max("high")).alias("max"),
        F.sum("n").alias("count"),
        F.sum("n_rows").alias("n_rows"),
        *[F.sum(f"sum_{part}").alias(f"sum_{part}") for part in PARTS],
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("distinct_values"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )
    mean = joined({part: F.col(f"sum_{part}") for part in PARTS}) / F.nullif("count", F.lit(0))
    whole = whole.withColumn("avg", mean)
    apart = states.join(whole.select("column_name", "avg"), "column_name")
    spread = F.sum(F.col("spread") + F.col("n") * F.pow(F.col("mean") - F.col("avg"), F.lit(2)))
    spreads = apart.groupBy("column_name").agg(spread.alias("spread"))
    wanted = F.array(*[F.lit(q) for q in QUARTILES.values()])
    filled = F.col("avg").isNotNull()
    quartiles = F.when(filled, F.kll_sketch_get_quantile_double("quantiles", wanted))
    merged = whole.join(spreads, "column_name").withColumn("quartiles", quartiles)
    columns = merged.select(
        "column_name",
        "column_type",
        "min",
        "max",
        "distinct_values",
        "avg",
        F.when(F.col("count") > 1, F.sqrt(F.col("spread") / (F.col("count") - 1))).alias("std"),
        *[F.col("quartiles")[i].alias(q) for i, q in enumerate(QUARTILES)],
        "count",
        F.when(F.col("n_rows") > 0, null_percentage(F.col("count"), F.col("n_rows"))).alias("null_percentage"),
    )
    return columns.unionByName(_date_state(states))
