"""Hourly, per-cell and per-region tables built from silver."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.exact import PARTS, exact_mean, exact_sum, joined, sum_parts
from isobar.session import stage
from isobar.specs import CELL_STATS, REGION_STATS, REGIONS, Region, region_frame

BIN_DEGREES = 5.0

#: Means and sums do not depend on the order in which rows are added.
STATISTICS = {
    "mean": lambda c: exact_mean(F.col(c) if isinstance(c, str) else c),
    "min": F.min,
    "max": F.max,
    "sum": lambda c: exact_sum(F.col(c) if isinstance(c, str) else c),
    "added": F.sum,
}


def _bin(column: str) -> Column:
    return F.floor(F.col(column) / BIN_DEGREES)


def _inside(box: Column) -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    return lat.between(box["lat_min"], box["lat_max"]) & lon.between(box["lon_min"], box["lon_max"])


def assign_regions(df: DataFrame, regions: Sequence[Region] | DataFrame = REGIONS) -> DataFrame:
    """One row per observation and region containing it, both ends of a box inclusive.

    A region may be several boxes; an observation in more than one of them counts once. Both sides meet on a coarse
    latitude/longitude bin, where each region has the list of its boxes. The lists are written first, so that the planner knows
    their size: below ``spark.sql.autoBroadcastJoinThreshold`` the join is a broadcast hash join, above it a sort-merge join with
    adaptive skew handling.
    """
    boxes = regions if isinstance(regions, DataFrame) else region_frame(df.sparkSession, tuple(regions))

    def bins(axis: str) -> Column:
        return F.explode(F.sequence(_bin(f"{axis}_min"), _bin(f"{axis}_max")))

    box = F.struct("lat_min", "lat_max", "lon_min", "lon_max")
    binned = boxes.withColumn("lat_bin", bins("lat")).withColumn("lon_bin", bins("lon"))
    listed = stage(binned.groupBy("region", "lat_bin", "lon_bin").agg(F.collect_set(box).alias("boxes")))
    cells = df.withColumn("lat_bin", _bin("latitude")).withColumn("lon_bin", _bin("longitude"))
    joined = cells.join(listed, ["lat_bin", "lon_bin"]).where(F.exists("boxes", _inside))
    return joined.drop("lat_bin", "lon_bin", "boxes")


def _named(stats: dict[str, tuple[str, ...]]) -> dict[str, tuple[str, str]]:
    """``temperature_2m_mean`` and so on: the statistic and the variable behind each result column."""
    return {f"{variable}_{s}": (s, variable) for variable, names in stats.items() for s in names}


def aggregate_regions(
    df: DataFrame, measures: dict[str, tuple[str, str]], regions: Sequence[Region] | DataFrame = REGIONS
) -> DataFrame:
    """Statistics per region and day; ``measures`` maps a result column to (statistic, column).

    Declared regions become conditional aggregates: one pass that neither copies an observation for each region it lies in
    nor joins anything. Regions of a table are joined. Either way a region may be several boxes, which count as one.
    """
    if isinstance(regions, DataFrame):
        plain = [STATISTICS[s](column).alias(name) for name, (s, column) in measures.items()]
        return assign_regions(df, regions).groupBy("date", "region").agg(*plain)
    wide: list[Column] = []
    rows: list[Column] = []
    boxes: dict[str, list[Region]] = {}
    for box in regions:
        boxes.setdefault(box.name, []).append(box)
    for number, (region, parts) in enumerate(boxes.items()):
        inside = reduce(
            Column.__or__,
            [
                F.col("latitude").between(b.lat_min, b.lat_max) & F.col("longitude").between(b.lon_min, b.lon_max)
                for b in parts
            ],
        )
        wide.append(F.count_if(inside).alias(f"{number}__cells"))
        for name, (s, column) in measures.items():
            wide.append(STATISTICS[s](F.when(inside, F.col(column))).alias(f"{number}__{name}"))
        results = [F.col(f"{number}__{name}").alias(name) for name in measures]
        rows.append(F.struct(F.lit(region).alias("region"), F.col(f"{number}__cells").alias("cells"), *results))
    per_day = df.groupBy("date").agg(*wide).select("date", F.inline(F.array(*rows)))
    return per_day.where(F.col("cells") > 0).drop("cells")


def hourly_table(silver: DataFrame, variables: tuple[str, ...]) -> DataFrame:
    """The flat hourly table: silver in long form is already that table."""
    return silver.select("time", "date", "latitude", "longitude", *variables)


def daily_rollup(silver: DataFrame, stats: dict[str, tuple[str, ...]] = CELL_STATS) -> DataFrame:
    """Per cell and day; a cell whose values are all NULL keeps its row."""
    carried = [F.max("spatial_ref").alias("spatial_ref")] if "spatial_ref" in silver.columns else []
    return silver.groupBy("date", "latitude", "longitude").agg(
        *carried, *[STATISTICS[s](variable).alias(name) for name, (s, variable) in _named(stats).items()]
    )


def cell_totals(silver: DataFrame, stats: dict[str, tuple[str, ...]]) -> DataFrame:
    """Per cell and day what any rollup over whole cells needs: the parts of the sum, number, minimum and maximum of each variable."""
    carried = [F.max("spatial_ref").alias("spatial_ref")] if "spatial_ref" in silver.columns else []
    totals = []
    for v in stats:
        totals += [total.alias(f"{v}__{part}") for part, total in sum_parts(F.col(v)).items()]
        totals += [F.count(v).alias(f"{v}__n"), F.min(v).alias(f"{v}__min"), F.max(v).alias(f"{v}__max")]
    return silver.groupBy("date", "latitude", "longitude").agg(*carried, *totals)


def _from_totals(variable: str, statistic: str) -> Column:
    if statistic in ("min", "max"):
        return F.col(f"{variable}__{statistic}")
    total = joined({part: F.col(f"{variable}__{part}") for part in PARTS})
    if statistic == "sum":
        return total
    count = F.col(f"{variable}__n")
    return F.when(count > 0, total / count)


def cells_from_totals(totals: DataFrame, stats: dict[str, tuple[str, ...]]) -> DataFrame:
    """The per-cell rollup."""
    carried = ["spatial_ref"] if "spatial_ref" in totals.columns else []
    measures = [_from_totals(v, s).alias(name) for name, (s, v) in _named(stats).items()]
    return totals.select("date", "latitude", "longitude", *carried, *measures)


def regions_from_totals(
    totals: DataFrame, regions: Sequence[Region] | DataFrame, stats: dict[str, tuple[str, ...]]
) -> DataFrame:
    """The regional rollup, without reading silver again. Parts of sums and numbers add up, so the mean is that of all hours and cells."""
    kinds = dict.fromkeys((*PARTS, "n"), "added") | {"min": "min", "max": "max"}
    measures = {f"{v}__{k}": (s, f"{v}__{k}") for v in stats for k, s in kinds.items()}
    added = aggregate_regions(totals, measures, regions)
    return added.select("date", "region", *[_from_totals(v, s).alias(name) for name, (s, v) in _named(stats).items()])


def regional_rollup(
    silver: DataFrame,
    regions: Sequence[Region] | DataFrame = REGIONS,
    stats: dict[str, tuple[str, ...]] = REGION_STATS,
) -> DataFrame:
    """Per region and day, unweighted over all hours and cells of the box at once."""
    return aggregate_regions(silver, _named(stats), regions)


#: Report names of the variables.
SHORT_NAMES = {"temperature_2m": "temp", "wind_speed_10m": "wind_speed"}


def regional_view(table: DataFrame) -> DataFrame:
    """The regional table under the names the reports use."""

    def short(column: str) -> str:
        variable, _, statistic = column.rpartition("_")
        return f"{SHORT_NAMES.get(variable, variable)}_{statistic}"

    measures = [c for c in table.columns if c not in ("date", "region")]
    return table.select("date", "region", *[F.col(c).alias(short(c)) for c in measures])
