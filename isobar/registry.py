"""Every operator as a query over the driver's tables: (session, table folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from isobar.functions import dates, text, weather
from isobar.functions.exact import exact_sum
from isobar.functions.numeric import round_half_up
from isobar.operators import analytics, audit, gold, lineage, profile, quality, rolling, silver as to
from isobar.plans.elt import Elt
from isobar.plans.marts import build_marts
from isobar.session import configure, scratch_root, stage
from isobar.sources import fixtures, grids, landing, tables
from isobar.specs import HOURLY_GRID

Query = Callable[[SparkSession, str], DataFrame]

SLICED_DAY = date(2024, 1, 10)
DAYS_AHEAD = 6
EXACT_VALUES = ("temperature_2m", "wind_speed_10m")
LIST_BLOCK = 4
#: Days of a block of the rolling means per cell, fewer than the rows of a frame, so that frames reach over several blocks.
ROLLING_BLOCK = 14
TABLES = (("bronze", "bronze"), ("silver", "silver"), ("gold", "daily_global"), ("gold", "daily_regional"))

_QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    _QUERIES[build.__name__] = lambda spark, sf_dir: build(configure(spark), sf_dir)
    return build


def registered() -> dict[str, Query]:
    return dict(_QUERIES)


def six(name: str) -> Column:
    """Six decimals: all that agrees between engines where roots, angles or means of means are involved."""
    return round_half_up(F.col(name), 6).alias(name)


def rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[six(c) if c in names else F.col(c) for c in df.columns])


def widened(df: DataFrame) -> DataFrame:
    """Stored floats as doubles, so that results compare value by value."""
    return df.select(*[F.col(c).cast("double").alias(c) if t == "float" else F.col(c) for c, t in df.dtypes])


# inputs


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.land(fixtures.obs(spark, sf_dir))


def day_status(observations: DataFrame) -> DataFrame:
    """The verdict per day, written once: the planner then knows its size and broadcasts it only if small."""
    return stage(quality.day_status(quality.day_profile(observations)))


def silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    observations = obs(spark, sf_dir)
    return to.to_silver(observations, day_status(observations))


def gold_silver_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the days that go on to gold."""
    observations = obs(spark, sf_dir)
    return to.to_silver(observations, lineage.gold_ready(day_status(observations)))


def requested_days(observations: DataFrame) -> DataFrame:
    """A request from the first observed day to some days past the last."""
    span = observations.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    return span.select(F.explode(F.sequence("first", F.date_add("last", DAYS_AHEAD))).alias("date"))


def observed_days(observations: DataFrame) -> list[date]:
    """One entry per calendar day."""
    return sorted(r.date for r in observations.select("date").distinct().collect())


def new_elt(spark: SparkSession) -> Elt:
    return Elt(spark, scratch_root(spark))


def finished_elt(spark: SparkSession, sf_dir: str) -> Elt:
    elt, source = new_elt(spark), fixtures.obs(spark, sf_dir)
    elt.run(source, observed_days(source))
    return elt


def staging_views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "stg_daily_global": fixtures.daily(spark, sf_dir),
        "stg_daily_regional": fixtures.daily_regional(spark, sf_dir),
    }


# scans, sinks, partitions


@query
def scan_observations(spark, sf_dir):
    return obs(spark, sf_dir)


@query
def day_slice(spark, sf_dir):
    narrowed = landing.land(fixtures.obs(spark, sf_dir, SLICED_DAY, SLICED_DAY))
    return landing.day_slice(narrowed, SLICED_DAY)


@query
def bronze_write_roundtrip(spark, sf_dir):
    elt, source = new_elt(spark), fixtures.obs(spark, sf_dir)
    elt.to_bronze(source, observed_days(source))
    return widened(elt.bronze())


@query
def silver_write_roundtrip(spark, sf_dir):
    elt, source = new_elt(spark), fixtures.obs(spark, sf_dir)
    days = observed_days(source)
    elt.to_bronze(source, days)
    elt.to_silver(days)
    return rounded(widened(elt.silver()), "wind_speed_10m", "wind_direction_10m")


@query
def gold_write_roundtrip(spark, sf_dir):
    cells = finished_elt(spark, sf_dir).daily_global()
    return rounded(widened(cells), "wind_speed_10m_mean", "wind_speed_10m_max")


@query
def stg_daily_global(spark, sf_dir):
    tables.register_views(spark, finished_elt(spark, sf_dir).views())
    return rounded(widened(spark.table("stg_daily_global")), "wind_speed_10m_mean", "wind_speed_10m_max")


@query
def stg_daily_regional(spark, sf_dir):
    tables.register_views(spark, finished_elt(spark, sf_dir).views())
    return rounded(spark.table("stg_daily_regional"), "wind_speed_mean", "wind_speed_max")


@query
def mart_roundtrip(spark, sf_dir):
    return build_marts(spark, staging_views(spark, sf_dir), scratch_root(spark))["mart_regional_monthly_averages"]


@query
def gated_mart(spark, sf_dir):
    return build_marts(spark, staging_views(spark, sf_dir), scratch_root(spark))["mart_global_hottest_days"]


@query
def concat_partitions(spark, sf_dir):
    observations = obs(spark, sf_dir)
    bare = F.dayofmonth("date") == 5
    without = observations.where(bare).drop("precipitation_surface")
    return landing.concat_days([observations.where(~bare), without])


@query
def grid_flatten(spark, sf_dir):
    return grids.flatten(fixtures.table(spark, sf_dir, "embeddings"), "embedding", width=8, keep=("vec_id",))


@query
def grid_pack(spark, sf_dir):
    observations = fixtures.obs(spark, sf_dir, extra=("event_id",))
    packed = grids.pack(observations, "temperature_2m", ("time", "event_id"))
    values = F.transform("values", lambda v: v.cast("string"))
    return packed.select(
        "date",
        "latitude",
        "longitude",
        F.col("rows").alias("steps"),
        F.array_join(values, ",", "null").alias("packed"),
    )


@query
def hourly_global(spark, sf_dir):
    derived = ("wind_speed_10m", "wind_direction_10m", "precipitation_mm_per_hour")
    hourly = gold.hourly_table(silver_of(spark, sf_dir), ("temperature_2m", *derived))
    return rounded(hourly, *derived[:2])


@query
def pending_partitions(spark, sf_dir):
    observations = obs(spark, sf_dir)
    status = day_status(observations)
    requested, ledger = requested_days(observations), lineage.ledger_of(status)
    parts = [
        lineage.pending(requested, ledger, layer, name).select(
            F.lit(layer).alias("layer"), F.lit(name).alias("transformation"), "date"
        )
        for layer, name in TABLES
    ]
    return landing.concat_days(parts)


@query
def gold_completeness(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return lineage.gold_completeness(requested_days(observations), lineage.ledger_of(day_status(observations)))


# projections and derivations


@query
def wind_speed(spark, sf_dir):
    speed = weather.wind_speed(F.col("wind_u_10m"), F.col("wind_v_10m")).alias("wind_speed_10m")
    df = obs(spark, sf_dir).select("time", "latitude", "longitude", "wind_u_10m", "wind_v_10m", speed)
    return rounded(df, "wind_speed_10m")


@query
def wind_direction(spark, sf_dir):
    direction = weather.wind_direction(F.col("wind_u_10m"), F.col("wind_v_10m")).alias("wind_direction_10m")
    df = obs(spark, sf_dir).select("time", "latitude", "longitude", "wind_u_10m", "wind_v_10m", direction)
    return rounded(df, "wind_direction_10m")


@query
def precipitation_mm(spark, sf_dir):
    amount = weather.precipitation_mm_per_hour(F.col("precipitation_surface"))
    return obs(spark, sf_dir).select("time", "latitude", "longitude", amount.alias("precipitation_mm_per_hour"))


@query
def silver(spark, sf_dir):
    return rounded(silver_of(spark, sf_dir), "wind_speed_10m", "wind_direction_10m")


@query
def drop_null_variables(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return to.drop_null_variables(observations, day_status(observations))


@query
def variable_catalog(spark, sf_dir):
    return to.variable_catalog(silver_of(spark, sf_dir))


@query
def diurnal_range(spark, sf_dir):
    return analytics.diurnal_range(fixtures.daily(spark, sf_dir))


@query
def regional_trend(spark, sf_dir):
    return analytics.regional_trend(rounded(fixtures.daily_regional(spark, sf_dir), "temp_mean"))


@query
def region_list(spark, sf_dir):
    return analytics.region_list(fixtures.daily_regional(spark, sf_dir))


@query
def coarsen_grid(spark, sf_dir):
    return analytics.coarsen_grid(fixtures.daily(spark, sf_dir))


# regions and rollups


@query
def region_assign(spark, sf_dir):
    assigned = gold.assign_regions(obs(spark, sf_dir))
    return assigned.select("region", "time", "latitude", "longitude", "temperature_2m")


@query
def daily_global(spark, sf_dir):
    cells = gold.daily_rollup(gold_silver_of(spark, sf_dir))
    return rounded(cells, "wind_speed_10m_mean", "wind_speed_10m_max")


@query
def exact_rollups(spark, sf_dir):
    """Cells and regions per day to the last bit, whatever the partitions: nothing here is rounded."""
    silver = gold_silver_of(spark, sf_dir).repartition(13)
    regions = gold.regional_rollup(silver, stats={v: ("mean", "sum") for v in EXACT_VALUES})
    cells = gold.daily_rollup(silver, {v: ("mean",) for v in EXACT_VALUES})
    near = cells.where("latitude >= 0").groupBy("date").agg(*[exact_sum(F.col(f"{v}_mean")).alias(f"{v}_of_means") for v in EXACT_VALUES])
    return regions.join(near, "date")


@query
def daily_regional(spark, sf_dir):
    regional = gold.regional_rollup(gold_silver_of(spark, sf_dir))
    return rounded(regional, "wind_speed_10m_mean", "wind_speed_10m_max")


# reports


@query
def monthly_regional_averages(spark, sf_dir):
    return analytics.monthly_averages(fixtures.daily_regional(spark, sf_dir))


@query
def monthly_wind_averages(spark, sf_dir):
    return analytics.monthly_averages(fixtures.daily_regional(spark, sf_dir), "wind_speed_mean", "wind_avg")


@query
def mart_regional_monthly_averages(spark, sf_dir):
    return analytics.monthly_summary(fixtures.daily_regional(spark, sf_dir))


@query
def compare_regions_over_time(spark, sf_dir):
    return analytics.compare_regions(fixtures.daily_regional(spark, sf_dir))


@query
def rolling_7d(spark, sf_dir):
    return analytics.rolling_mean(fixtures.daily_regional(spark, sf_dir), 7)


@query
def rolling_30d(spark, sf_dir):
    return analytics.rolling_mean(fixtures.daily_regional(spark, sf_dir), 30)


@query
def rolling_30d_per_cell(spark, sf_dir):
    cells, value = ("latitude", "longitude"), "temperature_2m_mean"
    rows = stage(fixtures.daily(spark, sf_dir).select("date", *cells, value))
    return rolling.rolling_mean_by_key(rows, cells, 30, value, "tmp_mean", "tmp_avg_rolling_30d", block_days=ROLLING_BLOCK)


@query
def hottest_days_per_region(spark, sf_dir):
    return analytics.hottest_days(fixtures.daily_regional(spark, sf_dir))


@query
def mart_global_hottest_days(spark, sf_dir):
    return analytics.hottest_day_per_location(fixtures.daily(spark, sf_dir))


PROFILE_ROUNDED = ("avg", "std", "q25", "q50", "q75")


@query
def profile_daily_global(spark, sf_dir):
    return rounded(profile.profile(fixtures.daily(spark, sf_dir), exact=True), *PROFILE_ROUNDED)


@query
def profile_daily_regional(spark, sf_dir):
    regional = rounded(fixtures.daily_regional(spark, sf_dir), "temp_mean", "wind_speed_mean")
    return rounded(profile.profile(regional, exact=True), *PROFILE_ROUNDED)


@query
def summarize_daily_global(spark, sf_dir):
    """The sketched profile, with its approximate values held against the bounds it states."""
    cells = stage(fixtures.daily(spark, sf_dir))
    checked = profile.within_bounds(cells, profile.profile(cells))
    exact = ("column_name", "column_type", "min", "max", "avg", "count")
    return rounded(checked.select(*exact, "distinct_near", "quartiles_near"), "avg")


@query
def summarize_from_sketches(spark, sf_dir):
    """The same from the stored states of each day: the profile itself reads no cell, the bounds are then checked on the cells."""
    cells = stage(fixtures.daily(spark, sf_dir))
    merged = profile.profile_from_states(stage(profile.day_states(cells)))
    exact = ("column_name", "column_type", "min", "max", "avg", "std", "count", "null_percentage")
    checked = profile.within_bounds(cells, stage(merged))
    return rounded(checked.select(*exact, "distinct_near", "quartiles_near"), "avg", "std")


# days, text and paths


@query
def missing_days(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return audit.missing_days(requested_days(observations), quality.passed(observations, day_status(observations)))


@query
def extra_days(spark, sf_dir):
    observations = obs(spark, sf_dir)
    expected = requested_days(observations).select(F.date_add("date", 2).alias("date"))
    return audit.extra_days(expected, observations)


@query
def date_utils(spark, sf_dir):
    shipped = F.col("l_shipdate").cast("date")
    return fixtures.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        dates.next_day(shipped).alias("next_day"),
        dates.days_between(F.lit(date(1998, 1, 1)), shipped).alias("days_since"),
        dates.day_text(F.col("l_shipdate")).alias("day_text"),
    )


@query
def date_list(spark, sf_dir):
    days = dates.day_list(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % LIST_BLOCK).cast("int"))
    return fixtures.table(spark, sf_dir, "orders").select("o_orderkey", F.explode(days).alias("day"))


@query
def format_bytes(spark, sf_dir):
    size = F.col("n_chars") * F.lit(1000.0) * F.pow(F.lit(1024.0), F.col("doc_id") % 6)
    return fixtures.table(spark, sf_dir, "documents").select("doc_id", text.format_bytes(size).alias("size"))


@query
def path_date(spark, sf_dir):
    path = scratch_root(spark)
    tables.write_days(obs(spark, sf_dir), path)
    stored = tables.read_days(spark, path, obs(spark, sf_dir).schema)
    named = stored.select("date", dates.day_from_path(F.col("_metadata.file_path")).alias("path_date"))
    return named.groupBy("date", "path_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query
def table_label(spark, sf_dir):
    name = F.concat(F.lit("daily_"), F.col("event_type"), F.lit("_10m"))
    events = fixtures.table(spark, sf_dir, "events").groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return events.select("name", text.title_label(F.col("name")).alias("label"), "n")


# quality


@query
def quality_metrics(spark, sf_dir):
    return quality.day_profile(obs(spark, sf_dir))


@query
def quality_violations(spark, sf_dir):
    return quality.quality_violations(quality.day_profile(obs(spark, sf_dir)))


@query
def quality_passed(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return quality.passed(observations, day_status(observations))


@query
def quality_quarantine(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return quality.quarantined(observations, day_status(observations))


@query
def null_share_flags(spark, sf_dir):
    return quality.null_share_flags(quality.day_profile(obs(spark, sf_dir)))


@query
def null_report(spark, sf_dir):
    return audit.null_report(obs(spark, sf_dir), HOURLY_GRID.variable_names)


@query
def hours_check(spark, sf_dir):
    observations = obs(spark, sf_dir)
    return audit.hours_check(observations, requested_days(observations).count())


@query
def duplicate_observations(spark, sf_dir):
    return audit.duplicate_observations(obs(spark, sf_dir))


@query
def gold_missing_partitions(spark, sf_dir):
    cells = finished_elt(spark, sf_dir).daily_global()
    missing = audit.missing_days(requested_days(obs(spark, sf_dir)), cells)
    return missing.select(text.title_label(F.lit("daily_global")).alias("table_label"), "date")


@query
def gold_null_report(spark, sf_dir):
    return audit.table_null_report(finished_elt(spark, sf_dir).daily_global())


@query
def not_null_tests(spark, sf_dir):
    return audit.not_null_tests(staging_views(spark, sf_dir))


# lineage and introspection


def listed(df: DataFrame, *names: str) -> DataFrame:
    return df.select(*[F.array_join(c, ",").alias(c) if c in names else F.col(c) for c in df.columns])


@query
def lineage_bronze(spark, sf_dir):
    records = lineage.bronze_lineage(quality.day_profile(obs(spark, sf_dir)))
    keep = ("layer", "source", "date", "start_time", "end_time", "variable_count", "variables", "row_count", "size_bytes")
    return listed(records.select(*keep), "variables")


@query
def lineage_silver(spark, sf_dir):
    records = lineage.silver_lineage(quality.day_status(quality.day_profile(obs(spark, sf_dir))))
    names = ("variables", "variables_dropped", "variables_derived")
    keep = ("layer", "source", "date", "parent_layer", "start_time", "end_time", *names, "row_count", "size_bytes")
    return listed(records.select(*keep), *names)


@query
def lineage_gold(spark, sf_dir):
    records = finished_elt(spark, sf_dir).lineage().where("layer = 'gold'")
    return records.select("layer", "transformation", "date", "aggregation_logic", "spatial_bounds", "row_count")


@query
def list_tables(spark, sf_dir):
    views = {"daily_global": fixtures.daily(spark, sf_dir), "daily_regional": fixtures.daily_regional(spark, sf_dir)}
    tables.register_views(spark, views)
    return audit.list_tables(spark, tuple(views))


@query
def describe_daily_global(spark, sf_dir):
    cells = gold.daily_rollup(gold_silver_of(spark, sf_dir))
    metrics = [c for c in cells.columns if c.startswith(("temperature", "wind"))]
    return audit.describe(tables.store_as_float(cells, metrics), counts=True)


@query
def describe_daily_regional(spark, sf_dir):
    return audit.describe(stage(fixtures.daily_regional(spark, sf_dir)), counts=True)


# whole runs


@query
def elt_daily_regional(spark, sf_dir):
    regional = finished_elt(spark, sf_dir).daily_regional()
    return rounded(regional, "wind_speed_10m_mean", "wind_speed_10m_max")


@query
def repaired_days(spark, sf_dir):
    """Every third day lands without its first hour and fails; its files are then replaced, and an ordinary run notices that."""
    observations, path, elt = obs(spark, sf_dir), scratch_root(spark), new_elt(spark)
    days = observed_days(observations)
    faulty = F.dayofmonth("date") % 3 == 0
    tables.write_days(observations.where(~faulty | (F.hour("time") > 0)), path)
    elt.run(landing.scan_observations(spark, path), days)
    tables.write_days(observations.where(faulty), path)
    elt.run(landing.scan_observations(spark, path), days)
    return rounded(elt.daily_regional(), "wind_speed_10m_mean", "wind_speed_10m_max")


@query
def landing_files(spark, sf_dir):
    """What the journal compares of each landed day, but for the digest, which is of this run's own files."""
    path = scratch_root(spark)
    tables.write_days(obs(spark, sf_dir), path)
    stored = landing.scan_observations(spark, path)
    marked = landing.fingerprints(stored, observed_days(stored))
    return marked.select("date", "n_rows", (F.col("files") > 0).alias("has_files"), F.col("fingerprint").isNotNull().alias("marked"))


@query
def failed_days(spark, sf_dir):
    return lineage.failed_days(quality.day_status(quality.day_profile(obs(spark, sf_dir))))


@query
def backfill_dates(spark, sf_dir):
    observations = obs(spark, sf_dir)
    ledger = lineage.ledger_of(day_status(observations))
    return lineage.pending(requested_days(observations), ledger, "gold", "daily_regional")
