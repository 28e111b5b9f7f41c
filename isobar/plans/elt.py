"""Landing to bronze to silver to gold for a list of days, one Spark job per table.

Data is written first and its journal entry, lineage and ledger in one, last. A run that dies
half-way is repeated for exactly the days it did not finish. Days fail on their own: a failing
day becomes a journal entry and keeps the others going. Where the landing table is a scan of files, the journal
also holds a fingerprint of each day's files: a day whose files have changed lands again, and a failed day is not tried
again until its files or the declarations change.
"""

from __future__ import annotations

import hashlib
import json
import time
from dataclasses import dataclass
from datetime import date
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from isobar.operators import gold, lineage, profile as profiles, quality
from isobar.operators.silver import to_silver
from isobar.plans.marts import MARTS
from isobar.session import release, stage, staged_so_far
from isobar.sources import landing as land_source, tables
from isobar.specs import (
    CELL_STATS,
    DERIVED,
    HOURLY_GRID,
    NULL_THRESHOLD,
    REGION_STATS,
    REGIONS,
    SOURCE_NAME,
    DatasetSpec,
    Region,
)

Stats = dict[str, tuple[str, ...]]
#: Fingerprint of a day without files.
ABSENT = "absent"


class Verdict(NamedTuple):
    """The journal's last word on a table and day, and what the day and the declarations were like then."""

    status: str
    reason: str | None
    fingerprint: str | None = None


Known = dict[tuple[str, date], Verdict]
NEVER = Verdict("", None)
TABLES = (("bronze", "bronze"), ("silver", "silver"), ("gold", "daily_global"), ("gold", "daily_regional"))


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join((self.root.rstrip("/"), *parts))

    @property
    def bronze(self) -> str:
        return self.path("bronze")

    @property
    def silver(self) -> str:
        return self.path("silver")

    @property
    def daily_global(self) -> str:
        return self.path("gold", "daily_global")

    @property
    def daily_regional(self) -> str:
        return self.path("gold", "daily_regional")

    @property
    def marts(self) -> str:
        return self.path("marts")

    @property
    def profile(self) -> str:
        return self.path("profile")

    @property
    def states(self) -> str:
        return self.path("states")

    @property
    def journal(self) -> str:
        return self.path("journal")


@dataclass(frozen=True)
class RunReport:
    """Days handled per table, rows written per table, and the failed days with their reasons."""

    days: dict[str, list[date]]
    rows: dict[str, int]
    failed: dict[date, str]
    seconds: float


class Elt:
    """One deployment: a session, a root folder and the declarations it runs under.

    ``cell_stats`` and ``region_stats`` name the statistics (mean, min, max) that the gold tables hold of each variable; those of
    variables that ``spec`` neither declares nor has the inputs of are left out. ``threshold`` is the null share, in percent, from
    which on a day drops a variable. Results do not depend on the session's time zone: days are UTC days.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        spec: DatasetSpec = HOURLY_GRID,
        regions: tuple[Region, ...] = REGIONS,
        source: str = SOURCE_NAME,
        cell_stats: Stats = CELL_STATS,
        region_stats: Stats = REGION_STATS,
        threshold: float = NULL_THRESHOLD,
    ) -> None:
        self.spark, self.spec, self.regions, self.source, self.threshold = spark, spec, regions, source, threshold
        self.at = Layout(root)
        self.derived = tuple(d.name for d in DERIVED if set(d.inputs) <= set(spec.variable_names))
        self.variables = tuple(spec.variable_names) + self.derived
        self.cell_stats = {v: s for v, s in cell_stats.items() if v in self.variables}
        self.region_stats = {v: s for v, s in region_stats.items() if v in self.variables}
        self.gold_inputs = tuple(dict.fromkeys((*self.cell_stats, *self.region_stats)))
        declared = repr((self.spec, self.threshold, self.gold_inputs))
        self.declared = hashlib.md5(declared.encode()).hexdigest()

    # tables

    def journal(self) -> DataFrame:
        return tables.read_or_empty(self.spark, self.at.journal, lineage.JOURNAL)

    def ledger(self) -> DataFrame:
        """Per table and day: finished or failed, and why."""
        return lineage.journal_ledger(self.journal())

    def lineage(self) -> DataFrame:
        """Per table and finished day: what was written, from what, when and how long it took."""
        return lineage.journal_lineage(self.journal())

    def _bronze_schema(self) -> T.StructType:
        variables = [T.StructField(v, T.FloatType()) for v in self.spec.variable_names]
        return T.StructType(
            [
                T.StructField("time", T.TimestampType()),
                T.StructField("latitude", T.DoubleType()),
                T.StructField("longitude", T.DoubleType()),
                T.StructField("spatial_ref", T.LongType()),
                *variables,
                T.StructField("date", T.DateType()),
            ]
        )

    def _silver_schema(self) -> T.StructType:
        fields = self._bronze_schema().fields
        derived = [T.StructField(name, T.FloatType()) for name in self.derived]
        return T.StructType([*fields[:-1], *derived, fields[-1]])

    def bronze(self, days: list[date] | None = None) -> DataFrame:
        return tables.read_days(self.spark, self.at.bronze, self._bronze_schema(), days)

    def profile(self, days: list[date]) -> DataFrame:
        """The stored day profiles; no rows before the first run."""
        schema = quality.day_profile(self.spark.createDataFrame([], self._bronze_schema()), self.spec).schema
        return tables.read_days(self.spark, self.at.profile, schema, days)

    def silver(self, days: list[date] | None = None) -> DataFrame:
        return tables.read_days(self.spark, self.at.silver, self._silver_schema(), days)

    def daily_global(self, days: list[date] | None = None) -> DataFrame:
        metrics = [T.StructField(f"{v}_{s}", T.FloatType()) for v, stats in self.cell_stats.items() for s in stats]
        keys = [
            T.StructField("latitude", T.DoubleType()),
            T.StructField("longitude", T.DoubleType()),
            T.StructField("spatial_ref", T.LongType()),
        ]
        schema = T.StructType([*keys, *metrics, T.StructField("date", T.DateType())])
        return tables.read_days(self.spark, self.at.daily_global, schema, days)

    def daily_regional(self, days: list[date] | None = None) -> DataFrame:
        metrics = [T.StructField(f"{v}_{s}", T.DoubleType()) for v, stats in self.region_stats.items() for s in stats]
        schema = T.StructType([T.StructField("region", T.StringType()), *metrics, T.StructField("date", T.DateType())])
        return tables.read_days(self.spark, self.at.daily_regional, schema, days)

    def views(self) -> dict[str, DataFrame]:
        """The gold tables as the reports and the declared tests read them, the marts built so far, and the records of the runs.

        The flat hourly table is a view: silver already holds exactly its rows.
        """
        cells, regional = self.daily_global(), gold.regional_view(self.daily_regional())
        found = {
            "hourly_global": gold.hourly_table(self.silver(), self.variables),
            "daily_global": cells,
            "daily_regional": regional,
            "stg_daily_global": cells,
            "stg_daily_regional": regional,
            "lineage": self.lineage(),
            "ledger": self.ledger(),
        }
        for name in MARTS:
            stored = tables.stored(self.spark, f"{self.at.marts}/{name}")
            if stored is not None:
                found[name] = stored
        return found

    # profiles

    def _sketch(self, table: str, days: list[date]) -> None:
        """Append the profile states of some days of a gold table. Of several states of a day the latest counts."""
        states = profiles.day_states(getattr(self, table)(days))
        stamped = states.select(F.lit(table).alias("table_name"), F.current_timestamp().alias("recorded_at"), *states.columns)
        stamped.write.mode("append").parquet(self.at.states)

    def states(self, table: str) -> DataFrame:
        """The latest state of each column and finished day of a gold table."""
        head = [T.StructField("table_name", T.StringType()), T.StructField("recorded_at", T.TimestampType())]
        stored = tables.read_or_empty(self.spark, self.at.states, T.StructType([*head, *profiles.STATE.fields]))
        keys = ("date", "column_name")
        held = F.struct(*[f.name for f in profiles.STATE.fields if f.name not in keys])
        newest = stored.where(F.col("table_name") == table).groupBy(*keys).agg(F.max_by(held, "recorded_at").alias("held"))
        return newest.select(*keys, "held.*").join(self._finished(table), "date", "left_semi")

    def _finished(self, table: str) -> DataFrame:
        done = (F.col("status") == lineage.OK) & (F.col("transformation") == table)
        return lineage.latest(self.ledger()).where(done).select("date")

    def summary(self, table: str) -> DataFrame:
        """The column profile of ``daily_global`` or ``daily_regional`` from its stored states, without reading its rows.

        Finished days that have no state yet, from a deployment older than its states, get one first.
        """
        states = self.states(table)
        lacking = self._finished(table).join(states.select("date").distinct(), "date", "left_anti").collect()
        if lacking:  # at most one row per day
            self._sketch(table, sorted(r.date for r in lacking))
            states = self.states(table)
        return profiles.profile_from_states(states)

    # steps

    def _requested(self, days: list[date]) -> DataFrame:
        return self.spark.createDataFrame([(d,) for d in days], "date date")

    def _verdicts(self, days: list[date]) -> Known:
        """The last word on each table and listed day, from one reading of the journal: at most four entries a day."""
        entries = lineage.latest(self.ledger().where(F.col("date").isin(days))).collect()
        return {(r.transformation, r.date): Verdict(r.status, r.reason, r.fingerprint) for r in entries}

    def _fingerprints(self, source: DataFrame, days: list[date]) -> dict[date, str] | None:
        """What the listed days' files are like now; nothing if the landing table is no scan of files."""
        found = land_source.fingerprints(source, days) if days else None
        return None if found is None else dict.fromkeys(days, ABSENT) | {r.date: r.fingerprint for r in found.collect()}

    def _mark(self, table: str, prints: dict[date, str] | None, day: date) -> str | None:
        """What a verdict depends on: the day's files and, behind the copy, the declarations."""
        if prints is None or day not in prints:
            return None
        return prints[day] if table == "bronze" else f"{prints[day]}/{self.declared}"

    def _pending(self, days: list[date], table: str, known: Known, prints: dict[date, str] | None = None) -> list[date]:
        """Listed days still to do; as literals they prune partitions statically. A day that failed as it is now stays failed."""

        def to_do(day: date) -> bool:
            last = known.get((table, day), NEVER)
            if last.status == lineage.FAILED:
                return last.fingerprint is None or last.fingerprint != self._mark(table, prints, day)
            return last.status != lineage.OK

        return sorted(d for d in set(days) if to_do(d))

    def _changed(self, days: list[date], known: Known, prints: dict[date, str] | None) -> list[date]:
        """Finished days whose files are no longer those that landed. Files that are gone change nothing."""

        def is_new(day: date) -> bool:
            last = known.get(("bronze", day), NEVER)
            now = self._mark("bronze", prints, day)
            return last.status == lineage.OK and None not in (last.fingerprint, now) and now not in (ABSENT, last.fingerprint)

        return [d for d in days if is_new(d)]

    def _finish(
        self,
        layer: str,
        transformation: str,
        started: float,
        records: DataFrame | None,
        reasons: dict[date, str],
        known: Known,
        prints: dict[date, str] | None = None,
    ) -> None:
        """Journal the days that were tried, in one append. A failure that the journal has already is not repeated."""
        marks = {d: self._mark(transformation, prints, d) for d in {*(prints or ()), *reasons}}
        verdicts = {d: Verdict(lineage.FAILED, r, marks[d]) for d, r in sorted(reasons.items())}
        new = {d: v for d, v in verdicts.items() if known.get((transformation, d)) != v}
        known |= {(transformation, d): v for d, v in new.items()}
        if records is None and not new:
            return
        seconds = round(time.time() - started, 2)
        done = self.spark.createDataFrame([], lineage.LINEAGE) if records is None else records
        timed = done.withColumn("execution_duration_seconds", F.lit(seconds))
        if prints is not None:
            marked = self.spark.createDataFrame(list(marks.items()), "date date, fingerprint string")
            timed = timed.join(marked, "date", "left")
        entries = [(d, v.reason, v.fingerprint) for d, v in new.items()]
        failures = self.spark.createDataFrame(entries, "date date, reason string, fingerprint string") if new else None
        tables.append_rows(lineage.journal_rows(timed, failures, layer, transformation), self.at.journal)

    def to_bronze(
        self,
        source: DataFrame,
        days: list[date],
        known: Known | None = None,
        laid_out: bool = False,
        prints: dict[date, str] | None = None,
    ) -> list[date]:
        """Copy the pending days of the landing table, replacing what an earlier attempt left.

        The written days are profiled once; gate, null rule and lineage all read that profile. A landing table that is
        ``laid_out`` by day and cell already is copied without a shuffle.
        """
        known = self._verdicts(days) if known is None else known
        pending = self._pending(days, "bronze", known, prints)
        if not pending:
            return pending
        started = time.time()
        landed = land_source.land_days(source, pending)
        stored = [f for f in self._bronze_schema().fields if f.name in landed.columns]
        columns = [f.name for f in stored]
        for path in (self.at.bronze, self.at.profile):
            tables.drop_days(self.spark, path, pending)
        typed = landed.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in stored])
        tables.write_days(typed, self.at.bronze, laid_out)
        profile = quality.day_profile(self.bronze(pending).select(*columns), self.spec)
        tables.write_days(profile, self.at.profile)
        profile = self.profile(pending)
        present = {r.date for r in profile.select("date").collect()}
        records = lineage.bronze_lineage(profile, self.spec, self.source) if present else None
        reasons = {d: "No observations for this day" for d in pending if d not in present}
        self._finish("bronze", "bronze", started, records, reasons, known, prints)
        known |= {("bronze", d): Verdict(lineage.OK, None, self._mark("bronze", prints, d)) for d in present}
        return pending

    def _judged(self, days: list[date]) -> dict[date, tuple[str | None, str | None]]:
        """Per profiled day why it cannot reach silver, and why it cannot reach gold: at most one entry per listed day."""
        status = quality.day_status(self.profile(days), self.spec, self.threshold)
        lacking = F.array_join(lineage.gold_blockers(self.gold_inputs), ", ").alias("lacking")
        rows = status.select("date", "reason", lacking).collect()
        return {r.date: (r.reason, lineage.blocked_reason(r.lacking) if r.lacking else None) for r in rows}

    def to_silver(self, days: list[date], known: Known | None = None, prints: dict[date, str] | None = None) -> list[date]:
        """Gate the pending days, then write those that passed."""
        known = self._verdicts(days) if known is None else known
        pending = self._pending(days, "silver", known, prints)
        pending = [d for d in pending if known.get(("bronze", d), NEVER).status != lineage.FAILED]
        if not pending:
            return pending
        started = time.time()
        judged = self._judged(pending)
        passed = sorted(d for d, (reason, _) in judged.items() if reason is None)
        records = None
        if passed:
            status = stage(quality.day_status(self.profile(passed), self.spec, self.threshold))
            floats = [f.name for f in self._silver_schema().fields if isinstance(f.dataType, T.FloatType)]
            silver = to_silver(self.bronze(passed), status)
            tables.drop_days(self.spark, self.at.silver, passed)
            tables.write_days(tables.store_as_float(silver, floats), self.at.silver, laid_out=True)
            records = lineage.silver_lineage(status, self.spec, self.source)
        reasons = {d: reason for d, (reason, _) in judged.items() if reason is not None}
        self._finish("silver", "silver", started, records, reasons, known, prints)
        known |= {("silver", d): Verdict(lineage.OK, None) for d in passed}
        return pending

    def to_gold(
        self, days: list[date], known: Known | None = None, prints: dict[date, str] | None = None
    ) -> tuple[dict[str, list[date]], dict[str, int]]:
        """Both rollups from finished silver days, from one reading of silver. A day that lacks an input reaches neither table."""
        known = self._verdicts(days) if known is None else known
        places = {
            "daily_global": (self.at.daily_global, self.daily_global, json.dumps("Global"), self.cell_stats),
            "daily_regional": (self.at.daily_regional, self.daily_regional, lineage.bounds_text(self.regions), self.region_stats),
        }
        finished = sorted(d for d in set(days) if known.get(("silver", d), NEVER).status == lineage.OK)
        todo = {name: self._pending(finished, name, known, prints) for name in places}
        wanted = sorted(set().union(*todo.values()))
        handled: dict[str, list[date]] = {name: [] for name in places}
        counts: dict[str, int] = {}
        if not wanted:
            return handled, counts
        judged = self._judged(wanted)
        ready = [d for d in wanted if judged[d][1] is None]
        stats = {v: () for v in self.gold_inputs}
        totals = stage(gold.cell_totals(self.silver(ready), stats)) if ready else None
        for transformation, (path, written, bounds, own) in places.items():
            started = time.time()
            pending = todo[transformation]
            mine = [d for d in pending if d in set(ready)]
            handled[transformation] = mine
            records = None
            if mine:
                rows = Observation(transformation)
                chosen = totals.where(F.col("date").isin(mine))
                if transformation == "daily_global":
                    cells = gold.cells_from_totals(chosen, own)
                    rollup = tables.store_as_float(cells, [c for c in cells.columns if c.startswith(self.gold_inputs)])
                else:
                    rollup = gold.regions_from_totals(chosen, self.regions, own)
                tables.drop_days(self.spark, path, mine)
                tables.write_days(rollup.observe(rows, F.count(F.lit(1)).alias("rows")), path)
                counts[transformation] = rows.get["rows"]
                self._sketch(transformation, mine)
                records = lineage.gold_lineage(written(mine), transformation, bounds, self.source, own)
                records = records.join(tables.day_sizes(self.spark, path, mine), "date", "left")
            reasons = {d: judged[d][1] for d in pending if judged[d][1] is not None}
            self._finish("gold", transformation, started, records, reasons, known, prints)
            known |= {(transformation, d): Verdict(lineage.OK, None) for d in mine}
        return handled, counts

    def run(
        self,
        source: DataFrame,
        days: list[date],
        batch_days: int | None = None,
        redo: bool = False,
        laid_out: bool = False,
    ) -> RunReport:
        """All layers for the listed days; days finished earlier are skipped table by table.

        ``batch_days`` bounds the days per job. Each batch is journaled before the next one starts,
        which limits both the shuffle files alive at a time and what a crash can cost. It never changes a result.
        ``redo`` takes the listed days back first, in the journal, so that they land again and everything is built anew from them; days whose
        landing files have changed are taken back by themselves.
        ``laid_out`` says that the landing table is ordered by day and cell, and saves its shuffle.
        """
        started = time.time()
        handled: dict[str, list[date]] = {}
        rows: dict[str, int] = {}
        ordered = sorted(set(days))
        size = batch_days or max(len(ordered), 1)
        for first in range(0, len(ordered), size):
            batch, mark = ordered[first : first + size], staged_so_far()
            if redo:
                self._take_back(batch)
            known, prints = self._verdicts(batch), self._fingerprints(source, batch)
            if changed := self._changed(batch, known, prints):
                self._take_back(changed)
                known = {key: v for key, v in known.items() if key[1] not in set(changed)}
            landed = self.to_bronze(source, batch, known, laid_out, prints)
            done = {"bronze": landed, "silver": self.to_silver(batch, known, prints)}
            gold_days, written = self.to_gold(batch, known, prints)
            release(mark)
            for table, dates in {**done, **gold_days}.items():
                handled.setdefault(table, []).extend(dates)
            for table, count in written.items():
                rows[table] = rows.get(table, 0) + count
        return RunReport(handled, rows, self.failed(ordered), round(time.time() - started, 2))

    def _take_back(self, days: list[date]) -> None:
        """Journal that the listed days are to be done again, then delete what is stored of them."""
        marks = [lineage.journal_marks(self._requested(days), layer, name, lineage.REDO) for layer, name in TABLES]
        tables.append_rows(land_source.concat_days(marks), self.at.journal)
        for path in (self.at.bronze, self.at.profile, self.at.silver, self.at.daily_global, self.at.daily_regional):
            tables.drop_days(self.spark, path, days)

    def failed(self, days: list[date]) -> dict[date, str]:
        """Listed days whose latest entry for some table is a failure."""
        rows = self.failures().where(F.col("date").isin(days)).select("date", "reason").distinct()
        return {r.date: r.reason for r in rows.collect()}

    def failures(self) -> DataFrame:
        """The days and tables whose last word is a failure, with its reason."""
        return lineage.latest(self.ledger()).where(F.col("status") == lineage.FAILED).drop("status")
