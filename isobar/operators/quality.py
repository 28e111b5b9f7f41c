"""The quality gate and the null rule, both read off one aggregate per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.dates import utc_day
from isobar.functions.numeric import null_percentage
from isobar.specs import HOURLY_GRID, NULL_THRESHOLD, ColumnSpec, DatasetSpec

# The message texts; the observed value goes between the two halves of a bound's text.
FAILED_TEXT = "Data Quality Validation Failed:\n"
MISSING_TEXT = "Missing {kind}: '{name}'"
BELOW_TEXT = ("{label} '{name}' min value ", " is below {bound}")
ABOVE_TEXT = ("{label} '{name}' max value ", " is above {bound}")
STEPS_TEXT = "Expected {steps} time steps, but found "
NO_TIME_TEXT = "Missing 'time' dimension."
UNTIMED_TEXT = " rows have no time"
OFF_DAY_TEXT = " rows have a time on another day"


def day_profile(obs: DataFrame, spec: DatasetSpec = HOURLY_GRID) -> DataFrame:
    """One row per day with all the gate, the null rule and lineage need.

    Row and distinct-hour counts, the time span, rows without a time or with one on another UTC day, and count, minimum and
    maximum of every declared column. A column the table lacks has a NULL count, one without values a count
    of 0. Every aggregate is partial before the shuffle; the single distinct one first
    shrinks to one row per hour.
    """
    present = set(obs.columns)

    def measure(column: str, aggregate: Column, dtype: str) -> Column:
        return aggregate if column in present else F.lit(None).cast(dtype)

    measures = [
        F.count(F.lit(1)).alias("n_rows"),
        measure("time", F.count_distinct(F.col("time")), "bigint").alias("n_times"),
        measure("time", F.min("time"), "timestamp").alias("start_time"),
        measure("time", F.max("time"), "timestamp").alias("end_time"),
        measure("time", F.count_if(F.col("time").isNull()), "bigint").alias("n_untimed"),
        measure("time", F.count_if(utc_day(F.col("time")) != F.col("date")), "bigint").alias("n_off_day"),
    ]
    for column in spec.coordinates + spec.variables:
        c = column.name
        measures.append(measure(c, F.count(c), "bigint").alias(f"{c}__count"))
        if column.bounded:
            value = F.col(c).cast("double")
            measures.append(measure(c, F.min(value), "double").alias(f"{c}__min"))
            measures.append(measure(c, F.max(value), "double").alias(f"{c}__max"))
    return obs.groupBy("date").agg(*measures)


def _finding(failed: Column, kind: str, target: str, observed: Column, bound: float | None, message: Column) -> Column:
    return F.when(
        failed,
        F.struct(
            F.lit(kind).alias("kind"),
            F.lit(target).alias("target"),
            observed.cast("double").alias("observed"),
            F.lit(bound).cast("double").alias("bound"),
            message.alias("message"),
        ),
    )


def _bound_findings(label: str, column: ColumnSpec) -> list[Column]:
    """Strict comparisons: a value equal to its bound passes, and so does a column without any value."""
    low, high = F.col(f"{column.name}__min"), F.col(f"{column.name}__max")
    found = []
    for side, observed, failed, bound, texts in (
        ("min", low, low < column.lower if column.lower is not None else None, column.lower, BELOW_TEXT),
        ("max", high, high > column.upper if column.upper is not None else None, column.upper, ABOVE_TEXT),
    ):
        if failed is None:
            continue
        before, after = (F.lit(t.format(label=label, name=column.name, bound=bound)) for t in texts)
        message = F.concat(before, observed, after)
        found.append(_finding(failed, f"{label.lower()}_{side}", column.name, observed, bound, message))
    return found


def findings(spec: DatasetSpec = HOURLY_GRID) -> Column:
    """All violations of a profiled day as one array, in the order they are checked."""
    checks: list[Column] = []
    nothing = F.lit(None)
    for label, columns in (("Coordinate", spec.coordinates), ("Variable", spec.variables)):
        kind = label.lower()
        for column in columns:
            absent = F.col(f"{column.name}__count").isNull()
            text = F.lit(MISSING_TEXT.format(kind=kind, name=column.name))
            checks.append(_finding(absent, f"missing_{kind}", column.name, nothing, None, text))
            checks += _bound_findings(label, column)
    if spec.time_steps is not None:
        steps, wanted = F.col("n_times"), spec.time_steps
        text = F.coalesce(F.concat(F.lit(STEPS_TEXT.format(steps=wanted)), steps), F.lit(NO_TIME_TEXT))
        wrong = steps.isNull() | (steps != wanted)
        checks.append(_finding(wrong, "time_steps", "time", steps, float(wanted), text))
    for kind, text in (("untimed", UNTIMED_TEXT), ("off_day", OFF_DAY_TEXT)):
        rows = F.col(f"n_{kind}")
        checks.append(_finding(rows > 0, kind, "time", rows, 0.0, F.concat(rows, F.lit(text))))
    return F.filter(F.array(*checks), lambda check: check.isNotNull())


def dtype_violations(obs: DataFrame, spec: DatasetSpec = HOURLY_GRID) -> list[str]:
    """Opt-in check of declared types; the gate itself never looks at them."""
    stored = dict(obs.dtypes)
    return [
        f"Column '{c.name}' is {stored[c.name]}, declared {c.dtype}"
        for c in spec.coordinates + spec.variables
        if c.name in stored and stored[c.name] != c.dtype
    ]


def quality_violations(profile: DataFrame, spec: DatasetSpec = HOURLY_GRID) -> DataFrame:
    """One row per violation: (date, kind, target, observed, bound, message)."""
    return profile.select("date", F.inline(findings(spec)))


def _null_share(variable: str) -> Column:
    return null_percentage(F.col(f"{variable}__count"), F.col("n_rows"))


def _is_dropped(variable: str, threshold: float) -> Column:
    """At or above the threshold; a day without the variable, or without rows, has nothing to keep."""
    return F.coalesce(F.when(F.col("n_rows") > 0, _null_share(variable) >= F.lit(threshold)), F.lit(True))


def null_share_flags(
    profile: DataFrame, spec: DatasetSpec = HOURLY_GRID, threshold: float = NULL_THRESHOLD
) -> DataFrame:
    """One row per day and variable: counts, null share and whether the day drops the variable."""
    rows = [
        F.struct(
            F.lit(v).alias("variable"),
            F.col("n_rows").alias("total_elements"),
            F.col(f"{v}__count").alias("non_null_count"),
            F.when(F.col("n_rows") > 0, _null_share(v)).alias("null_percentage"),
            _is_dropped(v, threshold).alias("dropped"),
        )
        for v in spec.variable_names
    ]
    return profile.select("date", F.inline(F.array(*rows)))


def day_status(profile: DataFrame, spec: DatasetSpec = HOURLY_GRID, threshold: float = NULL_THRESHOLD) -> DataFrame:
    """One row per day: did it pass, why not, and which variables it drops (``<variable>__drop``)."""
    found = findings(spec)
    messages = F.transform(found, lambda check: F.concat(F.lit("- "), check["message"]))
    reason = F.concat(F.lit(FAILED_TEXT), F.array_join(messages, "\n"))
    return profile.select(
        "date",
        "n_rows",
        "start_time",
        "end_time",
        (F.size(found) == 0).alias("passed"),
        F.when(F.size(found) > 0, reason).alias("reason"),
        *[_is_dropped(v, threshold).alias(f"{v}__drop") for v in spec.variable_names],
    )


def passed(obs: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of the days that passed the gate."""
    return obs.join(status.where("passed").select("date"), "date", "left_semi")


def quarantined(obs: DataFrame, status: DataFrame) -> DataFrame:
    """Rows of the days that failed the gate."""
    return obs.join(status.where("NOT passed").select("date"), "date", "left_semi")
