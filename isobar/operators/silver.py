"""Bronze to silver: drop variables by day, derive new ones, describe them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.weather import derived_columns
from isobar.specs import DERIVED, HOURLY_GRID, DatasetSpec


def drop_null_variables(obs: DataFrame, status: DataFrame) -> DataFrame:
    """Set a variable to NULL on the days that drop it.

    ``status`` has one row per day; days it does not list fall out of the result.
    """
    flags = [c for c in status.columns if c.endswith("__drop")]
    flagged = obs.join(status.select("date", *flags), "date")
    return flagged.select(
        *[F.when(~F.col(f"{c}__drop"), F.col(c)).alias(c) if f"{c}__drop" in flags else F.col(c) for c in obs.columns]
    )


def derive(obs: DataFrame) -> DataFrame:
    """Add the derived variables. A dropped input makes them NULL for the day; a missing one leaves them out."""
    return obs.select("*", *derived_columns(obs.columns))


def to_silver(obs: DataFrame, status: DataFrame) -> DataFrame:
    """Days that passed, without their dropped variables, with the derived ones: one join in all."""
    return derive(drop_null_variables(obs, status.where("passed")))


def kept_variables(spec: DatasetSpec = HOURLY_GRID) -> dict[str, Column]:
    """Per row of the day status: the sorted names of kept, dropped and derived variables."""
    variables = spec.variable_names

    def names(conditions: list[tuple[str, Column]]) -> Column:
        listed = F.array(*[F.when(condition, F.lit(name)) for name, condition in conditions]).cast("array<string>")
        return F.array_sort(F.filter(listed, lambda name: name.isNotNull()))

    def survives(inputs: tuple[str, ...]) -> Column:
        alive = F.lit(True)
        for i in inputs:
            alive = alive & ~F.col(f"{i}__drop")
        return alive

    stored = [(v, ~F.col(f"{v}__drop")) for v in variables]
    derived = [(d.name, survives(d.inputs)) for d in DERIVED if all(i in variables for i in d.inputs)]
    return {
        "variables_kept": names(stored + derived),
        "variables_dropped": names([(v, F.col(f"{v}__drop")) for v in variables]),
        "variables_derived": names(derived),
    }


def variable_catalog(silver: DataFrame) -> DataFrame:
    """Attributes of the derived variables, as carried by the columns, with the number of values behind each."""
    described = [f for f in silver.schema.fields if f.metadata.get("long_name")]
    counts = silver.agg(*[F.count(f.name).alias(f.name) for f in described])
    rows = [
        F.struct(
            F.lit(f.name).alias("variable"),
            F.lit(f.metadata["units"]).alias("units"),
            F.lit(f.metadata["long_name"]).alias("long_name"),
            F.lit(f.metadata["description"]).alias("description"),
            F.col(f.name).alias("n_values"),
        )
        for f in described
    ]
    return counts.select(F.inline(F.array(*rows)))
