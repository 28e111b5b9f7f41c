"""The audits by name, over the stored tables of a deployment."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from isobar.operators import audit, gold
from isobar.plans.elt import Elt


def _layers(elt: Elt) -> dict[str, DataFrame]:
    return {"bronze": elt.bronze(), "silver": elt.silver()}


def _gold(elt: Elt) -> dict[str, DataFrame]:
    return {"daily_global": elt.daily_global(), "daily_regional": gold.regional_view(elt.daily_regional())}


def _each(tables: dict[str, DataFrame], check: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One check over several tables, with the table's name in front."""
    parts = [check(df).select(F.lit(name).alias("table_name"), "*") for name, df in tables.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def requested(elt: Elt) -> DataFrame:
    """Every day that the journal knows of."""
    return elt.journal().select("date").distinct()


def hours(elt: Elt) -> DataFrame:
    days = requested(elt).count()
    return _each(_layers(elt), lambda df: audit.hours_check(df, days, elt.spec.time_steps))


AUDITS: dict[str, Callable[[Elt], DataFrame]] = {
    "null_report": lambda elt: _each(_layers(elt), lambda df: audit.null_report(df, tuple(c for c in elt.variables if c in df.columns))),
    "hours_check": hours,
    "duplicates": lambda elt: _each(_layers(elt), lambda df: audit.duplicate_observations(df, elt.spec.time_steps)),
    "missing_days": lambda elt: _each({**_layers(elt), **_gold(elt)}, lambda df: audit.missing_days(requested(elt), df)),
    "extra_days": lambda elt: _each({**_layers(elt), **_gold(elt)}, lambda df: audit.extra_days(requested(elt), df)),
    "gold_null_report": lambda elt: _each(_gold(elt), audit.table_null_report),
    "failures": lambda elt: elt.failures(),
    "not_null_tests": lambda elt: audit.not_null_tests(elt.views()),
}
