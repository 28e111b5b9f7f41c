"""Text expressions: byte sizes and table labels."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

# Unit letters from bytes up, a factor of 1024 apart.
UNITS = ("", "K", "M", "G", "T", "P")
STEP = 1024.0


def format_bytes(size: Column) -> Column:
    """Size in the highest unit that keeps it at or above 1, two digits, ties to even: ``1.00KB``."""
    size = size.cast("double")

    def text(power: int) -> Column:
        scaled = F.bround(size / F.lit(STEP**power), 2)
        return F.concat(F.format_string("%.2f", scaled), F.lit(f"{UNITS[power]}B"))

    largest = len(UNITS) - 1
    return reduce(
        lambda rest, power: F.when((size >= 0) & (size < F.lit(STEP ** (power + 1))), text(power)).otherwise(rest),
        range(largest - 1, -1, -1),
        F.when(size.isNotNull(), text(largest)),
    )


def title_label(name: Column) -> Column:
    """``daily_global`` to ``Daily Global``: underscores become blanks, each run of letters is capitalised."""
    runs = F.regexp_extract_all(F.regexp_replace(name, "_", " "), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")
