"""The driver's small tables, and the comparison with SQL."""

from __future__ import annotations

from pathlib import Path

import pytest

from tests.parity import difference

TABLES = "/root/testdata"


def folder(size: str = "sf0.001") -> str:
    path = f"{TABLES}/{size}"
    if not Path(path).exists():
        pytest.skip("no driver tables")
    return path


def documents(spark, size: str = "sf0.001"):
    return spark.read.parquet(f"{folder(size)}/documents.parquet")


def parity(spark, sf_dir: str, name: str) -> str:
    return difference(spark, sf_dir, name)
