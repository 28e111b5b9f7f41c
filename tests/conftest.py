from __future__ import annotations

import pytest

from tests.parity import session


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    spark.sparkContext.setLogLevel("OFF")
    yield spark
    spark.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "tables")
