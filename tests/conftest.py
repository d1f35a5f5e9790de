from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tidemill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", 4, {
        "spark.checkpoint.dir": str(folder / "shared"), "spark.sql.warehouse.dir": str(folder / "warehouse"),
        "spark.driver.memory": "4g",
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    def collect(df, *order):
        return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]

    return collect
