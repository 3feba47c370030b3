from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from millrace.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "millrace-tests", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "4g"}
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows in a fixed order, for comparison."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
